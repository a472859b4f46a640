"""Bytes covered by a long string that also starts elsewhere, removed from every text.

The suffixes of a corpus cannot be merged in one place, so they are first dealt to
groups that cannot share a long string.  Every window of ``length`` bytes has an
anchor, its least 40-byte hash; equal windows have equal anchors at equal offsets.
Consecutive windows with one anchor form a segment.

1. Anchors that occur once are dropped: none of their windows repeats.
2. Segments that occur whole more than once are repeated throughout; one of them
   stays as reference.
3. Different segments of one anchor are cut from their texts.  Shards of them are
   turned into Burrows-Wheeler transforms and merged (``bwt_merge``); the repeated
   intervals are the repeated windows.
4. An anchor with very many different segments (the edge of a passage that a third
   of the corpus holds) is split first: each segment into halves by the offset of
   its windows, grouped by the bytes that all windows of the half share.  Steps 2
   to 4 apply to the halves, until groups are small.  A half of one window is
   fully decided by step 2, so this ends.

Equal segments in a row are folded into one, so a periodic text of any length gives few.
Segments are compared by anchor and by content, an XXH3 of their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bwt_merge import repeated_starts
from tidemark.llm.columnar import RangeHash, mix, plain_text, ragged
from tidemark.llm.rows import doc_key, emit, map_texts, numbers
from tidemark.session import stage

_ANCHOR = 40
_POSITION_BITS = 24
_LONGEST = 1 << 22  # longer texts are read in overlapping parts
_CROWD = 512  # different segments of one anchor that one task compares
_BLOCK_BYTES = 60_000  # text that is merged together
_SCRAMBLE = np.uint64(0x9E3779B97F4A7C15)

_anchors = RangeHash(seed=31)

_SEGMENT = (
    "anchor long, content long, k1 long, k2 long, start long, place int, windows int, reach long, times long"
)


# ---- segments -------------------------------------------------------------------------------


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, from running minima of blocks."""
    n = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, np.iinfo(values.dtype).max, values.dtype)])
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _digests(data: bytes, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """XXH3 of byte ranges; unlike sums of powers it has no pairs of strings that always collide."""
    digest, view = xxhash.xxh3_64_intdigest, memoryview(data)
    spans = zip(starts.tolist(), ends.tolist(), seeds.tolist(), strict=True)
    return np.fromiter((digest(view[a:b], s) for a, b, s in spans), np.uint64, len(starts))


def segments(
    data: np.ndarray, offsets: np.ndarray, length: int, contents: bool = True
) -> dict[str, np.ndarray]:
    """Segments of all texts: document, start, windows, place of the anchor in the first
    window, anchor hash and, unless not asked for, content hash."""
    gram = min(_ANCHOR, length)
    many = len(data) - length + 1
    if many <= 0:
        none = np.zeros(0, np.int64)
        return dict.fromkeys(("doc", "start", "windows", "place"), none) | {
            "anchor": none.astype(np.uint64), "content": none.astype(np.uint64)
        }
    sums = _anchors.sums(data)
    grams = _anchors.ranges(sums, np.arange(len(data) - gram + 1), np.arange(gram, len(data) + 1))
    low = np.uint64((1 << _POSITION_BITS) - 1)
    ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_least_in_windows(ranked, length - gram + 1)[:many] & low).astype(np.int64)
    # Windows that lie within one text.
    steps = np.zeros(many + 1, np.int64)
    fits = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(steps, offsets[fits], 1)
    np.add.at(steps, offsets[fits + 1] - length + 1, -1)
    inside = np.cumsum(steps[:-1]) > 0
    begins = inside.copy()
    begins[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(begins)
    windows = np.bincount((np.cumsum(begins) - 1)[inside], minlength=len(starts)) if len(starts) else starts
    place = anchor[starts] - starts
    content = np.zeros(len(starts), np.uint64)
    if contents:
        content = _digests(data.tobytes(), starts, starts + windows + length - 1, place)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return {
        "doc": doc, "start": starts - offsets[doc], "windows": windows, "place": place,
        "anchor": grams[anchor[starts]], "content": content,
    }


def _all_segments(
    data: np.ndarray, offsets: np.ndarray, length: int, contents: bool = True
) -> dict[str, np.ndarray]:
    """``segments``, with very long texts taken in parts that overlap by a window less a byte."""
    if len(data) <= _LONGEST:
        return segments(data, offsets, length, contents)
    found = []
    for doc, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for low in range(a, max(a + 1, b - length + 1), _LONGEST):
            high = min(b, low + _LONGEST + length - 1)
            part = segments(data[low:high], np.array([0, high - low]), length, contents)
            part["doc"] = part["doc"] + doc
            part["start"] = part["start"] + (low - a)
            found.append(part)
    return {c: np.concatenate([p[c] for p in found]) for c in found[0]}


def _folded(s: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Equal segments in a row (a periodic stretch) as one, with their number (``times``) and all
    their windows (``reach``).  They repeat each other, so the whole stretch is repeated."""
    same = np.zeros(len(s["doc"]), bool)
    same[1:] = s["start"][1:] == s["start"][:-1] + s["windows"][:-1]
    for c in ("doc", "anchor", "content", "windows"):
        same[1:] &= s[c][1:] == s[c][:-1]
    heads = np.flatnonzero(~same)
    times = np.diff(np.append(heads, len(same)))
    return {c: v[heads] for c, v in s.items()} | {"times": times, "reach": times * s["windows"][heads]}


def _anchor_counts(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """Anchors that occur more than once."""

    def work(part, data, offsets):
        anchors, times = np.unique(
            _all_segments(data, offsets, length, contents=False)["anchor"], return_counts=True
        )
        return [anchors.view(np.int64), times]

    rows = emit(docs, plain_text(text_col), "anchor long, times long", work)
    counts = rows.groupBy("anchor").agg(F.sum("times").alias("times"))
    # Stored, so that both sides of the join with it are plain shuffles, which Spark can split
    # where one anchor has very many rows.
    return stage(counts.where("times > 1").select("anchor"), "repeated-anchors")


def _segment_rows(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    def work(part, data, offsets):
        s = _folded(_all_segments(data, offsets, length))
        return [
            s["anchor"].view(np.int64), s["content"].view(np.int64),
            numbers(part, "k1")[s["doc"]], numbers(part, "k2")[s["doc"]],
            s["start"], s["place"].astype(np.int32), s["windows"].astype(np.int32),
            s["reach"], s["times"],
        ]

    k1, k2 = doc_key(id_col, text_col)
    return emit(docs, plain_text(text_col), _SEGMENT, work, {"k1": k1, "k2": k2})


# ---- groups -----------------------------------------------------------------------------------


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(again, open): the (anchor, content) that occur more than once, and one segment of every
    content of those anchors that have several, with the anchor's ``crowd`` of contents.

    ``rows`` is stored.
    """
    others = [c for c in rows.columns if c not in ("anchor", "content", "times", "reach")]
    classes = stage(
        rows.groupBy("anchor", "content").agg(
            F.sum("times").alias("times"), *(F.first(c).alias(c) for c in others)
        ),
        "segment-classes",
    )
    crowds = stage(
        classes.groupBy("anchor").agg(F.count("*").alias("crowd")).where("crowd > 1"), "crowds"
    )
    return classes.where("times > 1").select("anchor", "content"), classes.join(crowds, "anchor")


def _spans(rows: DataFrame, reach: str, length: int) -> DataFrame:
    return rows.select("k1", "k2", "start", (F.col("start") + F.col(reach) + length - 1).alias("end"))


def _cut_texts(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` segments with their bytes, read from the texts of ``keyed``."""
    per_doc = wanted.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("anchor", "content", "times", "start", "place", "windows", "crowd")).alias("__cut")
    )
    joined = keyed.join(per_doc, ["k1", "k2"]).select(*keyed.columns, "__cut")
    out = (
        "anchor long, content long, times long, k1 long, k2 long, start long, place int, windows int, "
        "crowd long, text binary"
    )
    schema_types = [pa.int64()] * 6 + [pa.int32()] * 2 + [pa.int64(), pa.binary()]
    names = ["anchor", "content", "times", "k1", "k2", "start", "place", "windows", "crowd", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("__cut"))
            texts = batch.column(batch.schema.get_field_index("__body")).to_pylist()
            counts = np.asarray(lists.value_lengths())
            doc = np.repeat(np.arange(batch.num_rows), counts)
            flat = lists.flatten()
            field = {f.name: flat.field(i) for i, f in enumerate(flat.type)}
            keys = [numbers(batch, k)[doc] for k in ("k1", "k2")]
            raw = [t.encode() for t in texts]
            start, windows = field["start"].to_numpy(), field["windows"].to_numpy()
            pieces = [
                raw[d][s : s + w + length - 1] for d, s, w in zip(doc, start, windows, strict=True)
            ]
            values = [field["anchor"], field["content"], field["times"], *keys, start, field["place"], windows, field["crowd"], pieces]
            yield pa.RecordBatch.from_arrays(
                [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, schema_types, strict=True)],
                names=names,
            )

    return joined.mapInArrow(run, out)


def _halved(rows: DataFrame, length: int, width: int) -> DataFrame:
    """Segments cut where the offset of their windows passes a multiple of ``width``, regrouped
    by the bytes that all windows between two multiples share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, windows = numbers(batch, "place").astype(np.int64), numbers(batch, "windows").astype(np.int64)
            # The anchor stands at place, place - 1, ... in the windows of a segment.
            last = place - windows + 1
            first_bin, last_bin = last // width, place // width
            many = last_bin - first_bin + 1
            row = np.repeat(np.arange(batch.num_rows), many)
            part = ragged(first_bin, many)
            top = np.minimum(place[row], part * width + width - 1)
            bottom = np.maximum(last[row], part * width)
            skip = place[row] - top
            size = top - bottom + 1
            column = batch.column(batch.schema.get_field_index("text"))
            raw = column.to_pylist()
            data = b"".join(raw)
            at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])[row]
            # From the start of the bin's last window to the end of its first one.
            core = at + place[row] - part * width
            shared = _digests(data, core, core + length - width + 1, np.zeros(len(core), np.int64))
            begin = at + skip
            content = _digests(data, begin, begin + size + length - 1, top)
            group = numbers(batch, "anchor").view(np.uint64)[row] * _SCRAMBLE + part.astype(np.uint64)
            texts = [raw[r][s : s + n + length - 1] for r, s, n in zip(row, skip, size, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(mix(mix(group) + shared).view(np.int64)),
                    pa.array(content.view(np.int64)),
                    pa.array(numbers(batch, "times")[row]),
                    pa.array(numbers(batch, "k1")[row]), pa.array(numbers(batch, "k2")[row]),
                    pa.array(numbers(batch, "start")[row] + skip),
                    pa.array(top.astype(np.int32)), pa.array(size.astype(np.int32)),
                    pa.array(texts, pa.binary()),
                ],
                names=["anchor", "content", "times", "k1", "k2", "start", "place", "windows", "text"],
            )

    return rows.mapInArrow(
        run,
        "anchor long, content long, times long, k1 long, k2 long, start long, place int, windows int, text binary",
    )


def _merged(rows: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start, end): repeated strings found by merging the segments of each anchor."""
    schema = pa.schema([(c, pa.int64()) for c in ("k1", "k2", "start", "end")])

    def solve(parts: list[list]) -> pa.RecordBatch:
        k1, k2, start, times = (np.concatenate([p[i] for p in parts]) for i in range(1, 5))
        texts = [t for p in parts for t in p[5]]
        lengths = np.array([len(t) for t in texts], np.int64)
        flags = repeated_starts(np.frombuffer(b"".join(texts), np.uint8), lengths, times, length)
        owner = np.repeat(np.arange(len(texts)), lengths)
        flags &= times[owner] == 1
        begin = np.flatnonzero(flags & ~np.concatenate([[False], flags[:-1]]))
        end = np.flatnonzero(flags & ~np.concatenate([flags[1:], [False]]))
        # A string's last bytes start no window, so runs never reach the next string.
        own = owner[begin]
        base = (np.cumsum(lengths) - lengths)[own] - start[own]
        return pa.RecordBatch.from_arrays(
            [pa.array(k1[own]), pa.array(k2[own]), pa.array(begin - base), pa.array(end - base + length)],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list] = []  # rows of whole anchors, but for the last one
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [numbers(batch, c) for c in ("anchor", "k1", "k2", "start", "times")]
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            cuts = np.append(np.append(0, np.flatnonzero(np.diff(columns[0])) + 1), batch.num_rows)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held >= _BLOCK_BYTES and waiting[-1][0][-1] != columns[0][a]:
                    yield solve(waiting)
                    waiting, held = [], 0
                waiting.append([c[a:b] for c in columns] + [texts[a:b]])
                held += sum(map(len, texts[a:b]))
        if waiting:
            yield solve(waiting)

    return (
        rows.select("anchor", "k1", "k2", "start", "times", "text")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(run, "k1 long, k2 long, start long, end long")
    )


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(k1, k2, start, end): byte spans of repeated strings; spans may overlap and repeat."""
    keyed = docs.select(*doc_key(id_col, text_col), plain_text(text_col).alias("__body"))
    known = _anchor_counts(docs, text_col, length)
    rows = stage(
        _segment_rows(docs, id_col, text_col, length).join(known, "anchor"), "segments"
    )
    again, open_ = _classes(rows)
    spans = [_spans(rows.join(again, ["anchor", "content"]), "reach", length)]
    texts = stage(_cut_texts(keyed, open_, length), "segment-texts")
    quiet = [texts.where(F.col("crowd") <= _CROWD)]
    crowded, width = texts.where(F.col("crowd") > _CROWD), 64
    while crowded.limit(1).count():
        parts = stage(_halved(crowded, length, min(width, length)), "segment-halves")
        again, open_ = _classes(parts)
        # Segments that stand for several are repeated, and were reported with their class.
        single = parts.where("times = 1").join(again, ["anchor", "content"])
        spans.append(_spans(single, "windows", length))
        texts = stage(open_, "segment-texts")
        quiet.append(texts.where(F.col("crowd") <= _CROWD))
        crowded, width = texts.where(F.col("crowd") > _CROWD), width // 2
    rest = quiet[0]
    for more in quiet[1:]:
        rest = rest.unionByName(more)
    out = _merged(rest, length)
    for more in spans:
        out = out.unionByName(more)
    return out


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
    added: tuple[str, str, str, str] = ("n_bytes", "n_removed", "n_spans", "kept_sha256"),
) -> DataFrame:
    """``docs`` without the bytes that a repeated string of ``length`` bytes covers.

    A byte goes if some string of ``length`` bytes over it also starts elsewhere, in
    this or another text, overlaps included; all copies go.  Texts are judged as
    UTF-8 bytes on the input; null is the empty text.  The text column becomes
    what is left, without characters that lost some of their bytes.  ``added``
    names the bytes before, the bytes removed, the maximal removed runs and the
    SHA-256 of the remaining bytes (taken before broken characters are dropped).
    """
    if length < 2:
        raise ValueError("the length must be at least 2")
    spans = repeated_spans(docs, id_col, text_col, length)
    per_doc = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    k1, k2 = doc_key(id_col, text_col)
    # The input travels as one column, so that its names cannot meet the names used here.
    own = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(k1, k2, F.struct(*own).alias("row")).join(per_doc, ["k1", "k2"], "left")

    def work(part, data, offsets):
        lists = part.column(part.schema.get_field_index("spans"))
        counts = np.asarray(lists.value_lengths().fill_null(0))
        flat = lists.flatten()
        doc = np.repeat(np.arange(part.num_rows), counts)
        steps = np.zeros(len(data) + 1, np.int32)
        np.add.at(steps, offsets[doc] + flat.field(0).to_numpy(), 1)
        np.add.at(steps, offsets[doc] + flat.field(1).to_numpy(), -1)
        gone = np.cumsum(steps[:-1], dtype=np.int32) > 0
        removed = np.concatenate([[0], np.cumsum(gone)])
        removed = removed[offsets[1:]] - removed[offsets[:-1]]
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        begins[edges] = gone[edges]
        runs = np.concatenate([[0], np.cumsum(begins)])
        runs = runs[offsets[1:]] - runs[offsets[:-1]]
        left = data[~gone].tobytes()
        sizes = np.diff(offsets) - removed
        ends = np.cumsum(sizes)
        kept = [left[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        return [
            pa.array([k.decode(errors="ignore") for k in kept], pa.string()),
            pa.array(np.diff(offsets)), pa.array(removed), pa.array(runs),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        ]

    out = f"`{text_col}` string, `{added[0]}` long, `{added[1]}` long, `{added[2]}` long, `{added[3]}` string"
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    done = map_texts(marked, ["row"], text, out, work, {"spans": F.col("spans")})
    return done.select(
        *(
            F.col(f"`{text_col}`") if c == text_col else F.col("row").getField(c).alias(c)
            for c in docs.columns if c not in added
        ),
        *(f"`{c}`" for c in added),
    )
