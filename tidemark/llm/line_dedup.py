"""Lines that many documents share, found through sharded minimal perfect hashes.

1. Every document gives its distinct line keys as 16-byte hashes; their document
   counts are summed.
2. The distinct hashes are dealt to shards.  A shard becomes one row: the bit
   levels of a minimal perfect hash and, in its order, a 4-byte fingerprint and
   the count of every key, about 9 bytes a line however long the line is.
3. Documents probe the arrays: probes travel to their shard's row, which a task
   opens once and answers with two array reads a probe.  A shard that gets many
   probes (a line in a third of all documents) is copied and its probes are
   spread over the copies, so no task depends on one hot line.
4. Documents leave out the lines whose probe reached the limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columnar import mix, plain_text, ragged
from tidemark.llm.rows import doc_key, emit, map_texts, numbers
from tidemark.session import stage

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NEWLINE = 10
_GAMMA = 2  # bits per key that is left on a level
_LIMIT = (1 << 32) - 1


@dataclass(frozen=True)
class LineSettings:
    min_docs: int = 10
    min_chars: int = 1
    lines_per_shard: int = 12_000  # different lines that a shard's arrays hold on average, at most


# ---- line keys ---------------------------------------------------------------------------


def line_keys(
    data: np.ndarray, offsets: np.ndarray, min_chars: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines, first line, key): every line's (start, end), each document's first line, and
    every line's 16-byte hash or, for a key shorter than ``min_chars``, an empty one."""
    breaks = np.flatnonzero(data == _NEWLINE)
    in_doc = np.searchsorted(breaks, offsets)
    first = in_doc + np.arange(len(offsets))
    starts = np.empty(first[-1], np.int64)
    ends = np.empty(first[-1], np.int64)
    doc_first, doc_last = first[:-1], first[1:] - 1
    after = np.ones(len(starts), bool)
    after[doc_first] = False
    starts[after] = breaks + 1
    starts[doc_first] = offsets[:-1]
    before = np.ones(len(starts), bool)
    before[doc_last] = False
    ends[before] = breaks
    ends[doc_last] = offsets[1:]
    solid = np.flatnonzero(~_BLANK[data])
    left = np.searchsorted(solid, starts)
    right = np.searchsorted(solid, ends)
    some = right > left
    low, high = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    low[some] = solid[left[some]]
    high[some] = solid[right[some] - 1] + 1
    if min_chars > 1:  # a character has one byte that is no continuation byte
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        some &= heads[high] - heads[low] >= min_chars
    folded = _LOWER[data].tobytes()
    digest = xxhash.xxh3_128_digest
    keys = np.array(
        [
            digest(folded[a:b]) if ok else b""
            for a, b, ok in zip(low.tolist(), high.tolist(), some.tolist(), strict=True)
        ],
        object,
    )
    return np.stack([starts, ends], axis=1), first, keys


def _distinct_per_doc(data, offsets, min_chars) -> tuple[np.ndarray, list[bytes]]:
    """Document number and key of every distinct key of a document."""
    _, first, keys = line_keys(data, offsets, min_chars)
    places, found = [], []
    for k, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        own = set(keys[a:b])
        own.discard(b"")
        places.append(np.full(len(own), k))
        found.extend(own)
    return np.concatenate(places) if places else np.zeros(0, np.int64), found


# ---- minimal perfect hash ----------------------------------------------------------------


def build_levels(high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
    """Bit levels of a minimal perfect hash over distinct 128-bit keys.

    A level sets the bits that exactly one of its keys hashes to; the other keys
    go on to the next level.
    """
    levels: list[np.ndarray] = []
    while len(high):
        size = max(64, _GAMMA * len(high))
        place = _place(high, low, len(levels), size)
        hits = np.bincount(place, minlength=size)
        levels.append(np.packbits(hits == 1))
        levels[-1] = np.concatenate([levels[-1], np.zeros(-len(levels[-1]) % 8, np.uint8)])
        left = hits[place] != 1
        high, low = high[left], low[left]
    return levels


def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        spread = mix(high * np.uint64(2 * level + 3) + mix(low + np.uint64(level)))
    return (spread % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Index of a key among the keys the levels were built for; -1 for some others."""

    def __init__(self, levels: list[np.ndarray], sizes: list[int]):
        self._bits = [np.unpackbits(x) for x in levels]
        self._sizes = sizes
        self._ranks, base = [], 0
        for bits in self._bits:
            running = np.cumsum(bits, dtype=np.int64)
            self._ranks.append(base + running - bits)
            base += int(running[-1]) if len(running) else 0

    def index(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        out = np.full(len(high), -1, np.int64)
        open_ = np.arange(len(high))
        for level, size in enumerate(self._sizes):
            if not len(open_):
                break
            place = _place(high[open_], low[open_], level, size)
            hit = self._bits[level][place] == 1
            out[open_[hit]] = self._ranks[level][place[hit]]
            open_ = open_[~hit]
        return out


def _pack_shard(keys: np.ndarray, counts: np.ndarray) -> dict:
    high, low = keys[:, 0], keys[:, 1]
    levels = build_levels(high, low)
    sizes, left = [], len(high)
    for bits in levels:
        sizes.append(max(64, _GAMMA * left))
        left -= int(np.unpackbits(bits).sum())
    at = PerfectHash(levels, sizes).index(high, low)
    prints, totals = np.empty(len(at), "<u4"), np.empty(len(at), "<u4")
    prints[at] = (low & np.uint64(0xFFFFFFFF)).astype("<u4")
    totals[at] = np.minimum(counts, _LIMIT).astype("<u4")
    return {
        "sizes": sizes,
        "levels": b"".join(x.tobytes() for x in levels),
        "prints": prints.tobytes(),
        "totals": totals.tobytes(),
    }


class Shard:
    """One opened shard: document counts of line keys."""

    def __init__(self, sizes: list[int], levels: bytes, prints: bytes, totals: bytes):
        parts, at = [], 0
        for size in sizes:
            n = (size + 7) // 8
            n += -n % 8
            parts.append(np.frombuffer(levels, np.uint8, n, at))
            at += n
        self._hash = PerfectHash(parts, sizes)
        self._prints = np.frombuffer(prints, "<u4")
        self._totals = np.frombuffer(totals, "<u4")

    def counts(self, keys: np.ndarray) -> np.ndarray:
        at = self._hash.index(keys[:, 0], keys[:, 1])
        known = at >= 0
        known[known] = self._prints[at[known]] == (keys[known, 1] & np.uint64(0xFFFFFFFF))
        out = np.zeros(len(keys), np.int64)
        out[known] = self._totals[at[known]]
        return out


def _key_array(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<u8").reshape(-1, 2)


# ---- Spark side ----------------------------------------------------------------------------


def line_counts(docs: DataFrame, text_col: str, settings: LineSettings) -> DataFrame:
    """(line, docs): the hash of every distinct line key and the documents that hold it."""

    def work(part, data, offsets):
        found: dict[bytes, int] = {}
        for key in _distinct_per_doc(data, offsets, settings.min_chars)[1]:
            found[key] = found.get(key, 0) + 1
        return [list(found), np.fromiter(found.values(), np.int64, len(found))]

    rows = emit(docs, plain_text(text_col), "line binary, docs long", work)
    return rows.groupBy("line").agg(F.sum("docs").alias("docs"))


def build_index(counts: DataFrame, shards: int) -> DataFrame:
    """One row per shard: bit levels, fingerprints, counts, and the probes it will get."""
    out = "shard int, load long, sizes array<int>, levels binary, prints binary, totals binary"
    schema = pa.schema(
        [("shard", pa.int32()), ("load", pa.int64()), ("sizes", pa.list_(pa.int32()))]
        + [(c, pa.binary()) for c in ("levels", "prints", "totals")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(shard, keys, counts):
            counts = np.concatenate(counts)
            made = _pack_shard(np.concatenate(keys), counts)
            row = {"shard": shard, "load": int(counts.sum()), **made}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        open_, keys, totals = None, [], []
        for batch in batches:
            shard, docs = numbers(batch, "shard"), numbers(batch, "docs")
            own = _key_array(batch.column(batch.schema.get_field_index("line")))
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(shard)), strict=True):
                if a == b:
                    continue
                if open_ is not None and shard[a] != open_:
                    yield close(open_, keys, totals)
                    keys, totals = [], []
                open_ = int(shard[a])
                keys.append(own[a:b])
                totals.append(docs[a:b])
        if open_ is not None:
            yield close(open_, keys, totals)

    dealt = counts.withColumn("shard", F.pmod(F.xxhash64("line"), F.lit(shards)).cast("int"))
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, out)


def _answers(min_docs: int):
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("line", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            is_index = ~np.asarray(batch.column(batch.schema.get_field_index("levels")).is_null())
            cuts = np.flatnonzero(is_index)
            # Rows of a shard follow its index row; the first rows may belong to the open one.
            for a, b in zip(np.append(0, cuts), np.append(cuts, batch.num_rows), strict=True):
                if a < batch.num_rows and is_index[a]:
                    row = batch.slice(int(a), 1).to_pylist()[0]
                    shard = Shard(row["sizes"], row["levels"], row["prints"], row["totals"])
                    a += 1
                if a >= b:
                    continue
                part = batch.slice(int(a), int(b - a))
                line = part.column(part.schema.get_field_index("line"))
                often = pa.array(shard.counts(_key_array(line)) >= min_docs)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)).filter(often) for c in schema.names],
                    schema=schema,
                )

    return run


def probe(docs: DataFrame, index: DataFrame, id_col: str, text_col: str, shards: int, settings: LineSettings) -> DataFrame:
    """(k1, k2, line): the line keys of every document that reach the limit."""

    def work(part, data, offsets):
        place, keys = _distinct_per_doc(data, offsets, settings.min_chars)
        return [numbers(part, "k1")[place], numbers(part, "k2")[place], keys]

    k1, k2 = doc_key(id_col, text_col)
    probes = emit(
        docs, plain_text(text_col), "k1 long, k2 long, line binary", work, {"k1": k1, "k2": k2}
    ).withColumn("shard", F.pmod(F.xxhash64("line"), F.lit(shards)).cast("int"))
    total = index.agg(F.sum("load"), F.count("*")).first()
    usual = max(1.0, 2 * (total[0] or 0) / max(1, total[1]))
    copies = F.ceil(F.col("load") / usual).cast("int")
    hot = index.where(copies > 1).select("shard", copies.alias("copies"))
    spread = probes.join(hot, "shard", "left").withColumn(
        "copy", F.pmod(F.xxhash64("k1", "k2"), F.coalesce("copies", F.lit(1))).cast("int")
    )
    opened = index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1)))
    parts = ["sizes", "levels", "prints", "totals"]
    empty = {"sizes": "array<int>", "levels": "binary", "prints": "binary", "totals": "binary"}
    both = spread.select(
        "shard", "copy", F.lit(1).alias("kind"), "k1", "k2", "line",
        *(F.lit(None).cast(empty[c]).alias(c) for c in parts),
    ).unionAll(
        opened.select(
            "shard", "copy", F.lit(0).alias("kind"),
            F.lit(None).cast("long").alias("k1"), F.lit(None).cast("long").alias("k2"),
            F.lit(None).cast("binary").alias("line"), *parts,
        )
    )
    return (
        both.repartition("shard", "copy")
        .sortWithinPartitions("shard", "copy", "kind")
        .mapInArrow(_answers(settings.min_docs), "k1 long, k2 long, line binary")
    )


def drop_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: LineSettings = LineSettings(),
    counted: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with every line gone whose key at least ``min_docs`` documents hold.

    A key is the line without blanks at its ends, A-Z in lower case; keys of fewer
    than ``min_chars`` characters always stay.  Null and empty texts are one empty
    line.  Adds the lines before and the lines dropped under the names
    ``counted`` (replacing columns of these names).  Rows repeated in the input
    count as documents of their own.
    """
    # All lines, of which the different ones are a part: few documents may hold very many.
    body = plain_text(text_col)
    breaks = F.length(body) - F.length(F.replace(body, F.lit("\n"))) + 1
    lines = docs.agg(F.coalesce(F.sum(breaks), F.lit(0))).first()[0]
    shards = max(8, -(-lines // settings.lines_per_shard))
    index = stage(build_index(line_counts(docs, text_col, settings), shards), "line-index")
    found = probe(docs, index, id_col, text_col, shards, settings)
    gone = found.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("line")).alias("gone"))
    k1, k2 = doc_key(id_col, text_col)
    # The input travels as one column, so that its names cannot meet the names used here.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    marked = docs.select(k1, k2, row).join(gone, ["k1", "k2"], "left")

    def work(part, data, offsets):
        lists = part.column(part.schema.get_field_index("gone"))
        raw = data.tobytes()
        breaks = np.concatenate([[0], np.cumsum(data == _NEWLINE)])
        lines = breaks[offsets[1:]] - breaks[offsets[:-1]] + 1
        dropped = np.zeros(len(lines), np.int64)
        kept = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        hit = np.flatnonzero(~np.asarray(lists.is_null()))
        if len(hit):
            at = ragged(offsets[hit], offsets[hit + 1] - offsets[hit])
            own = np.concatenate([[0], np.cumsum(offsets[hit + 1] - offsets[hit])])
            text = data[at]
            spans, first, keys = line_keys(text, own, settings.min_chars)
            whole = text.tobytes()
            for k, doc in enumerate(hit):
                out = set(lists[int(doc)].as_py())
                a, b = first[k], first[k + 1]
                stay = [whole[s:e] for (s, e), key in zip(spans[a:b], keys[a:b], strict=True) if key not in out]
                dropped[doc] = b - a - len(stay)
                kept[doc] = b"\n".join(stay)
        text = pa.array(kept, pa.binary()).cast(pa.string())
        return [text, pa.array(lines), pa.array(dropped)]

    out = f"`{text_col}` string, `{counted[0]}` long, `{counted[1]}` long"
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    done = map_texts(marked, ["row"], text, out, work, {"gone": F.col("gone")})
    return done.select(
        *(
            F.col(f"`{text_col}`") if c == text_col else F.col("row").getField(c).alias(c)
            for c in docs.columns if c not in counted
        ),
        *(f"`{c}`" for c in counted),
    )
