"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last one
padded).  The binary Golay code (23, 12, 7) is perfect: every segment lies within
3 bits of exactly one of 4,096 codewords, and every segment whose nearest
codeword is 3 bits away has five more codewords at 4 bits.  The indices of these
1 or 6 codewords are the segment's fuzzy keys; two segments that differ in at most
2 bits always share one (``tests/llm`` proves it over all cosets).

Four differing bits over three segments leave two segments with at most 2
differing bits together.  Either both differ in at most 1, or one is equal and
the other differs in 2.  So a fingerprint is filed under

- for each pair of segments: (codeword index, codeword index), as home under the
  nearest codewords and as visitor under all combinations of fuzzy keys;
- for each ordered pair: the exact first segment and each fuzzy key of the second.

Fingerprints that meet under a key are compared bit by bit; links become
components.  Only distinct fingerprints are filed, so copies cost nothing, and a
bucket gives at most one link per member: its own components, found breadth
first, each hung on its smallest member.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columnar import plain_text, ragged
from tidemark.llm.components import connected
from tidemark.llm.rows import map_texts, numbers
from tidemark.session import stage

# The Golay code's generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
_GENERATOR = 0b101011100011
_SEGMENTS = ((0, 23), (23, 23), (46, 18))
MOST_BITS = 4  # what the filing scheme covers; smaller distances are a subset

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_SEED = 42
_SMALL_RUN = 24  # buckets up to this size are compared pair by pair in one array
_HOT_SHARE = 64  # one in so many fingerprints is filed ahead to find crowded keys
_PART = 20_000  # members of a crowded key that one task compares with as many others


# ---- Golay code ------------------------------------------------------------------------------


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder modulo the generator: 11 bits, 0 for codewords."""
    out = words.astype(np.int64)
    for bit in range(22, 10, -1):
        out = np.where(out >> bit & 1, out ^ (_GENERATOR << (bit - 11)), out)
    return out


def _patterns() -> np.ndarray:
    """For each syndrome the error patterns of at most 4 bits, the lightest first; -1 pads."""
    table = np.full((2048, 6), -1, np.int64)
    used = np.zeros(2048, np.int64)
    for weight in range(5):
        errors = np.array([sum(1 << i for i in c) for c in combinations(range(23), weight)])
        for error, syndrome in zip(errors, _syndromes(errors), strict=True):
            table[syndrome, used[syndrome]] = error
            used[syndrome] += 1
    return table


_ERRORS = _patterns()


def fuzzy_keys(segments: np.ndarray) -> np.ndarray:
    """Codeword indices (12 bits) of the 1 or 6 codewords near each 23-bit segment; the
    nearest comes first, -1 pads."""
    errors = _ERRORS[_syndromes(segments)]
    words = segments.astype(np.int64)[:, None] ^ errors
    # The code is systematic in its upper 12 bits: they tell codewords apart.
    return np.where(errors >= 0, words >> 11, -1)


def file_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, position of the fingerprint, whether it is at home there) for all filings."""
    values = prints.astype(np.uint64)
    segments, fuzzy = [], []
    for shift, width in _SEGMENTS:
        part = ((values >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
        segments.append(part)
        fuzzy.append(fuzzy_keys(part))
    keys, owners, homes = [], [], []
    everyone = np.arange(len(values))

    def add(key, owner, home):
        keys.append(key)
        owners.append(owner)
        homes.append(home)

    for family, (i, j) in enumerate(combinations(range(3), 2)):
        for p in range(6):
            for q in range(6):
                ok = (fuzzy[i][:, p] >= 0) & (fuzzy[j][:, q] >= 0)
                key = family << 56 | fuzzy[i][ok, p] << 12 | fuzzy[j][ok, q]
                add(key, everyone[ok], np.full(len(key), p == 0 and q == 0))
    for family, (i, j) in enumerate(permutations(range(3), 2), start=3):
        for p in range(6):
            ok = fuzzy[j][:, p] >= 0
            key = family << 56 | segments[i][ok] << 12 | fuzzy[j][ok, p]
            add(key, everyone[ok], np.ones(len(key), bool))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(homes)


# ---- fingerprints ------------------------------------------------------------------------------


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[list[int], np.ndarray]:
    """XXH64 of every shingle, document after document, and shingles per document."""
    solid = ~_BLANK[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = solid[edges]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    closes[last] = solid[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    first = np.searchsorted(starts, offsets)
    per_doc = np.diff(first)
    # Every word with one blank before it: a shingle is one run of this text.
    lengths = ends - starts + 1
    places = np.cumsum(lengths) - lengths
    packed = np.full(int(lengths.sum()), 32, np.uint8)
    packed[ragged(places + 1, lengths - 1)] = _LOWER[data[ragged(starts, lengths - 1)]]
    counts = np.where(per_doc >= words, per_doc - words + 1, np.minimum(per_doc, 1))
    head = ragged(first[:-1], counts)
    tail = np.minimum(head + words, np.repeat(first[1:], counts)) - 1
    raw, h = packed.tobytes(), xxhash.xxh64_intdigest
    spans = zip((places[head] + 1).tolist(), (places[tail] + lengths[tail]).tolist(), strict=True)
    return [h(raw[a:b], _SEED) for a, b in spans], counts


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A bit is set where over half of a document's hashes have it; 0 without hashes."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(counts) - counts)[some]
        votes = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        won = votes * 2 > counts[some, None]
        out[some] = np.packbits(won, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(
    docs: DataFrame, keep: list[str], text_col: str = "text", words: int = 4, out: str = "fingerprint"
) -> DataFrame:
    """Columns ``keep`` and the 64-bit fingerprint of every whole text as a long.

    Words are runs of anything but ASCII blanks, A-Z in lower case.  A text of
    fewer than ``words`` words is one shingle; null and empty texts have none and
    get fingerprint 0.
    """

    def work(part, data, offsets):
        hashes, counts = shingle_hashes(data, offsets, words)
        found = majority_bits(np.array(hashes, np.uint64), counts)
        return [pa.array(found.view(np.int64))]

    return map_texts(docs, keep, plain_text(text_col), f"`{out}` long", work)


# ---- links -----------------------------------------------------------------------------------------


def _bucket_links(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member of its component) within one bucket, breadth first.

    Members found once are not compared again as targets, so a crowd of near
    copies costs little more than one pass.
    """
    prints = np.unique(prints)
    free = np.ones(len(prints), bool)
    members, roots = [], []
    for k in range(len(prints)):
        if not free[k]:
            continue
        free[k] = False
        queue, rest = [prints[k]], prints[free]
        at = np.flatnonzero(free)
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= bits
            if near.any():
                queue.extend(rest[near])
                members.append(rest[near])
                roots.append(np.full(int(near.sum()), prints[k]))
                free[at[near]] = False
                rest, at = rest[~near], at[~near]
    none = np.zeros(0, np.uint64)
    return np.concatenate(members or [none]), np.concatenate(roots or [none])


def _run_links(key, prints, home, bits) -> tuple[np.ndarray, np.ndarray]:
    """Links within whole runs of equal keys."""
    cuts = np.flatnonzero(np.diff(key)) + 1
    starts = np.append(0, cuts)
    sizes = np.diff(np.append(starts, len(key)))
    left, right = [], []
    small = np.repeat((sizes <= _SMALL_RUN) & (sizes > 1), sizes) & home
    at = np.flatnonzero(small)
    run = np.repeat(np.arange(len(sizes)), sizes)[at]
    for lo in range(0, len(at), 1 << 16):
        own, of = at[lo : lo + (1 << 16)], run[lo : lo + (1 << 16)]
        other = ragged(starts[of], sizes[of])
        own = np.repeat(own, sizes[of])
        a, b = prints[own], prints[other]
        near = (a != b) & (np.bitwise_count(a ^ b) <= bits)
        left.append(np.maximum(a[near], b[near]))
        right.append(np.minimum(a[near], b[near]))
    for k in np.flatnonzero(sizes > _SMALL_RUN):
        a, b = _bucket_links(prints[starts[k] : starts[k] + sizes[k]], bits)
        left.append(a)
        right.append(b)
    none = np.zeros(0, np.uint64)
    links = np.stack([np.concatenate(left or [none]), np.concatenate(right or [none])], axis=1)
    links = np.unique(links, axis=0)
    return links[:, 0], links[:, 1]


def _linker(bits: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []  # batches since the start of the last open run

        def links(columns):
            a, b = _run_links(*columns, bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(
                [numbers(batch, "bucket"), numbers(batch, "print").view(np.uint64), numbers(batch, "home")]
            )
            if waiting[0][0][0] == waiting[-1][0][-1]:
                continue
            joined = [np.concatenate(c) for c in zip(*waiting, strict=True)]
            cut = int(np.searchsorted(joined[0], joined[0][-1]))
            waiting = [[c[cut:] for c in joined]]
            yield links([c[:cut] for c in joined])
        if waiting:
            yield links([np.concatenate(c) for c in zip(*waiting, strict=True)])

    return run


def _filed(prints: DataFrame) -> DataFrame:
    """(key, print, home): all filings of the distinct fingerprints."""
    schema = pa.schema([("key", pa.int64()), ("print", pa.int64()), ("home", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                own = numbers(batch.slice(lo, 2048), "print")
                keys, at, home = file_keys(own.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(own[at]), pa.array(home)], schema=schema
                )

    return prints.mapInArrow(run, "key long, print long, home boolean")


def near_links(prints: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """(a, b): links that join all distinct fingerprints (column ``print``) within ``bits`` bits.

    Not every close pair is listed, but the components are those of all close
    pairs.  Keys that would gather very many fingerprints are found on one
    fingerprint in 64; their members are dealt to parts and every two parts meet
    in a task of their own, so the answer does not depend on that estimate.
    """
    if bits > MOST_BITS:
        raise ValueError(f"the filing scheme covers up to {MOST_BITS} bits")
    ahead = prints.where(F.pmod(F.xxhash64(F.lit(1), "print"), F.lit(_HOT_SHARE)) == 0)
    crowded = _filed(ahead).groupBy("key").count().where(F.col("count") * _HOT_SHARE > _PART)
    crowded = stage(
        crowded.select("key", F.ceil(F.col("count") * _HOT_SHARE / _PART).cast("int").alias("parts")),
        "crowded-keys",
    )
    part = F.pmod(F.xxhash64(F.lit(2), "print"), F.col("parts")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.xxhash64("key", F.least(other, part), F.greatest(other, part)),
    )
    dealt = (
        _filed(prints)
        .join(crowded, "key", "left")
        .withColumn(
            "bucket",
            F.explode(F.when(F.col("parts") > 1, meets).otherwise(F.array(F.xxhash64("key")))),
        )
        .select("bucket", "print", "home")
    )
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_linker(bits), "a long, b long")


def _components(docs: DataFrame, keep: list[str], id_col: str, text_col: str, words: int, bits: int) -> DataFrame:
    """Columns ``keep``, __print, __root (one per component) and component_id of every document."""
    hashed = stage(fingerprints(docs, keep, text_col, words, "__print"), "fingerprints")
    distinct = stage(
        hashed.groupBy(F.col("__print").alias("print")).agg(F.min(id_col).alias("least")), "prints"
    )
    roots = connected(near_links(distinct.select("print"), bits))
    grouped = distinct.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("__root")
    )
    component = grouped.groupBy("__root").agg(F.min("least").alias("component_id"))
    named = grouped.join(component, "__root").select("print", "__root", "component_id")
    return hashed.join(named, F.col("__print") == F.col("print")).drop("print")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, bits: int = MOST_BITS
) -> DataFrame:
    """(id, fingerprint, component_id) of every document.

    Documents are linked when their fingerprints differ in at most ``bits`` bits;
    the component is the smallest id that links reach.  Documents without words
    share fingerprint 0 and are linked like any others.  Rows without id are
    linked too, but never name a component that has an id.
    """
    found = _components(docs.select(id_col, text_col), [id_col], id_col, text_col, words, bits)
    return found.select(id_col, F.col("__print").alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, bits: int = MOST_BITS
) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, and of its texts the least hash.

    A repeated row stays once.
    """
    text_hash = F.xxhash64(plain_text(text_col))
    keyed = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), text_hash.alias("__k2"))
    found = _components(keyed, ["__id", "__k2"], "__id", "__text", words, bits)
    first = F.min(F.struct(F.col("__id").isNull(), "__id", "__k2")).alias("first")
    stays = found.groupBy("__root").agg(first).select(
        F.xxhash64("first.__id").alias("__k1"), F.col("first.__k2").alias("__k2")
    )
    # The input travels as one column, so that its names cannot meet the names used here.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    marked = docs.select(F.xxhash64(F.col(id_col)).alias("__k1"), text_hash.alias("__k2"), row)
    kept = marked.join(stays, ["__k1", "__k2"], "left_semi").dropDuplicates(["__k1", "__k2"])
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
