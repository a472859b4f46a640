"""Hard negatives: rows of another label that score almost as high as an anchor's positives.

Vectors are integers, a score is their inner product.  Anchors and candidates are packed
into blocks of rows sorted by label.  Every anchor block meets every candidate block in a
tile of its own, whose scores come from Strassen's recursive multiplication on int64: the
sides are padded with zeros to even lengths, seven half-size products are taken, and sums
are exact integers.

A tile keeps the best rows per anchor, tiles of one task are merged as they come, and the
merged heaps of all tasks once more by rank, so no task sees all candidates of an anchor.
The first pass builds the heap of positives (tiles without a common label are not
multiplied), the second one heap for each window of scores that a positive opens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.llm.rows import numbers
from tidemark.session import stage

_LEAF = 32  # side below which a product is taken directly
_ROWS, _ANCHORS = 1024, 512  # rows of a block; its bytes are bounded too
_BYTES = 1 << 20
_GROUP = 2048  # rows of one side that meet in a group, on average


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = _LEAF) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact modulo 2^64."""
    (m, d), n = a.shape, len(b)
    if min(m, d, n) <= leaf:
        return np.einsum("ik,jk->ij", a, b)
    if m % 2 or d % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, d % 2)))
        b = np.pad(b, ((0, n % 2), (0, d % 2)))
        return strassen(a, b, leaf)[:m, :n]
    m, d, n = m // 2, d // 2, n // 2
    a11, a12, a21, a22 = a[:m, :d], a[:m, d:], a[m:, :d], a[m:, d:]
    # Blocks of the transposed second factor.
    b11, b21, b12, b22 = b[:n, :d], b[:n, d:], b[n:, :d], b[n:, d:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """The best ``size`` candidates per slot: score first, then place in the order of ties."""

    def __init__(self, size: int):
        self.size = size
        self.rows = np.zeros((0, 5), np.int64)  # slot, score, id is null, id, row

    def push(self, scores: np.ndarray, usable: np.ndarray, slots: np.ndarray, ties: np.ndarray) -> None:
        """Add a tile: ``scores`` per slot and candidate, ``ties`` (id is null, id, row) ascending."""
        if scores.shape[1] > self.size:
            ranked = np.where(usable, scores, np.iinfo(np.int64).min)
            place = scores.shape[1] - self.size
            usable = usable & (ranked >= np.partition(ranked, place, axis=1)[:, place, None])
        row, column = np.nonzero(usable)
        self.merge(np.column_stack([slots[row], scores[row, column], ties[column]]))

    def merge(self, rows: np.ndarray) -> None:
        rows = np.concatenate([self.rows, rows])
        rows = rows[np.lexsort((rows[:, 4], rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        first = np.ones(len(rows), bool)
        first[1:] = np.diff(rows[:, 0]) != 0
        begin = np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))
        self.rows = rows[np.arange(len(rows)) - begin < self.size]


# ---- blocks ---------------------------------------------------------------------------------

_BLOCK = "dim int, many int, labels binary, ids binary, nulls binary, keys binary, vectors binary"


def _packed(rows: DataFrame, most: int, tag: str, extra: str | None = None) -> DataFrame:
    """Stored blocks of at most ``most`` rows of one length, sorted by label within tasks, each
    with a ``number``; ``extra`` is an array column that is packed beside the vectors."""
    names = ["label", "id", "key", "vector", *([extra] if extra else [])]
    spread = rows.select(*names).repartitionByRange("label", F.xxhash64("key")).sortWithinPartitions("label", "key")
    out = _BLOCK + (", extra array<array<array<bigint>>>" if extra else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3)
            dims = np.asarray(vectors.value_lengths())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(dims)
            label, key = numbers(batch, "label"), numbers(batch, "key")
            ids = batch.column(1)
            nulls = np.asarray(ids.is_null())
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            cells = []
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                size = max(1, min(most, _BYTES // max(8 * dim, 1)))
                for low in range(0, len(at), size):
                    own = at[low : low + size]
                    own = own[np.lexsort((key[own], ids[own], nulls[own]))]
                    matrix = flat[(ends[own] - dim)[:, None] + np.arange(dim)]
                    cells.append(
                        [dim, len(own)]
                        + [np.ascontiguousarray(x, np.int64).tobytes() for x in (label[own], ids[own], nulls[own], key[own], matrix)]
                        + ([batch.column(4).take(pa.array(own)).to_pylist()] if extra else [])
                    )
            if cells:
                kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5 + ([pa.list_(pa.list_(pa.list_(pa.int64())))] if extra else [])
                fields = ["dim", "many", "labels", "ids", "nulls", "keys", "vectors"] + (["extra"] if extra else [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*cells, strict=True), kinds, strict=True)], names=fields
                )

    return stage(spread.mapInArrow(run, out).withColumn("number", F.monotonically_increasing_id()), tag)


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(labels, keys, vectors, ties) of a block."""
    labels, ids, nulls, keys = (np.frombuffer(row[c], np.int64) for c in ("labels", "ids", "nulls", "keys"))
    return labels, keys, np.frombuffer(row["vectors"], np.int64).reshape(row["many"], row["dim"]), np.column_stack([nulls, ids, keys])


def _dealt(blocks: DataFrame, name: str, parts: int, other: str, copies: int) -> DataFrame:
    """Blocks dealt over ``parts`` values of ``name``, with a copy for each of ``copies`` of ``other``."""
    return blocks.select(
        *blocks.columns,
        F.pmod(F.xxhash64("number"), F.lit(parts)).cast("int").alias(name),
        F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other),
    )


def _best(
    anchors: DataFrame, candidates: DataFrame, sizes: tuple[int, int], size: int,
    tile: Callable[[Heaps, dict, tuple], None],
) -> DataFrame:
    """(slot, score, id, key, place): the first ``size`` candidates of every slot.

    Both sides are cut into shares of bounded size and every pair of shares is a group;
    ``tile`` pushes one pair of blocks into the heap of the anchor block.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("slot", "score", "without", "id", "key")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks = [_opened(row) for row in right.to_pylist()]
        done = [np.zeros((0, 5), np.int64)]
        for row in left.to_pylist():
            heap = Heaps(size)
            for block in blocks:
                if block[2].shape[1] == row["dim"]:
                    tile(heap, row, block)
            done.append(heap.rows)
        rows = np.concatenate(done)
        return pa.table([pa.array(rows[:, i]) for i in range(5)], schema=schema)

    shares, chunks = (max(1, -(-n // _GROUP)) for n in sizes)
    a = _dealt(anchors, "share", shares, "chunk", chunks)
    c = _dealt(candidates, "chunk", chunks, "share", shares)
    found = a.groupBy("share", "chunk").cogroup(c.groupBy("share", "chunk")).applyInArrow(
        run, "slot long, score long, without long, id long, key long"
    )
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "without", "id", "key")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size).select(
        "slot", "score", F.when(F.col("without") == 0, F.col("id")).alias("id"), "key", "place"
    )


def _positive_tile(heap: Heaps, row: dict, block: tuple) -> None:
    labels, keys, vectors, _ = _opened(row)
    theirs, their_keys, others, ties = block
    if np.isin(labels, theirs).any():
        usable = (labels[:, None] == theirs) & (keys[:, None] != their_keys)
        heap.push(strassen(vectors, others), usable, keys, ties)


def _window_tile(heap: Heaps, row: dict, block: tuple) -> None:
    labels, _, vectors, _ = _opened(row)
    theirs, _, others, ties = block
    apart = labels[:, None] != theirs
    if not apart.any():
        return
    scores = strassen(vectors, others)
    # Windows of one rank side by side: one slot per anchor.
    for rank in range(max(map(len, row["extra"]))):
        own = np.array([i for i, w in enumerate(row["extra"]) if len(w) > rank])
        slot, low, high = np.array([row["extra"][i][rank] for i in own], np.int64).T
        part = scores[own]
        heap.push(part, apart[own] & (part >= low[:, None]) & (part <= high[:, None]), slot, ties)


# ---- rows -----------------------------------------------------------------------------------


def _label_numbers(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label`` as a number; equal labels have equal numbers."""
    if isinstance(rows.schema["label"].dataType, IntegralType):
        return rows.withColumn("label", F.col("label").cast("long"))
    known = stage(
        rows.select("label").distinct().withColumn("of_label", F.monotonically_increasing_id()), "labels"
    )
    return rows.join(known, "label").drop("label").withColumnRenamed("of_label", "label")


def mine_negatives(
    table: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    label: Column | str = "label", scale: float = 256.0, positives: int = 5, negatives: int = 5,
    low: int = 80, high: int = 100,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become ``floor(scale * x)``, a score is the inner product (it must fit
    into 64 bits).  Higher scores come first, then smaller ids, then null ids.  The
    positives of an anchor are its first ``positives`` other rows of the same label; to
    each belong the first ``negatives`` rows of another label whose score is from
    low / high of the positive's score up to it.  A negative positive score leaves no
    such window, unless low equals high.

    Rows with a null label, a null vector, or a null or non-finite component take no
    part; vectors of different lengths do not meet.  Repeated rows are rows of their
    own, as anchors, positives and negatives; a null id is kept as null.  Without
    anchors, partners or rows the result is empty.  Other columns are not looked at.
    """
    if not 0 <= low <= high or high < 1:
        raise ValueError("the window needs 0 <= low <= high")
    finite = F.forall(
        F.col(vector_col), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    label = F.col(label) if isinstance(label, str) else label
    rows = table.select(
        F.col(id_col).cast("long").alias("id"),
        label.alias("label"),
        F.when(finite, F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale))).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).where(F.col("label").isNotNull() & F.col("vector").isNotNull())
    # Written once, so every branch reads the same keys.
    rows = stage(_label_numbers(rows).withColumn("key", F.monotonically_increasing_id()), "scored-vectors")
    anchors = rows.where("anchor")
    sizes = rows.agg(F.count_if("anchor"), F.count("*")).first()
    candidates = _packed(rows, _ROWS, "candidate-blocks")
    found = stage(
        _best(_packed(anchors, _ANCHORS, "anchor-blocks"), candidates, sizes, positives, _positive_tile)
        .withColumnsRenamed({"slot": "anchor_key", "score": "positive_score", "id": "positive_id"}),
        "positives",
    )
    product = F.col("positive_score").cast("decimal(38,0)") * low
    windows = stage(
        found.select("anchor_key", "positive_score").distinct()
        .withColumn("least", ((product + F.pmod(-product, F.lit(high))) / high).cast("long"))
        .withColumn("slot", F.monotonically_increasing_id()),
        "score-windows",
    )
    # At most ``positives`` windows an anchor.
    opened = windows.groupBy(F.col("anchor_key").alias("key")).agg(
        F.collect_list(F.array("slot", "least", "positive_score")).alias("windows")
    )
    opening = _packed(anchors.join(opened, "key"), _ANCHORS, "opening-blocks", "windows")
    hard = _best(opening, candidates, sizes, negatives, _window_tile).select(
        "slot", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), F.col("place").alias("rank")
    )
    named = found.join(anchors.select(F.col("id").alias("anchor_id"), F.col("key").alias("anchor_key")), "anchor_key")
    return (
        named.join(windows, ["anchor_key", "positive_score"])
        .join(hard, "slot")
        .select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
            "positive_score", "negative_score",
        )
    )
