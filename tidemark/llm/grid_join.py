"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine c or more lie within eps = sqrt(2 - 2c), and so do their
projections on the principal directions.  Cut into cells of width eps along the
leading ones, vectors are sorted by (label, cells), and this sequence is stored in
blocks with the box that their projections span.  Only blocks whose boxes lie
within eps are joined: a task halves the two sequence intervals, drops halves whose
boxes lie further apart, and compares what is left exactly.

A pair of blocks travels as two numbers; the vectors of one of the two follow it to
the other.  Blocks are as long as a task can well hold, since twice the length
halves what is sent: where the directions separate nothing, that is the square of
a label's vectors over the length of a block.

Equal vectors are joined once.  A block pair gives at most one row per vector, its
links there and the smallest vector it reaches there, and holds a bounded number of
links while it counts, so a crowd of near copies makes no list of pairs.  Inside the
join a distinct vector goes by a key of its own, as ids may be null or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.rows import numbers
from tidemark.session import stage

_BLOCK = 4096  # vectors of a block at most,
_BLOCK_BYTES = 2 << 20  # and their bytes
_LEAF = 128
_DIRECTIONS = 6  # that the cells are cut along
_BOX_DIRECTIONS = 16  # that the boxes are measured along
_LEAST_CELL = 0.01
_PAIRS = 1 << 18  # links held before they are counted
_SAMPLE = 4096


def principal_directions(sample: np.ndarray, count: int) -> np.ndarray:
    """Orthonormal columns along which centred unit vectors vary most."""
    units = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    centred = units - units.mean(axis=0)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    return vectors[:, ::-1][:, :count]


def _projected(directions: dict[int, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Units of ``rows`` along their directions; a dimension without any uses its first coordinates."""
    dim = rows.shape[1]
    axes = directions.get(dim, np.eye(dim)[:, :_BOX_DIRECTIONS])
    out = np.zeros((len(rows), _BOX_DIRECTIONS))
    out[:, : axes.shape[1]] = rows / np.linalg.norm(rows, axis=1, keepdims=True) @ axes
    return out


def _vectors(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(batch.schema.get_field_index(name))
    lengths = np.asarray(column.value_lengths())
    return np.asarray(column.flatten(), np.float64), lengths


def _cells(directions: dict[int, np.ndarray], width: float):
    """Adds the grid cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, lengths = _vectors(batch, "vector")
            ends = np.cumsum(lengths)
            cells = np.zeros((batch.num_rows, _DIRECTIONS), np.int32)
            for dim in np.unique(lengths):
                own = np.flatnonzero(lengths == dim)
                rows = np.stack([values[e - dim : e] for e in ends[own]])
                cells[own] = np.floor(_projected(directions, rows)[:, :_DIRECTIONS] / width)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c) for c in cells.T)],
                names=[*batch.schema.names, *(f"c{i}" for i in range(_DIRECTIONS))],
            )

    return run


def _blocks(directions: dict[int, np.ndarray], most: int):
    """Consecutive rows of one label and dimension, at most ``most`` a row."""
    schema = pa.schema(
        [("label", pa.string()), ("dim", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))]
        + [(c, pa.binary()) for c in ("keys", "times", "vectors")]
    )

    def pack(label, dim, part):
        keys, times, vectors = (np.concatenate(p) for p in zip(*part, strict=True))
        points = _projected(directions, vectors.reshape(-1, dim))
        return {
            "label": label, "dim": dim, "low": points.min(axis=0).tolist(), "high": points.max(axis=0).tolist(),
            "keys": keys.tobytes(), "times": times.tobytes(), "vectors": vectors.tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, part, size = None, [], 0
        for batch in batches:
            values, lengths = _vectors(batch, "vector")
            ends = np.cumsum(lengths)
            labels = batch.column(batch.schema.get_field_index("label")).to_pylist()
            keys, times = numbers(batch, "key"), numbers(batch, "times")
            k = 0
            while k < batch.num_rows:
                group = (labels[k], int(lengths[k]))
                room = max(1, min(most, _BLOCK_BYTES // (8 * group[1])))
                if open_ is not None and (group != open_ or size == room):
                    yield pa.RecordBatch.from_pylist([pack(*open_, part)], schema=schema)
                    part, size = [], 0
                open_ = group
                end = k
                while end < batch.num_rows and end - k < room - size and (labels[end], lengths[end]) == group:
                    end += 1
                part.append((keys[k:end], times[k:end], values[ends[k] - lengths[k] : ends[end - 1]]))
                size += end - k
                k = end
        if part:
            yield pa.RecordBatch.from_pylist([pack(*open_, part)], schema=schema)

    return run


def _boxes(points: np.ndarray):
    """The box of an interval; halving meets the same few intervals again and again."""

    @cache
    def box(low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        part = points[low:high]
        return part.min(axis=0), part.max(axis=0)

    return box


def _interval_join(points_a, points_b, reach: float, compare, same: bool) -> None:
    """Recursively halve two sequence intervals; ``compare`` gets the leaves that may hold links."""
    box_a, box_b = _boxes(points_a), _boxes(points_b)

    def go(a0, a1, b0, b1):
        if same and b1 <= a0:
            return  # the mirrored half was joined
        (low_a, high_a), (low_b, high_b) = box_a(a0, a1), box_b(b0, b1)
        gap = np.maximum(np.maximum(low_a - high_b, low_b - high_a), 0)
        if gap @ gap > reach * reach:
            return
        if a1 - a0 <= _LEAF and b1 - b0 <= _LEAF:
            compare(a0, a1, b0, b1)
        elif a1 - a0 >= b1 - b0:
            middle = (a0 + a1) // 2
            go(a0, middle, b0, b1)
            go(middle, a1, b0, b1)
        else:
            middle = (b0 + b1) // 2
            go(a0, a1, b0, middle)
            go(a0, a1, middle, b1)

    go(0, len(points_a), 0, len(points_b))


def _joined_roots(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of every class once the links (i, j) are added to the classes ``roots``."""
    while True:
        both = np.minimum(roots[i], roots[j])
        after = roots.copy()
        np.minimum.at(after, roots[i], both)
        np.minimum.at(after, roots[j], both)
        after = after[after]
        if (after == roots).all():
            return roots
        roots = after


def _opened(row: dict, side: str):
    keys = np.frombuffer(row[f"keys_{side}"], np.int64)
    vectors = np.frombuffer(row[f"vectors_{side}"], np.float64).reshape(len(keys), -1)
    return keys, np.frombuffer(row[f"times_{side}"], np.int64), vectors


def _pair_links(
    row: dict, directions: dict[int, np.ndarray], least: float, reach: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, links, smallest key reached) of the linked vectors of two blocks."""
    same = row["block_a"] == row["block_b"]
    keys_a, times_a, rows_a = _opened(row, "a")
    keys_b, times_b, rows_b = _opened(row, "b")
    norm_a, norm_b = np.linalg.norm(rows_a, axis=1), np.linalg.norm(rows_b, axis=1)
    keys = keys_a if same else np.concatenate([keys_a, keys_b])
    times = times_a if same else np.concatenate([times_a, times_b])
    offset = 0 if same else len(keys_a)
    links, roots = np.zeros(len(keys)), np.arange(len(keys))
    left, right, held = [], [], 0

    def settle():
        nonlocal links, roots, held
        i, j = np.concatenate(left), np.concatenate(right)
        links = links + np.bincount(i, times[j], len(keys)) + np.bincount(j, times[i], len(keys))
        roots = _joined_roots(roots, i, j)
        left.clear()
        right.clear()
        held = 0

    def compare(a0, a1, b0, b1):
        nonlocal held
        cosine = rows_a[a0:a1] @ rows_b[b0:b1].T / np.outer(norm_a[a0:a1], norm_b[b0:b1])
        i, j = np.nonzero(cosine >= least)
        i, j = i + a0, j + b0
        if same:
            i, j = i[i < j], j[i < j]
        if len(i):
            left.append(i)
            right.append(j + offset)
            held += len(i)
        if held >= _PAIRS:
            settle()

    _interval_join(_projected(directions, rows_a), _projected(directions, rows_b), reach, compare, same)
    if left:
        settle()
    lowest = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(lowest, roots, keys)
    linked = np.flatnonzero(links)
    return keys[linked], links[linked].astype(np.int64), lowest[roots[linked]]


def _joiner(directions: dict[int, np.ndarray], least: float, reach: float):
    schema = pa.schema([("key", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = _pair_links(batch.slice(k, 1).to_pylist()[0], directions, least, reach)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], schema=schema)

    return run


def near_vectors(
    table: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector.

    Vectors of one label and one length are linked at cosine ``least`` or more, in
    double precision.  Null, empty or zero vectors, vectors with null or non-finite
    components and vectors without label have no links and are their own
    component.  n_links counts the other rows linked directly.

    Rows with null id, and rows that share one, are linked and counted like all
    others.  component_id is the least id of the component that is not null, and
    null if it has none.  kept marks the rows with that id; in a component without
    any id it marks the rows of its vector with the least hash.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine must lie in (0, 1]")
    vector = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(label_col).isNotNull()
        & F.col(vector_col).isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )
    keys = [F.col(label_col).cast("string").alias("label"), F.xxhash64(vector).alias("h1"), F.xxhash64(F.lit(1), vector).alias("h2")]
    sound = table.where(F.coalesce(usable, F.lit(False)))
    distinct = stage(
        sound.select(F.col(id_col).cast("long").alias("id"), *keys, vector.alias("vector"))
        .groupBy("label", "h1", "h2")
        .agg(F.min("id").alias("id"), F.count("*").alias("times"), F.first("vector").alias("vector"))
        # Written once, so every branch reads the same keys.
        .withColumn("key", F.monotonically_increasing_id()),
        "distinct-vectors",
    )
    # A little more than the distance, for what rounding does to a cosine near 1.
    reach = float(np.sqrt(2 - 2 * least)) * (1 + 1e-9) + 1e-7
    width = max(reach, _LEAST_CELL)
    directions = _directions(distinct)
    celled = distinct.select("label", "key", "times", "vector").mapInArrow(
        _cells(directions, width),
        "label string, key long, times long, vector array<double>, "
        + ", ".join(f"c{i} int" for i in range(_DIRECTIONS)),
    )
    order = ["label", F.size("vector"), *(f"c{i}" for i in range(_DIRECTIONS)), "key"]
    blocks = stage(
        celled.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _blocks(directions, _BLOCK),
            "label string, dim int, low array<double>, high array<double>, keys binary, times binary, vectors binary",
        ).withColumn("block", F.monotonically_increasing_id()),
        "vector-blocks",
    )
    joined = _touching(blocks, reach, width)
    for side in "ab":
        held = ["keys", "times", "vectors"]
        joined = joined.join(
            blocks.select(F.col("block").alias(f"block_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in held)),
            f"block_{side}",
        )
    found = stage(joined.mapInArrow(_joiner(directions, least, reach), "key long, links long, root long"), "vector-links")
    roots = connected(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    degrees = found.groupBy("key").agg(F.sum("links").alias("links"))
    rooted = stage(
        distinct.select("label", "h1", "h2", "id", "key", "times")
        .join(degrees, "key", "left")
        .join(roots, F.col("key") == F.col("node"), "left")
        .select(
            "label", "h1", "h2", "id",
            (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links"),
            F.coalesce("root", "key").alias("root"),
        ),
        "rooted-vectors",
    )
    # Stored, so that the join below reads both sides from a shuffle and a large component can be split.
    first = F.min(F.struct(F.col("id").isNull(), "id", "h1", "h2")).alias("first")
    firsts = stage(rooted.groupBy("root").agg(first), "components")
    named = rooted.join(firsts, "root").select(
        F.col("label").alias("__label"), F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), "links",
        F.col("first.id").alias("least"),
        ((F.col("h1") == F.col("first.h1")) & (F.col("h2") == F.col("first.h2"))).alias("leads"),
    )
    rows = table.select(
        F.col(id_col).alias("__id"),
        *(F.when(F.coalesce(usable, F.lit(False)), k).alias(f"__k{i}") for i, k in enumerate(keys)),
    )
    matched = rows.join(
        named,
        (F.col("__k0") == F.col("__label")) & (F.col("__k1") == F.col("__h1")) & (F.col("__k2") == F.col("__h2")),
        "left",
    )
    own = F.col("__id").cast("long")
    component = F.when(F.col("__label").isNull(), own).otherwise(F.col("least"))
    without_id = F.coalesce("leads", F.lit(True))
    return matched.select(
        F.col("__id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.when(component.isNull(), without_id).otherwise(F.coalesce(own == component, F.lit(False))).alias("kept"),
    )


def _directions(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Principal directions per vector length, from a bounded sample; they only steer the pruning."""
    rows = distinct.orderBy("h1", "h2", "label").limit(_SAMPLE).select("vector").toArrow().column("vector")
    by_dim: dict[int, list] = {}
    for row in rows:
        values = np.asarray(row.values, np.float64)
        by_dim.setdefault(len(values), []).append(values)
    return {d: principal_directions(np.stack(v), min(d, _BOX_DIRECTIONS)) for d, v in by_dim.items() if len(v) > d}


def _touching(blocks: DataFrame, reach: float, width: float) -> DataFrame:
    """(block_a, block_b) of one label and length whose boxes lie within ``reach``, each pair once.

    A block is first as often as last, so that none gathers the vectors of all others.
    """
    box = blocks.select("label", "dim", "block", "low", "high")
    low, high = (F.floor(F.col(c)[0] / width) for c in ("low", "high"))
    a = box.select(
        "label", "dim", F.col("block").alias("block_a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"),
        F.explode(F.sequence(low - 1, high + 1)).alias("first"),
    )
    b = box.select(
        "label", "dim", F.col("block").alias("block_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"),
        F.explode(F.sequence(low, high)).alias("first"),
    )
    gaps = [
        F.greatest(F.col("low_a")[i] - F.col("high_b")[i], F.col("low_b")[i] - F.col("high_a")[i], F.lit(0.0))
        for i in range(_BOX_DIRECTIONS)
    ]
    near = sum(g * g for g in gaps) <= reach * reach
    met = a.join(b, ["label", "dim", "first"]).where((F.col("block_a") <= F.col("block_b")) & near)
    turned = (F.col("block_a") + F.col("block_b")) % 2 == 1
    return met.select("block_a", "block_b").distinct().select(
        F.when(turned, F.col("block_b")).otherwise(F.col("block_a")).alias("block_a"),
        F.when(turned, F.col("block_a")).otherwise(F.col("block_b")).alias("block_b"),
    )
