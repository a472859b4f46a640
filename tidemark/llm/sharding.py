"""Shards of near-equal bytes by sampled splitters.

Records are ordered by (hash of the text, hash of the id), so equal texts stand
together.  A sample of keys, drawn with a chance in proportion to their bytes,
gives the quantiles that cut this order into many fine ranges; a range that
still turns out overfull is cut again from a sample of its own.  Exact byte
counts per range then decide which run of ranges makes a shard.  A cut falls
between groups of equal texts wherever that keeps the shards near equal; only a
group that is itself large against a shard is cut inside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.columnar import plain_text
from tidemark.llm.rows import numbers
from tidemark.session import stage

_RANGES_PER_SHARD = 512
_SAMPLES_PER_RANGE = 32
_OVERFULL = 2.0  # times the expected bytes
_ROUNDS = 4
_EDGE_SLACK = 0.003  # of a shard: how far a cut may move to spare a group
_LOWEST = -(1 << 63)


def _draw(keys: DataFrame, samples: float, total: int, seed: int) -> np.ndarray:
    """(group, member, weight) of about ``samples`` keys, chance in proportion to their bytes.

    At most twice as many come back: those drawn, and those that hold over one
    sample's worth of bytes and are taken surely, with their weight.
    """
    worth = F.col("bytes") * F.lit(samples / max(total, 1))
    place = F.pmod(F.xxhash64(F.lit(seed), "group", "member"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = keys.where(place < worth).select("group", "member", F.greatest(worth, F.lit(1.0)).alias("w"))
    table = rows.toArrow()
    out = np.zeros(table.num_rows, [("group", "i8"), ("member", "i8"), ("w", "f8")])
    for c in out.dtype.names:
        out[c] = table.column(c).to_numpy()
    return np.sort(out, order=["group", "member"])


def _quantiles(sample: np.ndarray, ranges: int) -> set[tuple[int, int]]:
    """Boundaries that cut the sample into ``ranges`` of equal weight.

    A boundary stands before a whole group unless the group has several of them.
    """
    if not len(sample):
        return set()
    running = np.cumsum(sample["w"])
    at = np.searchsorted(running, running[-1] * np.arange(1, ranges) / ranges, side="right")
    at = np.unique(np.minimum(at, len(sample) - 1))
    groups, times = np.unique(sample["group"][at], return_counts=True)
    often = set(groups[times > 1].tolist())
    out = {(g, _LOWEST) for g in groups.tolist()}
    return out | {
        (g, m) for g, m in zip(sample["group"][at].tolist(), sample["member"][at].tolist(), strict=True) if g in often
    }


def _ranger(bounds: list[tuple[int, int]]):
    """Adds the number of boundaries at or before a row's key."""
    groups = np.array([g for g, _ in bounds], np.int64)
    members = np.array([m for _, m in bounds], np.int64)

    def find(group: np.ndarray, member: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(groups, group, "left"), np.searchsorted(groups, group, "right")
        out = high.copy()
        tied = np.flatnonzero(high - low > 0)
        for a in np.unique(low[tied]):
            own = tied[low[tied] == a]
            out[own] = a + np.searchsorted(members[a : high[own[0]]], member[own], "right")
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find(numbers(batch, "group"), numbers(batch, "member"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "range"])

    return run


def _ranged(rows: DataFrame, bounds: set[tuple[int, int]]) -> DataFrame:
    return rows.mapInArrow(_ranger(sorted(bounds)), rows.schema.simpleString()[7:-1] + ",range:bigint")


def choose_cuts(sizes: list[int], edges: list[bool], shards: int) -> list[int]:
    """Ranges that begin a shard: the nearest cuts to equal bytes, between groups if that is near enough.

    ``edges[i]`` tells whether range i begins with a new group.
    """
    before = np.concatenate([[0], np.cumsum(sizes)]).astype(float)
    target = before[-1] / shards
    edge = np.array([*edges, True])
    cuts, least = [], 0
    for s in range(1, shards):
        away = np.abs(before - target * s)
        away[:least] = np.inf
        best = int(np.argmin(away))
        spare = np.where(edge, away, np.inf)
        whole = int(np.argmin(spare))
        least = whole if spare[whole] <= max(away[best], _EDGE_SLACK * target) else best
        cuts.append(least)
    return cuts


def assign_shards(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, shard, slot): shards of near-equal bytes.

    The size is the text's UTF-8 bytes plus 1; a null text has none and counts as
    the empty one.  Slots number a shard's rows from 0 in key order.  Rows of one id and
    text stay together; those without id do not.  Shards may stay empty
    when there are fewer texts than shards.
    """
    spark = docs.sparkSession
    body = plain_text(text_col)
    rows = stage(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(body).cast("long") + 1).alias("size"),
            F.crc32(body.cast("binary")).alias("crc"),
            F.xxhash64(body).alias("group"),
            # Rows without id are told apart by their number, which is fixed once it is written.
            F.when(F.col(id_col).isNull(), F.xxhash64(F.lit(4), F.monotonically_increasing_id()))
            .otherwise(F.xxhash64(F.lit(3), F.col(id_col))).alias("member"),
        ),
        "shard-keys",
    )
    keys = rows.groupBy("group", "member").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # As many ranges whatever the rows: samples, boundaries and sums on the driver stay bounded.
    ranges = shards * _RANGES_PER_SHARD
    bounds = _quantiles(_draw(keys, ranges * _SAMPLES_PER_RANGE, total, 0), ranges)
    for attempt in range(1, _ROUNDS + 1):
        # Only ranges with more than one key can be cut again.
        full = (
            _ranged(keys, bounds)
            .groupBy("range")
            .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("keys"))
            .where((F.col("bytes") > _OVERFULL * total / ranges) & (F.col("keys") > 1))
        )
        again = {r["range"]: r["bytes"] for r in full.select("range", "bytes").collect()}
        if not again or attempt == _ROUNDS:
            break
        inside = _ranged(keys, bounds).join(full.select("range"), "range", "left_semi")
        held = sum(again.values())
        parts = int(np.ceil(held * ranges / total)) * 2
        found = _draw(inside.drop("range"), parts * _SAMPLES_PER_RANGE, held, attempt)
        more = {(int(r["group"]), int(r["member"])) for r in _spread(found, parts)}
        if more <= bounds:
            break
        bounds |= more
    ordered = sorted(bounds)
    placed = stage(_ranged(rows, bounds), "ranged-keys")
    held = {r[0]: (r[1], r[2]) for r in placed.groupBy("range").agg(F.sum("size"), F.count("*")).collect()}
    n = len(ordered) + 1
    sizes = [held.get(r, (0, 0))[0] for r in range(n)]
    # Range 0 and every range whose boundary precedes its whole group begin with a new group.
    edges = [True, *(m == _LOWEST for _, m in ordered)]
    shard_of = np.searchsorted(choose_cuts(sizes, edges, shards), np.arange(n), side="right")
    plan, slot, last = [], 0, -1
    for r in range(n):
        slot, last = (0 if shard_of[r] != last else slot), shard_of[r]
        plan.append((r, int(shard_of[r]), slot))
        slot += held.get(r, (0, 0))[1]
    plan_rows = spark.createDataFrame(plan, "range long, shard int, first long")
    inside = F.row_number().over(Window.partitionBy("range").orderBy("group", "member", "crc", "size")) - 1
    return (
        placed.withColumn("__inside", inside)
        .join(plan_rows, "range")
        .select(
            F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
            (F.col("first") + F.col("__inside")).alias("slot"), F.col("group").alias("text_hash"),
        )
    )


def _spread(sample: np.ndarray, parts: int) -> np.ndarray:
    running = np.cumsum(sample["w"])
    at = np.searchsorted(running, running[-1] * np.arange(1, parts) / parts, side="right") if len(sample) else []
    return sample[np.unique(np.minimum(np.asarray(at, np.int64), len(sample) - 1))] if len(sample) else sample


def write_shards(docs: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents below ``path/shard=<n>`` in slot order, one or more files a shard."""
    placed = assign_shards(docs, shards, id_col, text_col).select(
        F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"), "shard", "slot"
    )
    match = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(plain_text(text_col)) == F.col("__hash"))
    taken = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")]
    joined = docs.join(placed, match).select(*taken, "shard", "slot").dropDuplicates(["shard", "slot"])
    joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
