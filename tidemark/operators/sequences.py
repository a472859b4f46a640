"""Supervised sequences for forecasting: past rows in, future targets out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import SEQUENCE_FEATURES, SEQUENCE_TARGET
from tidemark.operators.ordered import block_window, with_halo, with_positions

SERIES = ("city",)


def training_sequences(
    inputs: DataFrame,
    past: int = 48,
    future: int = 48,
    names: Sequence[str] = SEQUENCE_FEATURES,
    target: str = SEQUENCE_TARGET,
) -> DataFrame:
    """For each row at position i, ``past <= i < n - future``: the ``past`` feature
    rows before it (``x``) and the ``future`` targets from it on (``y``)."""
    filled = inputs.fillna(0.0, subset=list(names))
    narrow = filled.select(
        "city", "window_start", *[F.col(c).cast("double").alias(c) for c in names],
        F.col(target).cast("double").alias("_target"),
    )
    placed = with_halo(with_positions(narrow, SERIES, "window_start"), past, future - 1)
    around = block_window(SERIES)
    x = F.collect_list(F.array(*names)).over(around.rowsBetween(-past, -1))
    y = F.collect_list("_target").over(around.rowsBetween(0, future - 1))
    return (
        placed.select("city", "window_start", "pos", "n", "owned", x.alias("x"), y.alias("y"))
        .where(F.col("owned") & (F.col("pos") >= past) & (F.col("pos") < F.col("n") - future))
        .drop("owned")
    )


def sequence_rows(
    inputs: DataFrame,
    past: int = 48,
    future: int = 48,
    names: Sequence[str] = SEQUENCE_FEATURES,
    target: str = SEQUENCE_TARGET,
) -> DataFrame:
    """The same sequences by what a regression on them reads: the last and the mean past
    values (``last_*``, ``mean_*``) and the targets ``y``, without the past itself."""
    filled = inputs.fillna(0.0, subset=list(names))
    narrow = filled.select(
        "city", "window_start", *[F.col(c).cast("double").alias(c) for c in names],
        F.col(target).cast("double").alias("_target"),
    )
    placed = with_halo(with_positions(narrow, SERIES, "window_start"), past, future - 1)
    around = block_window(SERIES)
    before = around.rowsBetween(-past, -1)
    y = F.collect_list("_target").over(around.rowsBetween(0, future - 1))
    return (
        placed.select(
            "city", "window_start", "pos", "n", "owned", y.alias("y"),
            *[F.lag(c).over(around).alias(f"last_{c}") for c in names],
            *[F.avg(c).over(before).alias(f"mean_{c}") for c in names],
        )
        .where(F.col("owned") & (F.col("pos") >= past) & (F.col("pos") < F.col("n") - future))
        .drop("owned")
    )


def chronological_split(
    sequences: DataFrame, past: int = 48, future: int = 48, share: float = 0.8,
    min_sequences: int = 10,
) -> DataFrame:
    """Mark the first ``share`` of each city's sequences as training rows.

    The position of a sequence follows from the row position, so no second
    ranking is needed.  Cities with fewer than ``min_sequences`` are left out.
    """
    total = F.col("n") - past - future
    cut = F.floor(total * F.lit(share))
    return sequences.where(total >= min_sequences).withColumn(
        "split", F.when(F.col("pos") - past < cut, "train").otherwise("validation")
    )


def recent_context(inputs: DataFrame, rows: int = 48) -> DataFrame:
    """The newest ``rows`` rows per city; cities with fewer are left out."""
    newest = F.row_number().over(Window.partitionBy("city").orderBy(F.col("window_start").desc()))
    # The rank limit also runs before the shuffle, so at most `rows` rows per
    # city and input task move.
    recent = inputs.withColumn("steps_back", newest).where(F.col("steps_back") <= rows)
    have = F.max("steps_back").over(Window.partitionBy("city"))
    return recent.withColumn("_have", have).where(F.col("_have") == rows).drop("_have")
