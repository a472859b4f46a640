"""Bounded samples of labelled rows, and the fold of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def held_out(id_col: str) -> Column:
    """Whether a document belongs to the fold that nothing may be learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def labelled_sample(
    rows: DataFrame, label: str, order: str, per_label: int, max_labels: int
) -> tuple[DataFrame, list]:
    """About ``per_label`` rows of each of the ``max_labels`` most frequent labels.

    Rows are taken by a hash of ``order``, so the choice is repeatable and does
    not depend on the partitioning; at most ``per_label * max_labels`` come back.
    """
    counts = (
        rows.where(F.col(label).isNotNull())
        .groupBy(label)
        .count()
        .orderBy(F.desc("count"), label)
        .limit(max_labels)
        .collect()
    )
    if not counts:
        return rows.limit(0), []
    labels = sorted(r[0] for r in counts)
    place = F.pmod(F.xxhash64(F.lit(7), F.col(order)), F.lit(1 << 30))
    cut = F.coalesce(
        *(
            F.when(F.col(label) == r[0], F.lit(min(1 << 30, (per_label << 30) // r[1] + 1)))
            for r in counts
        )
    )
    chosen = rows.where(place < cut).orderBy(place, order).limit(per_label * len(counts))
    return chosen, labels


def sample_of_every_label(
    rows: DataFrame, label: str, order: str, per_label: int, in_all: int
) -> tuple[DataFrame, list]:
    """Rows of every label there is, without a bound on their number, and the labels in order.

    A label gives ``per_label`` rows, or ``in_all`` divided by the labels if that is
    less, but never less than one; all of them if it has no more.  Rows are taken
    by a hash of ``order``, as in ``labelled_sample``.
    """
    place = F.pmod(F.xxhash64(F.lit(7), F.col(order)), F.lit(1 << 30))
    counts = (
        rows.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count("*"), F.min(place))
        .orderBy(label)
        .collect()
    )
    if not counts:
        return rows.limit(0), []
    share = max(1, min(per_label, in_all // len(counts)))
    # Above the share, so that chance leaves no label short; the first row is always below.
    wide = share + 8 * int(share**0.5 + 1) + 32
    cuts = rows.sparkSession.createDataFrame(
        [(r[0], max(min(1 << 30, (wide << 30) // r[1] + 1), r[2] + 1)) for r in counts],
        StructType([StructField("__of", rows.schema[label].dataType), StructField("__cut", LongType())]),
    )
    near = rows.join(F.broadcast(cuts), F.col(label) == F.col("__of")).where(place < F.col("__cut"))
    first = F.row_number().over(Window.partitionBy("__of").orderBy(place, order))
    chosen = near.withColumn("__first", first).where(F.col("__first") <= share)
    return chosen.select(*(F.col(f"`{c}`") for c in rows.columns)), [r[0] for r in counts]
