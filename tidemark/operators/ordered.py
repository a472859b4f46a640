"""Ordered series without one task per series.

A plain window over ``partitionBy(city)`` puts a whole city into one task.  Here
a series is cut into slices instead: by calendar slice to number its rows, and
by position blocks (with the neighbouring rows copied in) to look around a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_positions(
    df: DataFrame, keys: Sequence[str], at: str, slice_unit: str = "month"
) -> DataFrame:
    """Add ``pos`` (0-based rank of the row in its series) and ``n`` (series length).

    Rows are ranked inside calendar slices; the slice sizes, a few rows per
    series, are summed up to the offset of each slice.  ``df`` is read twice, so
    pass a stored table.
    """
    sliced = df.withColumn("_slice", F.date_trunc(slice_unit, at))
    series = Window.partitionBy(*keys).orderBy("_slice")
    sizes = sliced.groupBy(*keys, "_slice").agg(F.count("*").alias("_size"))
    offsets = sizes.select(
        *keys,
        "_slice",
        (
            F.coalesce(
                F.sum("_size").over(series.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            )
        ).alias("_offset"),
        F.sum("_size").over(Window.partitionBy(*keys)).alias("n"),
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(at))
    return (
        sliced.withColumn("_row", inside - 1)
        .join(offsets, [*keys, "_slice"])
        .withColumn("pos", F.col("_offset") + F.col("_row"))
        .drop("_slice", "_row", "_offset")
    )


def with_halo(df: DataFrame, before: int, after: int, block_rows: int = 4096) -> DataFrame:
    """Assign rows to position blocks, copying each block's neighbours into it.

    Adds ``block`` and ``owned``.  Every owned row finds the ``before`` rows
    ahead of it and the ``after`` rows behind it in its own block; the copies
    (``owned = false``) only serve as neighbours.
    """
    pos = F.col("pos")
    first = F.greatest(F.floor((pos - after) / block_rows), F.lit(0))
    last = F.floor((pos + before) / block_rows)
    return df.withColumn("block", F.explode(F.sequence(first, last))).withColumn(
        "owned", F.col("block") == F.floor(pos / block_rows)
    )


def block_window(keys: Sequence[str]):
    return Window.partitionBy(*keys, "block").orderBy("pos")
