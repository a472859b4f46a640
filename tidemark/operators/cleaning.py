"""Bronze to silver: normalise, deduplicate, validate, enrich."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import bands, scores

READING_KEY = ("city", "road_name", "recorded_at")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating column (NaN sorts above all numbers)."""
    fixes = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixes) if fixes else df


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark turns the ``row_number = 1`` filter into a group limit that runs before
    the shuffle as well, so a key with a third of all rows sends one row per
    input task and never lands whole in one place.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def with_defaults(
    df: DataFrame, source: str = "tomtom", ingested_via: str = "kafka", **extra
) -> DataFrame:
    """Fill ingest columns that a message may leave out and derive the ``date``."""
    defaults = {"source": source, "ingested_via": ingested_via, **extra}
    filled = {
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()
    }
    return df.withColumns({**filled, "date": F.to_date("recorded_at")})


def tag_period(df: DataFrame, event_date: str, at: str = "recorded_at") -> DataFrame:
    """``before`` or ``after`` by event time; the event date itself counts as after."""
    # Compared as a timestamp so that the filter can reach the scan.
    boundary = F.lit(event_date).cast("timestamp")
    return df.withColumn("period", F.when(F.col(at) >= boundary, "after").otherwise("before"))


def deduplicate_readings(df: DataFrame, sequence: str = "ingest_seq") -> DataFrame:
    """One reading per road and time; the one ingested last survives.

    Rows that even share the sequence are ordered by their values, so that a
    rerun keeps the same one.
    """
    ties = [c for c in ("congestion_index", "current_speed") if c in df.columns]
    return keep_latest(df, READING_KEY, [F.col(c).desc() for c in (sequence, *ties)])


def valid_readings(df: DataFrame) -> DataFrame:
    return df.where(F.col("congestion_index").between(0, 100) & (F.col("current_speed") > 0))


def add_calendar(df: DataFrame, at: str = "recorded_at") -> DataFrame:
    """Hour, day of week (1 = Sunday) and weekend flag."""
    day = F.dayofweek(at)
    return df.withColumns(
        {
            "hour": F.hour(at),
            "day_of_week": day,
            "is_weekend": F.when(day.isin(1, 7), 1).otherwise(0),
        }
    )


def silver_readings(bronze: DataFrame, sequence: str = "ingest_seq") -> DataFrame:
    """Clean readings.  Deduplication comes first: an invalid survivor hides its key."""
    clean = valid_readings(deduplicate_readings(bronze, sequence))
    return add_calendar(clean).withColumn(
        "congestion_level", bands.congestion_level("congestion_index")
    )


def derive_congestion(df: DataFrame) -> DataFrame:
    """Both congestion definitions from speeds; rows without a free flow are rejected."""
    current, free_flow = F.col("current_speed"), F.col("free_flow_speed")
    return df.withColumns(
        {
            "derived_index": scores.congestion_from_speeds(current, free_flow),
            "derived_percent": scores.congestion_unclamped(current, free_flow),
        }
    ).where(F.col("derived_index").isNotNull())


def history_rows(silver: DataFrame | None, bronze: DataFrame) -> DataFrame:
    """Readings with their level from silver, or from bronze while silver is empty."""
    columns = [
        "city", "road_name", "current_speed", "congestion_index",
        "congestion_level", "period", "recorded_at",
    ]
    if silver is not None and not silver.isEmpty():
        return silver.select(*columns)
    derived = bronze.withColumn("congestion_level", bands.congestion_level("congestion_index"))
    return derived.select(*columns)
