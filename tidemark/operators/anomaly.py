"""Z-score anomalies against the hourly baseline before the event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scores
from tidemark.operators.impact import roll_up


def baseline_stats(silver: DataFrame) -> DataFrame:
    """Mean and sample deviation per city and hour of the ``before`` readings.

    Equal readings have deviation 0, whatever the order they were merged in.
    """
    ci = F.col("congestion_index")
    constant = (F.count(ci) > 1) & (F.min(ci) == F.max(ci))
    return (
        silver.where("period = 'before'")
        .groupBy("city", "hour")
        .agg(F.avg(ci).alias("mu"), F.when(constant, F.lit(0.0)).otherwise(F.stddev(ci)).alias("sigma"))
    )


def baseline_from_cells(cells: DataFrame) -> DataFrame:
    """The same baseline rolled up from :func:`impact.reading_cells`."""
    before = roll_up(cells.where("period = 'before'"), "city", "hour")
    return before.select(
        "city", "hour", F.col("avg_congestion").alias("mu"), F.col("sigma_congestion").alias("sigma")
    )


def score_readings(silver: DataFrame, baseline: DataFrame, limit: float = 2.0) -> DataFrame:
    """Score both periods in one pass.

    An hour without a baseline gives a null score: not an anomaly, still counted.
    Pass the baseline as a stored table: its size on disk then decides between a
    broadcast and a sort-merge join.
    """
    sigma = F.when(F.col("sigma") > 0, F.col("sigma")).otherwise(1.0)
    return (
        silver.join(baseline, ["city", "hour"], "left")
        .withColumn("zscore", (F.col("congestion_index") - F.col("mu")) / sigma)
        .withColumn("is_anomaly", F.coalesce(F.abs("zscore") > limit, F.lit(False)).cast("int"))
    )


def anomaly_rate(scored: DataFrame) -> DataFrame:
    rates = scored.groupBy("period").agg(
        F.count("*").alias("total_records"), F.sum("is_anomaly").alias("anomaly_count")
    )
    share = F.col("anomaly_count") / F.col("total_records") * 100
    return rates.withColumn("anomaly_rate_pct", scores.half_up(share, 2))


def anomalies_only(scored: DataFrame) -> DataFrame:
    """The anomalous readings with what the rate and the ranking need.  Stored, they are the
    one pass over the readings that both read."""
    return scored.where("is_anomaly = 1").select(
        "city", "road_name", "recorded_at", "period", "congestion_index", "mu", "sigma", "zscore", "is_anomaly"
    )


def rate_from_cells(cells: DataFrame, anomalies: DataFrame) -> DataFrame:
    """:func:`anomaly_rate` from the reading counts of :func:`impact.reading_cells` and the
    anomalous readings."""
    totals = cells.groupBy("period").agg(F.sum("readings").alias("total_records"))
    found = anomalies.groupBy(F.col("period").alias("_period")).agg(F.count("*").alias("anomaly_count"))
    rates = totals.join(found, F.col("period").eqNullSafe(F.col("_period")), "left").select(
        "period", "total_records", F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count")
    )
    share = F.col("anomaly_count") / F.col("total_records") * 100
    return rates.withColumn("anomaly_rate_pct", scores.half_up(share, 2))


def top_anomalies(
    scored: DataFrame, n: int = 200, city: str | None = None, period: str = "after"
) -> DataFrame:
    """The ``n`` strongest anomalies; ties by time, city and road."""
    hits = scored.where((F.col("is_anomaly") == 1) & (F.col("period") == period))
    if city:
        hits = hits.where(F.col("city") == city)
    strength = scores.half_up(F.abs("zscore"), 6)
    return (
        hits.orderBy(strength.desc(), "recorded_at", "city", "road_name")
        .limit(n)
        .select(
            "city", "road_name", "recorded_at", "congestion_index",
            F.col("mu").alias("baseline_mean"), F.col("sigma").alias("baseline_stddev"), "zscore",
        )
    )
