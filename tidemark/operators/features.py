"""The feature table: one row per (city, window_start)."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.config import HOLIDAYS, CompositeWeights
from tidemark.functions import scores

# Columns a missing source leaves empty, filled with 0 at the end.
FILLED = (
    "fuel_price_delta", "traffic_index", "avg_speed", "transport_usage_norm",
    "weather_score_norm", "avg_temperature", "avg_rain_1h",
)


def price_delta(
    fuel: DataFrame, slice_unit: str = "month", earlier: DataFrame | None = None
) -> DataFrame:
    """Percent change of the mean price against the previous window of the same fuel.

    Without a previous window, or after a zero price, the change is 0.  The
    previous price is looked up inside calendar slices, so a series is no single
    task; the first window of a slice takes the last price of the slice before,
    one row per slice.  ``earlier`` (city, fuel_type, _slice, _earlier) gives that
    price when ``fuel`` holds only some slices of the series.
    """
    series = ("city", "fuel_type")
    cut = fuel.withColumn("_slice", F.date_trunc(slice_unit, "window_start"))
    inside = Window.partitionBy(*series, "_slice").orderBy("window_start")
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = cut.withColumns(
        {
            "_own": F.lag("avg_price").over(inside),
            "_row": F.row_number().over(inside),
            "_last": F.last("avg_price").over(whole),
        }
    )
    if earlier is None:
        before = F.lag("_last").over(Window.partitionBy(*series).orderBy("_slice"))
        earlier = marked.where("_row = 1").select(*series, "_slice", before.alias("_earlier"))
    linked = marked.join(earlier, [*series, "_slice"], "left")
    return (
        linked.withColumn(
            "prev_avg_price", F.when(F.col("_row") == 1, F.col("_earlier")).otherwise(F.col("_own"))
        )
        .withColumn(
            "fuel_price_delta",
            F.when(
                F.col("prev_avg_price") > 0,
                scores.percent_change(F.col("prev_avg_price"), F.col("avg_price")),
            ).otherwise(0.0),
        )
        .drop("_slice", "_own", "_row", "_last", "_earlier")
    )


def holiday_frame(spark: SparkSession, days: Iterable[date] = HOLIDAYS) -> DataFrame:
    """A (holiday) dimension.  Built from literals, its size is known to the planner,
    which then broadcasts it instead of shuffling the features by date."""
    dates = F.array(*[F.lit(d) for d in sorted(set(days))])
    return spark.range(1).select(F.explode(dates).alias("holiday"))


def assemble_features(
    fuel: DataFrame,
    traffic: DataFrame,
    weather: DataFrame,
    transport: DataFrame,
    holidays: DataFrame,
    benchmark_fuel: str,
    ridership_ceiling: float = 50_000.0,
    weights: CompositeWeights = CompositeWeights(),
    null_policy: str = "observed",
    slice_unit: str = "month",
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Join the four window tables on the benchmark fuel's (city, window_start).

    Every input has one row per key (see ``merge_fuel`` and ``merge_traffic``),
    so nothing fans out.  With ``null_policy='observed'`` a missing source
    normalises to 1.0; ``'propagate'`` keeps the null until the final fill.
    ``slice_unit`` and ``earlier`` go to :func:`price_delta`.
    """
    key = ["city", "window_start"]
    base = price_delta(fuel.where(F.col("fuel_type") == benchmark_fuel), slice_unit, earlier).select(
        *key, "avg_price", "fuel_price_delta"
    )
    joined = (
        base.join(
            traffic.select(*key, "avg_congestion", "avg_speed", "avg_mobility_index"), key, "left"
        )
        .join(
            weather.select(*key, "avg_weather_score", "avg_temperature", "avg_rain_1h"),
            key,
            "left",
        )
        .join(transport.select(*key, "total_ridership", "avg_load_factor"), key, "left")
        .withColumn("holiday", F.to_date("window_start"))
        .join(holidays.withColumn("is_holiday", F.lit(1)), "holiday", "left")
    )

    def norm(name: str, high: float) -> Column:
        return scores.minmax(F.col(name).cast("double"), 0, high, null_policy)

    scaled = joined.withColumns(
        {
            "time_of_day": F.hour("window_start"),
            "day_of_week": F.dayofweek("window_start") - 1,
            "holiday_flag": F.coalesce("is_holiday", F.lit(0)),
            "traffic_index": norm("avg_congestion", 100),
            "weather_score_norm": norm("avg_weather_score", 100),
            "transport_usage_norm": norm("total_ridership", ridership_ceiling),
        }
    )
    composite = scores.composite_mobility(
        F.col("traffic_index"), F.col("weather_score_norm"), F.col("transport_usage_norm"),
        F.col("fuel_price_delta"), weights,
    )
    return (
        scaled.withColumn("mobility_composite", composite)
        .fillna(0.0, subset=list(FILLED))
        .select(
            *key, "avg_price", "fuel_price_delta", "traffic_index", "avg_congestion", "avg_speed",
            "avg_mobility_index", "transport_usage_norm", "avg_load_factor",
            "weather_score_norm", "avg_temperature", "avg_rain_1h", "time_of_day",
            "day_of_week", "holiday_flag", "mobility_composite",
        )
    )


def forecast_inputs(features: DataFrame) -> DataFrame:
    """Scale hour and day of week to [0, 1] for the sequence forecast."""
    return features.withColumns(
        {
            "time_of_day_norm": F.col("time_of_day") / 23.0,
            "day_of_week_norm": F.col("day_of_week") / 6.0,
        }
    )


def resample(
    features: DataFrame, width: str, means: Iterable[str], keys: tuple[str, ...] = ("city",)
) -> DataFrame:
    """Mean of the named columns on a coarser time step (5-minute rows to 30-minute steps)."""
    grouped = features.groupBy(*keys, F.window("window_start", width).alias("w")).agg(
        *[F.avg(m).alias(m) for m in means]
    )
    return grouped.select(*keys, F.col("w.start").alias("window_start"), *means)
