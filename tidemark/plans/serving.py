"""Read queries a dashboard or API would ask; each composes gold frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import bands, scores
from tidemark.operators import impact
from tidemark.sources import tables


def mobility(wide: DataFrame, zones: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """Mobility score per city; null (and flagged) while there is no ``after`` data.

    ``impact_level`` follows from fixed bands of the roads' change.  With
    ``clusters`` (the commonest cluster zone per city, see ``modal_zone``) the
    level that the road clusters give stands beside it as ``cluster_level``.
    """
    if clusters is not None:
        named = clusters.select("city", F.col("impact_level").alias("cluster_level"))
        return mobility(wide, zones).join(named, "city", "left")
    after = F.when(F.col("has_after"), F.col("after_congestion"))
    return wide.join(zones.select("city", "impact_level"), "city", "left").select(
        "city",
        scores.mobility_score(after).alias("mobility_score"),
        scores.half_up(after / 100, 4).alias("traffic_index"),
        F.col("change_pct").alias("congestion_change"),
        "has_after",
        F.coalesce("impact_level", F.lit("moderate_impact")).alias("impact_level"),
    )


def dashboard_snapshot(
    mobility_rows: DataFrame, daily: DataFrame, fuel_price: float | None,
    weather: DataFrame, transport: DataFrame,
) -> DataFrame:
    """Mobility with the city's newest daily summary, weather score and transport load.

    ``weather`` (city, weather_score) and ``transport`` (city, avg_load_factor) have
    one row per city; ``fuel_price`` is the price in force.
    """
    rest = ("avg_congestion_index", "est_extra_fuel_cost_idr", "est_extra_travel_min")
    newest = daily.groupBy("city").agg(
        F.max_by(F.struct("summary_date", *rest), "summary_date").alias("d")
    )
    level = scores.half_up((1 - F.col("mobility_score")) * 100, 2)
    joined = (
        mobility_rows.join(newest, "city", "left")
        .join(weather.select("city", "weather_score"), "city", "left")
        .join(transport.select("city", "avg_load_factor"), "city", "left")
    )
    return joined.select(
        "city",
        "mobility_score",
        level.alias("congestion_level"),
        F.lit(fuel_price).cast("double").alias("fuel_price"),
        "impact_level",
        "weather_score",
        "avg_load_factor",
        F.col("d.summary_date").alias("summary_date"),
        *[F.col(f"d.{name}").alias(name) for name in rest],
    )


def cluster_overview(roads: DataFrame, zones: DataFrame) -> DataFrame:
    """Every road record with its city's commonest zone (see ``modal_zone``).

    Pass the zones, one row per city, as a stored table: they are then broadcast
    and a city with most of the roads is not shuffled into one task.
    """
    city = zones.select("city", F.col("zone").alias("city_zone"), "impact_level")
    return roads.join(city, "city")


def forecast_steps(cached: DataFrame, stored: DataFrame, newest: int = 24) -> DataFrame:
    """Forecast per (city, horizon): the current predictions, then stored ones.

    Both frames hold (city, horizon_minutes, predicted_level, predicted_at).  Of
    the stored ones the newest of each horizon counts; the limit of rows per city
    comes after that, so no horizon disappears behind repeated ones.
    """
    from tidemark.operators.cleaning import keep_latest

    latest = keep_latest(stored, ("city", "horizon_minutes"), [F.col("predicted_at").desc()])
    ranked = newest_predictions(latest, newest)
    both = cached.withColumn("source", F.lit(0)).unionByName(ranked.withColumn("source", F.lit(1)))
    steps = keep_latest(
        both, ("city", "horizon_minutes"), [F.col("source"), F.col("predicted_at").desc()]
    )
    return steps.select(
        "city",
        (F.col("horizon_minutes") / 60.0).alias("hour_offset"),
        scores.level_score(F.col("predicted_level")).alias("mobility_score"),
        bands.level_label("predicted_level").alias("congestion_level"),
    )


def with_placeholder(steps: DataFrame, cities: DataFrame) -> DataFrame:
    """A neutral half-hour step for cities without any forecast."""
    missing = cities.select("city").join(steps.select("city"), "city", "left_anti")
    neutral = missing.select(
        "city",
        F.lit(0.5).alias("hour_offset"),
        F.lit(0.5).alias("mobility_score"),
        F.lit(config.LEVEL_LABELS[1]).alias("congestion_level"),
    )
    return steps.unionByName(neutral)


def newest_predictions(stored: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` predictions of each city."""
    from pyspark.sql import Window

    order = Window.partitionBy("city").orderBy(
        F.col("predicted_at").desc(), F.col("horizon_minutes")
    )
    return stored.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")


def layer_counts(lake) -> DataFrame:
    """Rows per layer table.  Large tables are counted from the footers of their files, so
    that markers of emptied days do not count; keyed ones by their newest rows."""
    spark = lake.spark
    wanted = {
        "bronze_traffic": (lake.path("bronze_traffic"), None),
        "bronze_weather": (lake.path("bronze_weather"), None),
        "silver_traffic": (lake.path("silver_traffic"), "congestion_index"),
        "gold_predictions": (lake.path("gold_predictions"), None),
    }
    if lake.has("gold_anomalies"):
        wanted["gold_anomalies"] = (tables.replaced_path(spark, lake.path("gold_anomalies")), None)
    counts = {"gold_anomalies": 0} | tables.footer_counts(spark, wanted)
    # One number a table.
    footers = spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")
    keyed = ("gold_city_comparison", "gold_hourly_pattern", "gold_daily_summary", "gold_road_clusters")
    return footers.unionByName(impact.table_counts(spark, {name: lake.stored(name) for name in keyed}))


def kpi_strip(wide: DataFrame, rates: DataFrame, latest_daily: DataFrame) -> DataFrame:
    """The headline numbers, one row per KPI."""

    def row(kpi: str, city, value) -> list:
        return [F.lit(kpi).alias("kpi"), city.alias("city"), value.cast("double").alias("value")]

    nowhere = F.lit(None).cast("string")

    def rate(period: str):
        return F.max(F.when(F.col("period") == period, F.col("anomaly_rate_pct")))

    change = wide.agg(
        # Largest change; on a tie the alphabetically last city.
        F.max_by(F.struct("city", "change_pct"), F.struct("change_pct", "city")).alias("top"),
        F.avg("change_pct").alias("mean"),
    )
    changes = change.select(
        F.explode(
            F.array(
                F.struct(*row("worst_change", F.col("top.city"), F.col("top.change_pct"))),
                F.struct(*row("mean_change", nowhere, F.col("mean"))),
            )
        ).alias("k")
    )
    anomalies = rates.agg(rate("before").alias("b"), rate("after").alias("a")).select(
        F.explode(
            F.array(
                F.struct(*row("anomaly_rate_after", nowhere, F.col("a"))),
                F.struct(*row("anomaly_rate_delta", nowhere, F.col("a") - F.col("b"))),
            )
        ).alias("k")
    )
    cost = latest_daily.agg(F.sum("est_extra_fuel_cost_idr").alias("c")).select(
        F.struct(*row("extra_fuel_cost", nowhere, F.col("c"))).alias("k")
    )
    return changes.unionByName(anomalies).unionByName(cost).select("k.*")
