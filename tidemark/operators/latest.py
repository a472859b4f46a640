"""Latest-state views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scores
from tidemark.operators.cleaning import keep_latest


def latest_readings(bronze: DataFrame, sequence: str = "ingest_seq") -> DataFrame:
    """The newest reading of every road (ties: ingested last)."""
    return keep_latest(
        bronze, ("city", "road_name"), [F.col("recorded_at").desc(), F.col(sequence).desc()]
    )


def lookup_roads(latest: DataFrame, wanted: DataFrame) -> DataFrame:
    """Latest state of the requested (city, road_name) pairs.

    ``latest`` has one row per road; give a stored table (``sources.tables.write_latest``),
    so that a lookup neither ranks nor reads all of it.
    """
    return latest.join(wanted, ["city", "road_name"], "left_semi")


def supported_only(df: DataFrame, cities: DataFrame) -> DataFrame:
    """Rows whose city is in the city dimension."""
    return df.join(cities.select("city"), "city", "left_semi")


def city_snapshot(latest: DataFrame) -> DataFrame:
    """Current state per city: means over its roads, their number, the newest time."""
    state = latest.groupBy("city").agg(
        F.avg("congestion_index").alias("avg_congestion"),
        F.avg("current_speed").alias("avg_speed"),
        # Of readings at one time the last road by name tells the period.
        F.max_by("period", F.struct("recorded_at", "road_name")).alias("period"),
        F.max("recorded_at").alias("updated_at"),
        F.count("*").alias("roads_monitored"),
    )
    return state.withColumn("mobility_index", scores.mobility_index(F.col("avg_congestion")))


def road_pages(latest: DataFrame, page_size: int = 500) -> DataFrame:
    """The road records of a city as arrays of about ``page_size`` entries.

    A city may hold most of the roads, so its list is cut into hashed pages and
    no task ever builds the list of a whole city.
    """
    counts = latest.groupBy("city").agg(F.ceil(F.count("*") / page_size).alias("pages"))
    record = F.struct(
        "road_name", "lat", "lon", "current_speed", "free_flow_speed", "congestion_index",
        "recorded_at",
    )
    paged = latest.join(counts, "city").withColumn(
        "page", F.pmod(F.xxhash64("road_name"), F.col("pages")).cast("int")
    )
    return paged.groupBy("city", "page").agg(F.collect_list(record).alias("roads"))


def series_range(
    points: DataFrame, as_of: str, start: str, end: str, keep_seconds: int = 86_400
) -> DataFrame:
    """Points (metric, city, ts, value) still kept at ``as_of``, in [start, end]."""
    now = F.lit(as_of).cast("timestamp")
    oldest = now - F.make_dt_interval(secs=F.lit(keep_seconds))
    ts = F.col("ts")
    return points.where(
        (ts >= oldest)
        & (ts <= now)
        & ts.between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    )


def fresh_latest(
    values: DataFrame, as_of: str, ttl: Mapping[str, int], keys: tuple[str, ...] = ("kind", "city")
) -> DataFrame:
    """Latest value per key that has not outlived the lifetime of its kind."""
    now = F.lit(as_of).cast("timestamp")
    ts = F.col("ts")
    alive = None
    for kind, seconds in ttl.items():
        rule = (F.col("kind") == kind) & (ts >= now - F.make_dt_interval(secs=F.lit(seconds)))
        alive = rule if alive is None else alive | rule
    # The longest lifetime alone is a plain range that reaches the scan.
    horizon = now - F.make_dt_interval(secs=F.lit(max(ttl.values())))
    fresh = values.where((ts <= now) & (ts >= horizon)).where(alive)
    return keep_latest(fresh, keys, [ts.desc(), F.col("value").desc()])
