"""The feature job: window tables to the feature store and its correlations.

Features are kept in days, one version per run.  A run computes only the (city, day) that
changed since the last one: windows written since, windows that the clock has reached, and
the day after a changed price, whose first window is compared with it.  That comparison
needs the last price of the day before, which a small table keeps per city and day.
``per`` names a longer unit than the day, for windows so wide that a day has few rows; it
belongs to the tables of a lake and must not change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config
from tidemark.operators import correlation, features, windows
from tidemark.plans.cycle import Lake
from tidemark.session import stage
from tidemark.sources import tables
from tidemark.sources.tables import KeyedTable
from tidemark.streaming.jobs import WINDOW_JOBS

STORE = "feature_store"
STORE_SCHEMA = (
    "city string, window_start timestamp, avg_price double, fuel_price_delta double, traffic_index double, "
    "avg_congestion double, avg_speed double, avg_mobility_index double, transport_usage_norm double, "
    "avg_load_factor double, weather_score_norm double, avg_temperature double, avg_rain_1h double, "
    "time_of_day int, day_of_week int, holiday_flag int, mobility_composite double"
)


def store(lake: Lake, per: str = "day") -> KeyedTable:
    return KeyedTable(lake.spark, lake.path(STORE), ("city", "window_start"), "window_start", STORE_SCHEMA, per)


def _edges(lake: Lake) -> KeyedTable:
    """The last price of the benchmark fuel per city and day."""
    return KeyedTable(
        lake.spark, lake.path("feature_price_edges"), ("city", "price_day"),
        schema="city string, price_day date, last_price double",
    )


def _state(lake: Lake) -> KeyedTable:
    return KeyedTable(
        lake.spark, lake.path("feature_state"), ("source",),
        schema="source string, last_version bigint, as_of string",
    )


def _job(name: str):
    return next(j for j in WINDOW_JOBS if j.table == name)


def window_table(
    lake: Lake, name: str, low: str | None = None, high: str | None = None, per: str = "day"
) -> DataFrame:
    """The newest row per key of one of the four streamed window tables, of some days."""
    return _job(name).keyed(lake.spark, lake.root, per).read(low, high)


def _changed(lake: Lake, noted: dict, as_of: str, per: str) -> DataFrame:
    """(city, day, priced): what was written, or reached by the clock, since the last run."""
    upto = F.col("window_start") <= F.lit(as_of).cast("timestamp")
    found = lake.spark.createDataFrame([], "city string, day date, priced boolean")
    for job in WINDOW_JOBS:
        table, last = job.keyed(lake.spark, lake.root, per), noted[job.table]
        if not table.exists():
            continue
        reached = F.col("window_start") > F.lit(last["as_of"]).cast("timestamp")
        ahead = table.changes(-1, last["as_of"][:10]).where(reached & upto)
        written = table.changes(last["last_version"]).where(upto)
        for rows in (written, ahead):
            found = found.unionByName(
                rows.select("city", "day", F.lit(job.kind == "fuel").alias("priced"))
            )
    return found.groupBy("city", "day").agg(F.max("priced").alias("priced"))


def run_features(
    lake: Lake,
    as_of: str,
    benchmark_fuel: str,
    holidays: DataFrame | None = None,
    incremental: bool = True,
    per: str = "day",
) -> list[str]:
    """Bring the features of all windows up to ``as_of`` up to date.

    The first run, and one that is not ``incremental``, computes all of them.  A run that
    failed is made good by the next one.  The correlations are computed from the stored
    features.
    """
    spark = lake.spark
    # A version of its own for every run, also at the same time: it holds what changed alone.
    version = 1 + max(t.newest_version() for t in (_state(lake), _edges(lake), store(lake, per)))
    noted = {r["source"]: r for r in _state(lake).read().collect()} if incremental else {}
    if len(noted) < len(WINDOW_JOBS):
        noted = {}
    # Before the tables are read: what is written meanwhile counts as new next time.
    seen = {j.table: j.keyed(spark, lake.root, per).newest_version() for j in WINDOW_JOBS}
    upto = F.col("window_start") <= F.lit(as_of).cast("timestamp")
    slot = F.to_date(F.date_trunc(per, F.col("window_start")))
    days = low = high = None
    if noted:
        days = stage(_changed(lake, noted, as_of, per), "changed-days")
        low, high = _range(days)

    def of_days(rows: DataFrame, chosen: DataFrame | None) -> DataFrame:
        if chosen is None:
            return rows
        return rows.withColumn("day", slot).join(
            chosen, ["city", "day"], "left_semi"
        ).drop("day")

    if days is None or low is not None:
        # Last prices of the changed days first; they tell the days whose first window follows.
        priced = None if days is None else days.where("priced").select("city", "day")
        fuel = windows.merge_fuel(window_table(lake, "fuel_price_agg", low, high, per).where(upto))
        benchmark = of_days(fuel.where(F.col("fuel_type") == benchmark_fuel), priced)
        last = benchmark.groupBy("city", slot.alias("price_day")).agg(
            F.max_by("avg_price", "window_start").alias("last_price")
        )
        _edges(lake).put(last, version)
        _edges(lake).fold()
        order = Window.partitionBy("city").orderBy("price_day")
        edges = stage(
            _edges(lake).read().select(
                "city", "price_day",
                F.lag("last_price").over(order).alias("_earlier"),
                F.lag("price_day").over(order).alias("day_before"),
            ),
            "price-edges",
        )
        if days is not None:
            follow = edges.join(
                priced.withColumnRenamed("day", "day_before"), ["city", "day_before"], "left_semi"
            ).select("city", F.col("price_day").alias("day"))
            days = stage(days.select("city", "day").unionByName(follow).distinct(), "feature-days")
            low, high = _range(days)
        fuel, traffic, weather, transport = (
            of_days(window_table(lake, j.table, low, high, per).where(upto), days) for j in WINDOW_JOBS
        )
        earlier = edges.select(
            "city", F.lit(benchmark_fuel).alias("fuel_type"),
            F.col("price_day").cast("timestamp").alias("_slice"), "_earlier",
        )
        built = features.assemble_features(
            windows.merge_fuel(fuel),
            windows.merge_traffic(traffic),
            weather,
            transport,
            holidays if holidays is not None else features.holiday_frame(spark, config.HOLIDAYS),
            benchmark_fuel,
            slice_unit=per,
            earlier=earlier,
        )
        store(lake, per).put(built, version)
        store(lake, per).fold_days()
    stored = stored_features(lake, per=per)
    tables.replace_table(correlation.overall_correlation(stored), lake.path("corr_overall"))
    tables.replace_table(correlation.lagged_correlation(stored), lake.path("corr_lag"))
    # Noted last: a run that fails before computes the same days again.
    state = [(name, newest, as_of) for name, newest in seen.items()]
    _state(lake).put(spark.createDataFrame(state, "source string, last_version long, as_of string"), version)
    _state(lake).fold()
    return [STORE, "corr_overall", "corr_lag"]


def _range(days: DataFrame) -> tuple[str | None, str | None]:
    """First and last day, to prune the partitions that a join on the days would read."""
    row = days.agg(F.min("day").cast("string"), F.max("day").cast("string")).first()
    return row[0], row[1]


def stored_features(
    lake: Lake, low: str | None = None, high: str | None = None, per: str = "day"
) -> DataFrame:
    """The stored features, or those of some days."""
    return store(lake, per).read(low, high)
