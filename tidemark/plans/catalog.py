"""Every operator as a named query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import bands, scores
from tidemark.operators import (
    alerts, anomaly, cleaning, congestion_model, correlation, features, impact, latest,
    mobility_forecast, sequences, windows, zones,
)
from tidemark.plans import cycle, serving
from tidemark.plans.feature_store import run_features
from tidemark.plans.feature_store import stored_features as stored_features_of
from tidemark.session import scratch_path, stage
from tidemark.sources import samples, tables
from tidemark.sources.samples import SampleTables
from tidemark.sources.tables import KeyedTable
from tidemark.streaming import jobs
from tidemark.streaming.events import parse_events

DAY = "1 day"
AS_OF_TRAILING = "2024-03-10 00:00:00"
AS_OF_LIVE = "2024-01-30 12:00:00"
AS_OF_HOUR = 8
FRESH_KINDS = {
    "click": "traffic", "view": "mobility", "purchase": "prediction",
    "signup": "correlation", "error": "cluster",
}

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def named(name: str):
    """Register ``build(tables)`` under ``name``."""

    def register(build: Callable[[SampleTables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(SampleTables(spark, folder))

        REGISTRY[name] = run
        return build

    return register


def query(build: Callable[[SampleTables], DataFrame]):
    """Register ``build(tables)`` under its own name."""
    return named(build.__name__)(build)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: scores.half_up(F.col(n), digits) for n in names})


def dated(df: DataFrame, name: str) -> DataFrame:
    """A date column as a timestamp, which every client reads alike."""
    return df.withColumn(name, F.col(name).cast("timestamp"))


# --- shared inputs -----------------------------------------------------------


def bronze(t: SampleTables) -> DataFrame:
    return samples.road_readings(t.events)


def silver(t: SampleTables) -> DataFrame:
    return cleaning.silver_readings(bronze(t))


def scored(rows: DataFrame) -> DataFrame:
    return anomaly.score_readings(rows, stage(anomaly.baseline_stats(rows), "baseline"))


def daily_features(t: SampleTables) -> DataFrame:
    """The feature table with one-day windows over the sample streams."""
    # Grouped once per source: the bands that the stored tables carry are not needed here.
    fuel = windows.fuel_means(
        samples.fuel_events(t).where(F.col("fuel_type") == samples.BENCHMARK_FUEL), DAY
    )
    return features.assemble_features(
        fuel,
        windows.traffic_means(samples.traffic_events(t), DAY),
        windows.weather_windows(samples.weather_events(t), DAY),
        windows.transport_windows(samples.transport_events(t), DAY),
        sample_holidays(t.spark),
        samples.BENCHMARK_FUEL,
    )


def sample_holidays(spark: SparkSession) -> DataFrame:
    """The fixed-date holidays of the calendar, moved to the years of the samples."""
    days = [d.replace(year=y) for y in range(1992, 2002) for d in config.HOLIDAYS]
    return features.holiday_frame(spark, days)


def stored_features(t: SampleTables) -> DataFrame:
    return stage(daily_features(t), "features")


# --- ingest and cleaning -----------------------------------------------------


@query
def bronze_trailing_window(t):
    return tables.trailing_window(bronze(t), AS_OF_TRAILING, 60).drop("ingest_seq")


@query
def history_fallback(t):
    empty = silver(t).where(F.lit(False))
    return cleaning.history_rows(empty, bronze(t))


@query
def history_silver(t):
    """The same rows from a silver layer that has them."""
    return cleaning.history_rows(silver(t), bronze(t))


@query
def bronze_defaults(t):
    """Weather messages without source, channel and, for dry ones, rain."""
    raw = samples.condition_events(t.events).select(
        "city",
        F.col("weather_main").alias("weather_desc"),
        F.when(F.col("rain_1h") > 0, F.col("rain_1h")).alias("rain_1h"),
        F.when(F.col("event_id") % 2 == 0, "station").alias("source"),
        F.col("event_time").alias("recorded_at"),
    )
    filled = cleaning.with_defaults(raw, source="openweathermap", rain_1h=0.0)
    return dated(rounded(filled, "rain_1h"), "date")


@query
def silver_traffic(t):
    return silver(t)


@query
def level_distribution(t):
    return impact.level_distribution(silver(t))


@query
def period_tag(t):
    tagged = cleaning.tag_period(bronze(t).drop("period"), samples.EVENT_DATE)
    return tagged.groupBy("city", "period").agg(
        F.count("*").alias("records"),
        F.min("recorded_at").alias("first_at"),
        F.max("recorded_at").alias("last_at"),
    )


@query
def derive_congestion(t):
    return cleaning.derive_congestion(bronze(t)).select(
        "ingest_seq", "city", "road_name", "derived_index", "derived_percent"
    )


@query
def weather_score(t):
    rows = samples.condition_events(t.events)
    return rows.select(
        "event_id", "city", "weather_main",
        scores.weather_score(F.col("weather_main"), F.col("rain_1h")).alias("weather_score"),
    )


@query
def transport_load(t):
    rows = samples.transport_events(t).select("city", "transport_code", "ridership", "capacity")
    load = scores.load_factor(F.col("ridership"), F.col("capacity"))
    per = rows.withColumn("load_factor_pct", load).groupBy("city", "transport_code").agg(
        F.count("*").alias("trips"),
        F.sum("ridership").alias("ridership"),
        F.avg("load_factor_pct").alias("avg_load_factor"),
        F.max("load_factor_pct").alias("max_load_factor"),
    )
    return rounded(per, "avg_load_factor", "max_load_factor")


@query
def dq_rejects(t):
    rules = windows.stream_rules()
    streams = {
        "fuel": samples.fuel_events(t),
        "traffic": samples.traffic_events(t),
        "weather": samples.weather_events(t),
        "transport": samples.transport_events(t),
    }
    parts = [windows.rejected_counts(df, name, rules[name]) for name, df in streams.items()]
    road = windows.rejected_counts(
        bronze(t),
        "readings",
        {
            "congestion_range": F.col("congestion_index").between(0, 100),
            "speed_positive": F.col("current_speed") > 0,
        },
    )
    for part in parts:
        road = road.unionByName(part)
    return road


# --- gold --------------------------------------------------------------------


@query
def gold_comparison(t):
    return rounded(impact.city_comparison(silver(t)), "avg_congestion", "avg_speed")


def wide_comparison(rows: DataFrame) -> DataFrame:
    return impact.comparison_wide(impact.city_comparison(rows))


@query
def comparison_wide(t):
    return rounded(
        wide_comparison(silver(t)),
        "before_congestion", "after_congestion", "before_speed", "after_speed",
    )


@query
def gold_hourly(t):
    return rounded(impact.hourly_pattern(silver(t)), "avg_congestion", "avg_speed")


@query
def hourly_dense(t):
    dense = impact.hourly_profile(impact.hourly_pattern(silver(t)))
    return rounded(dense, "before_congestion", "after_congestion")


@query
def best_hour(t):
    return impact.best_travel_hour(impact.hourly_pattern(silver(t)), AS_OF_HOUR)


@query
def daily_impact(t):
    latest_rows = impact.latest_day(impact.daily_summary(silver(t)))
    return dated(rounded(latest_rows, "avg_congestion_index", "avg_speed"), "summary_date")


@query
def fuel_history(t):
    newest = impact.newest_daily(impact.daily_summary(silver(t)), 24, city="city_0")
    return rounded(newest, "avg_congestion_index").select(
        F.col("summary_date").cast("timestamp").alias("timestamp"), "city",
        "avg_congestion_index", "est_extra_fuel_cost_idr",
    )


@query
def price_policy(t):
    return dated(alerts.price_policy(samples.price_table(t)), "effective_date")


@query
def recent_daily(t):
    newest = impact.newest_daily(impact.daily_summary(silver(t)), 15)
    return dated(rounded(newest, "avg_congestion_index", "avg_speed"), "summary_date")


@query
def road_impact(t):
    roads = impact.ranked_roads(impact.road_impact(silver(t)))
    return rounded(roads, "ci_before", "ci_after", "delta_congestion", "lat", "lon")


@query
def city_zone_mode(t):
    return impact.modal_zone(impact.road_impact(silver(t)), "zone_band")


@query
def hourly_trend(t):
    return rounded(impact.hourly_trend(silver(t), hours=168), "congestion_index")


@query
def upsert_comparison(t):
    """Comparison of the first days, updated by the comparison of the later ones."""
    rows = silver(t)
    split = F.lit("2024-01-16").cast("timestamp")
    target = impact.city_comparison(rows.where(F.col("recorded_at") < split))
    updates = impact.city_comparison(rows.where(F.col("recorded_at") >= split))
    merged = tables.upsert(target, stage(updates, "updates"), ["city", "period"])
    return rounded(merged, "avg_congestion", "avg_speed")


@query
def layer_counts(t):
    """The nine layer tables after a cycle with models."""
    lake = cycle.Lake(t.spark, scratch_path(t.spark, "lake"))
    tables.seed_bronze(bronze(t), lake.path("bronze_traffic"))
    tables.write_partitioned(
        samples.condition_events(t.events).withColumn("date", F.to_date("event_time")),
        lake.path("bronze_weather"),
    )
    cycle.run_cycle(lake, CYCLE_AS_OF)
    return serving.layer_counts(lake)


@query
def precision_losses(t):
    """Road values that the published decimals cannot hold, once speeds are scaled up."""
    roads = impact.road_impact(silver(t)).withColumn("ci_after", F.col("ci_after") * 200)
    return tables.beyond_precision(roads)


# --- anomalies ---------------------------------------------------------------


@query
def baseline_stats(t):
    return rounded(anomaly.baseline_stats(silver(t)), "mu", "sigma")


@query
def anomaly_scored(t):
    rows = scored(silver(t)).select(
        "city", "road_name", "recorded_at", "period", "congestion_index", "mu", "sigma", "zscore",
        "is_anomaly",
    )
    return rounded(rows, "mu", "sigma", "zscore")


@query
def anomaly_rate(t):
    return anomaly.anomaly_rate(scored(silver(t)))


@query
def top_anomalies(t):
    top = anomaly.top_anomalies(scored(silver(t)), 200)
    return rounded(top, "baseline_mean", "baseline_stddev", "zscore")


@query
def top_anomalies_city(t):
    top = anomaly.top_anomalies(scored(silver(t)), 50, city="city_1")
    return rounded(top, "baseline_mean", "baseline_stddev", "zscore")


# --- latest state ------------------------------------------------------------


@query
def latest_traffic(t):
    return rounded(latest.latest_readings(bronze(t)), "lat", "lon", "current_speed")


def stored_latest(t: SampleTables) -> DataFrame:
    path = scratch_path(t.spark, "latest-roads")
    tables.write_latest(latest.latest_readings(bronze(t)), path)
    return tables.read_replaced(t.spark, path)


def looked_up(found: DataFrame) -> DataFrame:
    return found.select(
        "city", "road_name", "congestion_index",
        scores.half_up(F.col("current_speed"), 6).alias("current_speed"),
        bands.level_label(bands.congestion_level("congestion_index")).alias("level_label"),
        "recorded_at",
    )


@query
def latest_lookup(t):
    """Latest state of the roads that ever reported a large error value."""
    wanted = (
        t.events.where((F.col("event_type") == "error") & (F.col("value") > 300))
        .select(
            F.concat(F.lit("city_"), (F.col("user_id") % 3).cast("string")).alias("city"),
            F.concat(F.lit("road_"), F.col("user_id").cast("string")).alias("road_name"),
        )
        .distinct()
    )
    return looked_up(latest.lookup_roads(stored_latest(t), wanted))


@query
def road_lookup(t):
    """Latest state of a few roads given by name, one of them in the wrong city."""
    wanted = [("city_0", "road_3"), ("city_1", "road_7"), ("city_2", "road_11"), ("city_0", "road_4")]
    return looked_up(tables.find_roads(stored_latest(t), wanted))


@query
def supported_city(t):
    """Daily traffic of the cities in a dimension that leaves some out."""
    cities = t.region.where(F.col("r_name").startswith("A")).select(F.col("r_name").alias("city"))
    daily = windows.merge_traffic(windows.traffic_windows(samples.traffic_events(t), DAY))
    return rounded(
        latest.supported_only(daily, cities), "avg_congestion", "avg_speed", "avg_mobility_index"
    )


@query
def city_snapshot(t):
    snapshot = latest.city_snapshot(latest.latest_readings(bronze(t)))
    return rounded(snapshot, "avg_congestion", "avg_speed", "mobility_index")


def metric_points(t: SampleTables) -> DataFrame:
    return t.events.select(
        F.col("event_type").alias("metric"),
        F.concat(F.lit("city_"), (F.col("user_id") % 3).cast("string")).alias("city"),
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
    )


@query
def timeseries_range(t):
    return latest.series_range(
        metric_points(t), AS_OF_LIVE, "2024-01-29 00:00:00", "2024-01-30 06:00:00"
    )


@query
def fresh_latest(t):
    kinds = metric_points(t).select(
        bands.lookup("metric", FRESH_KINDS).alias("kind"), "city", "ts", "value"
    )
    ttl = {kind: config.FRESH_SECONDS[kind] for kind in FRESH_KINDS.values()}
    return latest.fresh_latest(kinds, AS_OF_LIVE, ttl)


# --- alerts and serving ------------------------------------------------------


@query
def price_alerts(t):
    found = alerts.price_alerts(samples.price_table(t))
    return rounded(found, "old_price", "new_price")


@query
def budget_projection(t):
    plan = alerts.budget_projection(
        samples.consumption(t), stage(samples.price_table(t), "prices")
    )
    return rounded(
        plan, "daily_before", "daily_after", "extra_daily", "extra_monthly", "extra_yearly",
        digits=4,
    )


@named("alerts")
def all_alerts(t):
    rates = anomaly.anomaly_rate(scored(silver(t)))
    # Any rise is reported here, so that the anomaly alert takes part.
    found = alerts.active_alerts(samples.price_table(t), rates, points=-100.0)
    return rounded(found, "old_price", "new_price")


def mobility_rows(rows: DataFrame, cells: DataFrame) -> DataFrame:
    zones = impact.modal_zone(impact.road_impact(rows), "zone_band")
    wide = impact.comparison_wide(impact.roll_up(cells, "city", "period"))
    return serving.mobility(wide, zones)


def daily_from_cells(cells: DataFrame) -> DataFrame:
    daily = impact.roll_up(cells.withColumnRenamed("date", "summary_date"), "summary_date", "city")
    return impact.with_estimates(daily.withColumnRenamed("avg_congestion", "avg_congestion_index"))


@query
def mobility_score(t):
    rows = silver(t)
    return mobility_rows(rows, impact.reading_cells(rows))


def event_load(t: SampleTables) -> DataFrame:
    """Mean load per city of the transport messages among the events."""
    messages = samples.event_messages(t.events, "transport")
    rows = messages.select(F.from_json("value", jobs.schemas.TRANSPORT_EVENT).alias("e")).select("e.*")
    load = scores.load_factor(F.col("ridership"), F.col("capacity"))
    return rows.groupBy("city").agg(F.avg(load).alias("avg_load_factor"))


@query
def dashboard_snapshot(t):
    rows = silver(t)
    cells = stage(impact.reading_cells(rows), "cells")
    # One price is in force: that of the newest policy (ties: the last fuel by name).
    newest = F.max_by("price_after", F.struct("effective_date", "fuel_type")).alias("price")
    price = samples.price_table(t).agg(newest).first()["price"]
    weather = samples.condition_events(t.events).groupBy("city").agg(
        F.avg(scores.weather_score(F.col("weather_main"), F.col("rain_1h"))).alias("weather_score")
    )
    snapshot = serving.dashboard_snapshot(
        mobility_rows(rows, cells), daily_from_cells(cells), price, weather, event_load(t)
    )
    return dated(
        rounded(snapshot, "avg_congestion_index", "weather_score", "avg_load_factor"), "summary_date"
    )


@query
def kpi_strip(t):
    # Silver is cleaned once: its few columns that the numbers need are stored for both passes.
    rows = stage(
        silver(t).select(
            "city", "period", "recorded_at", "hour", "congestion_index", "current_speed", "free_flow_speed"
        ),
        "kpi-readings",
    )
    cells = stage(impact.reading_cells(rows), "cells")
    baseline = stage(anomaly.baseline_from_cells(cells), "baseline")
    anomalies = anomaly.score_readings(rows, baseline).where("is_anomaly = 1").select("period")
    kpis = serving.kpi_strip(
        impact.comparison_wide(impact.roll_up(cells, "city", "period")),
        anomaly.rate_from_cells(cells, anomalies),
        impact.latest_day(daily_from_cells(cells)),
    )
    return rounded(kpis, "value")


@query
def status_bands(t):
    """Days per display status, from the daily traffic and transport windows."""
    traffic = windows.merge_traffic(windows.traffic_windows(samples.traffic_events(t), DAY))
    transport = windows.transport_windows(samples.transport_events(t), DAY)
    days = traffic.join(transport.select("city", "window_start", "avg_load_factor"),
                        ["city", "window_start"])
    # Rounded first: the daily means often fall exactly on an edge.
    days = rounded(days, "avg_congestion", "avg_load_factor")
    banded = days.select(
        "city",
        bands.above(
            scores.mobility_score(F.col("avg_congestion")),
            config.MOBILITY_STATUS_EDGES, config.MOBILITY_STATUS_LABELS,
        ).alias("mobility_status"),
        bands.below(
            "avg_congestion", config.CONGESTION_STATUS_EDGES, config.CONGESTION_STATUS_LABELS
        ).alias("congestion_status"),
        bands.above(
            "avg_load_factor", config.LOAD_STATUS_EDGES, config.LOAD_STATUS_LABELS
        ).alias("load_status"),
    )
    return banded.groupBy(*banded.columns).agg(F.count("*").alias("days"))


# --- stream windows as batch -------------------------------------------------


@query
def fuel_windows(t):
    rows = windows.fuel_windows(samples.fuel_events(t), DAY)
    return rounded(rows, "avg_price", "min_price", "max_price", "is_weekend")


@query
def traffic_windows(t):
    rows = windows.traffic_windows(samples.traffic_events(t), DAY)
    return rounded(rows, "avg_congestion", "avg_speed", "avg_mobility_index")


@query
def weather_windows(t):
    rows = windows.weather_windows(samples.weather_events(t), DAY)
    return rounded(rows, "avg_weather_score", "avg_temperature", "avg_humidity", "avg_rain_1h")


@query
def transport_windows(t):
    return rounded(
        windows.transport_windows(samples.transport_events(t), DAY), "avg_load_factor"
    )


@query
def distinct_estimates(t):
    """Different roads and modes per city and year, united from the sketches of the days, and
    whether the estimates lie within 5 percent of the exact numbers."""
    parts = []
    for kind, built, events, of, rule in (
        ("road", windows.traffic_windows(samples.traffic_events(t), DAY, extras=True),
         windows.valid_traffic(samples.traffic_events(t)), "road_id", "distinct_roads"),
        ("mode", windows.transport_windows(samples.transport_events(t), DAY, extras=True),
         windows.valid_transport(samples.transport_events(t)), "transport_mode", "distinct_modes"),
    ):
        yearly = built.withColumn("year", F.year("window_start"))
        united = windows.with_estimates(windows.merge_sketches(yearly, "city", "year"))
        exact = events.groupBy("city", F.year("event_time").alias("year")).agg(
            F.countDistinct(of).alias("exact")
        )
        near = F.abs(F.col(rule) - F.col("exact")) <= 0.05 * F.col("exact")
        parts.append(united.join(exact, ["city", "year"]).select(
            F.lit(kind).alias("kind"), "city", "year", "exact", near.alias("near")
        ))
    return parts[0].unionByName(parts[1])


# --- features, correlation, sequences ----------------------------------------


@query
def fuel_delta(t):
    merged = windows.merge_fuel(windows.fuel_windows(samples.fuel_events(t), DAY))
    return rounded(features.price_delta(merged), "avg_price", "prev_avg_price", "fuel_price_delta")


@query
def feature_table(t):
    return rounded(
        daily_features(t),
        "avg_price", "fuel_price_delta", "traffic_index", "avg_congestion", "avg_speed",
        "avg_mobility_index", "transport_usage_norm", "avg_load_factor", "weather_score_norm",
        "avg_temperature", "avg_rain_1h",
    )


@query
def forecast_features(t):
    rows = features.forecast_inputs(daily_features(t)).select(
        "city", "window_start", "time_of_day_norm", "day_of_week_norm", "holiday_flag",
        "mobility_composite",
    )
    return rounded(rows, "time_of_day_norm", "day_of_week_norm")


@query
def feature_resample(t):
    """Seven-day means of the feature table."""
    means = ["mobility_composite", "traffic_index", "fuel_price_delta"]
    return rounded(features.resample(daily_features(t), "7 days", means), *means)


@query
def corr_overall(t):
    return rounded(correlation.overall_correlation(daily_features(t)), "pearson_r", "p_value")


@query
def corr_sliding(t):
    return correlation.sliding_correlation(stored_features(t))


@query
def corr_lag(t):
    return correlation.lagged_correlation(stored_features(t))


@query
def corr_best_lag(t):
    return correlation.best_lag(correlation.lagged_correlation(stored_features(t)))


@query
def corr_report(t):
    table = stored_features(t)
    report = correlation.correlation_report(
        correlation.overall_correlation(table), correlation.lagged_correlation(table)
    )
    return rounded(report, "pearson_r", "p_value")


@query
def corr_report_csv(t):
    """The overall report written as one CSV folder per city, and read back."""
    report = rounded(
        correlation.overall_correlation(daily_features(t)), "pearson_r", digits=4
    ).drop("p_value")
    path = scratch_path(t.spark, "report")
    tables.export_csv(report, path)
    found = t.spark.read.schema(report.schema).option("header", True).csv(path)
    # Spark puts the folders' column last, but not where there is no folder.
    return found.select(*(c for c in report.columns if c != "city"), "city")


def sample_sequences(t: SampleTables) -> DataFrame:
    return sequences.training_sequences(features.forecast_inputs(stored_features(t)))


@query
def sequences_summary(t):
    rows = sample_sequences(t)
    traffic = F.transform("x", lambda row: row[1])
    mean_of = lambda a, size: F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v) / size
    return rounded(
        rows.select(
            "city", "window_start", "pos",
            F.size("x").alias("x_rows"),
            F.size("y").alias("y_rows"),
            mean_of(traffic, 48).alias("x_mean_traffic"),
            F.col("x")[0][0].alias("x_first_delta"),
            F.col("x")[47][5].alias("x_last_day"),
            F.col("y")[0].alias("y_first"),
            F.col("y")[47].alias("y_last"),
            mean_of(F.col("y"), 48).alias("y_mean"),
        ),
        "x_mean_traffic", "x_first_delta", "x_last_day", "y_first", "y_last", "y_mean",
    )


@query
def chrono_split(t):
    split = sequences.chronological_split(sample_sequences(t).drop("x", "y"))
    return split.groupBy("city", "split").agg(
        F.count("*").alias("sequences"),
        F.min("window_start").alias("first_at"),
        F.max("window_start").alias("last_at"),
    )


@query
def recent_context(t):
    rows = sequences.recent_context(features.forecast_inputs(daily_features(t))).select(
        "city", "window_start", "steps_back", "fuel_price_delta", "traffic_index",
        "mobility_composite",
    )
    return rounded(rows, "fuel_price_delta", "traffic_index")


# --- streams -----------------------------------------------------------------


def drain_windows(t: SampleTables, kind: str, table: str) -> DataFrame:
    """Run one window job over the events until they are used up; the stored windows."""
    job = next(j for j in jobs.WINDOW_JOBS if j.table == table)
    lake = scratch_path(t.spark, "stream")
    running = jobs.start_windows(
        {job.topic: samples.event_messages(samples.events_stream(t), kind)},
        lake, f"{lake}/checkpoints", trigger=None,
        state_partitions=t.spark.sparkContext.defaultParallelism,
    )
    running[table].awaitTermination()
    return job.keyed(t.spark, lake).read()


@query
def stream_left_out(t):
    """Events of the traffic stream that no window took, counted as they passed."""
    job = next(j for j in jobs.WINDOW_JOBS if j.table == "traffic_agg")
    lake = scratch_path(t.spark, "stream")
    events = samples.events_stream(t)
    raw = samples.event_messages(events.where("event_id % 50 <> 0"), "traffic").unionByName(
        samples.event_messages(events.where("event_id % 50 = 0"), "traffic").withColumn(
            "value", F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"soon"')
        )
    )
    running = jobs.start_windows(
        {job.topic: raw}, lake, f"{lake}/checkpoints", trigger=None,
        state_partitions=t.spark.sparkContext.defaultParallelism,
    )[job.table]
    running.awaitTermination()
    log = jobs.progress_log(t.spark, f"{lake}/progress", job.table)
    jobs.log_progress(running, job.table, log)
    return log.read().groupBy("stream").agg(
        *[F.sum(c).alias(c) for c in ("events", "invalid", "no_time", "late")]
    )


@query
def stream_fresh(t):
    """Values that still live at the newest time of the stream, kept by keyed state."""
    events = samples.events_stream(t).select(
        F.col("event_type").alias("metric"),
        F.concat(F.lit("city_"), (F.col("user_id") % 3).cast("string")).alias("city"),
        F.col("ts").cast("timestamp").alias("ts"), "value",
    )
    values = events.withColumn("kind", bands.lookup("metric", FRESH_KINDS))
    path = scratch_path(t.spark, "fresh")
    table = KeyedTable(
        t.spark, f"{path}/values", ("kind", "city"), schema="kind string, city string, ts timestamp, value double"
    )
    ttl = {kind: config.FRESH_SECONDS[kind] for kind in FRESH_KINDS.values()}
    jobs.write_fresh(
        jobs.fresh_values(values, ttl), table, f"{path}/checkpoint", trigger=None,
        state_partitions=t.spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    return table.read()


@query
def stream_fuel_windows(t):
    rows = drain_windows(t, "fuel", "fuel_price_agg")
    return rounded(rows, "avg_price", "min_price", "max_price", "is_weekend")


@query
def stream_traffic_windows(t):
    rows = drain_windows(t, "traffic", "traffic_agg")
    return rounded(rows, "avg_congestion", "avg_speed", "avg_mobility_index")


@query
def stream_weather_windows(t):
    rows = drain_windows(t, "weather", "weather_agg")
    return rounded(rows, "avg_weather_score", "avg_temperature", "avg_humidity", "avg_rain_1h")


@query
def stream_transport_windows(t):
    return rounded(drain_windows(t, "transport", "transport_agg"), "avg_load_factor")


@query
def stream_bronze_ingest(t):
    """Readings and weather demultiplexed from one stream into two bronze tables."""
    events = samples.events_stream(t)
    raw = samples.event_messages(events, "reading").unionByName(
        samples.event_messages(events, "condition")
    )
    lake = scratch_path(t.spark, "bronze")
    jobs.split_topics(raw, lake, f"{lake}/checkpoints", trigger=None).awaitTermination()
    parts = [
        jobs.bronze_rows(t.spark, lake, table)
        .groupBy("city", "date", "source", "ingested_via")
        .agg(F.count("*").alias("records"))
        .withColumn("bronze_table", F.lit(table))
        for table in jobs.BRONZE_TOPICS
    ]
    return dated(parts[0].unionByName(parts[1]), "date")


@query
def bronze_rejects(t):
    """Messages that bronze cannot take: cut off, without city, without time, of no known topic."""
    events = samples.events_stream(t)
    part = F.col("event_id") % 40
    kinds = {
        0: {"value": F.substring("value", 1, 20)},
        1: {"value": F.regexp_replace("value", '"recorded_at":"[^"]*"', '"recorded_at":"soon"')},
        2: {"value": F.regexp_replace("value", '"city":"[^"]*",', "")},
        3: {"topic": F.lit("other.raw")},
    }
    raw = samples.event_messages(events.where(part > 3), "reading")
    for k, change in kinds.items():
        raw = raw.unionByName(samples.event_messages(events.where(part == k), "reading").withColumns(change))
    lake = scratch_path(t.spark, "rejects")
    jobs.split_topics(raw, lake, f"{lake}/checkpoints", trigger=None).awaitTermination()
    kept = jobs.bronze_rows(t.spark, lake, "bronze_traffic").select(
        F.lit("traffic.raw").alias("topic"), F.lit("kept").alias("reason")
    )
    rejects = jobs.bronze_rows(t.spark, lake, "bronze_rejects").select("topic", "reason")
    return kept.unionAll(rejects).groupBy("topic", "reason").agg(F.count("*").alias("messages"))


@query
def feature_store(t):
    """Windows written by the streams' tables, features stored as a run, read back."""
    lake = cycle.Lake(t.spark, scratch_path(t.spark, "features"))
    built = (
        windows.fuel_windows(samples.fuel_events(t), DAY),
        windows.traffic_windows(samples.traffic_events(t), DAY),
        windows.weather_windows(samples.weather_events(t), DAY),
        windows.transport_windows(samples.transport_events(t), DAY),
    )
    for job, rows in zip(jobs.WINDOW_JOBS, built):
        job.keyed(t.spark, lake.root, "month").put(rows, 0)
    run_features(
        lake, "2030-01-01 00:00:00", samples.BENCHMARK_FUEL, sample_holidays(t.spark), per="month"
    )
    return rounded(
        stored_features_of(lake, per="month"),
        "avg_price", "fuel_price_delta", "traffic_index", "avg_congestion", "avg_speed",
        "avg_mobility_index", "transport_usage_norm", "avg_load_factor", "weather_score_norm",
        "avg_temperature", "avg_rain_1h",
    )


@query
def feature_store_late(t):
    """The same features when the windows come in two parts: a first run sees the earlier
    fuel prices and none of the later years, a second one computes what changed."""
    lake = cycle.Lake(t.spark, scratch_path(t.spark, "features"))
    built = (
        windows.fuel_windows(samples.fuel_events(t), DAY),
        windows.traffic_windows(samples.traffic_events(t), DAY),
        windows.weather_windows(samples.weather_events(t), DAY),
        windows.transport_windows(samples.transport_events(t), DAY),
    )
    late = (F.year("window_start") >= 1998) | (F.dayofyear("window_start") % 97 == 0)
    for version, part in enumerate((~late, late)):
        for job, rows in zip(jobs.WINDOW_JOBS, built):
            job.keyed(t.spark, lake.root, "month").put(rows.where(part), version)
        run_features(
            lake, f"2030-01-01 00:0{version}:00", samples.BENCHMARK_FUEL, sample_holidays(t.spark), per="month"
        )
    return rounded(
        stored_features_of(lake, per="month"),
        "avg_price", "fuel_price_delta", "traffic_index", "avg_congestion", "avg_speed",
        "avg_mobility_index", "transport_usage_norm", "avg_load_factor", "weather_score_norm",
        "avg_temperature", "avg_rain_1h",
    )


@query
def stream_joined_windows(t):
    """The four streams joined per city and window; closed windows only."""
    streams = {
        job.topic: parse_events(
            samples.event_messages(samples.events_stream(t), kind), job.schema
        )
        for job, kind in zip(jobs.WINDOW_JOBS, ("fuel", "traffic", "weather", "transport"))
    }
    path = scratch_path(t.spark, "joined")
    joined = jobs.join_windows(*streams.values())
    with jobs.shuffle_width(t.spark, t.spark.sparkContext.defaultParallelism):
        (
            joined.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", f"{path}-checkpoint")
            .trigger(availableNow=True).start().awaitTermination()
        )
    return rounded(
        t.spark.read.schema(joined.schema).parquet(path),
        "avg_price", "avg_congestion", "avg_speed", "avg_weather_score",
    )


@query
def stream_live_feed(t):
    """Latest road states kept by a stream, averaged per city."""
    raw = samples.event_messages(samples.events_stream(t), "reading")
    readings = jobs.parse_readings(raw, jobs.schemas.ROAD_READING)
    path = scratch_path(t.spark, "live")
    roads = KeyedTable(t.spark, f"{path}/roads", ("city", "road_name"), schema=jobs.ROADS_SCHEMA)
    jobs.write_keyed(
        jobs.latest_road_stream(readings), roads, f"{path}/checkpoint", trigger=None,
        state_partitions=t.spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    return jobs.live_feed(roads.read())


# --- models ------------------------------------------------------------------


def fitted_classifier(t: SampleTables):
    """Silver, its mean speeds and the model, which is None with too few readings."""
    rows = silver(t)
    return rows, stage(congestion_model.speed_means(rows), "speed-means"), congestion_model.fit_classifier(rows).model


@query
def rf_metrics(t):
    return congestion_model.fit_classifier(silver(t)).frame


@query
def rf_forecast(t):
    rows, means, model = fitted_classifier(t)
    change = wide_comparison(rows).select("city", "change_pct")
    current = latest.city_snapshot(latest.latest_readings(rows)).select(
        "city", F.col("avg_congestion").alias("current_congestion")
    )
    return congestion_model.forecast(
        model, means, AS_OF_LIVE, current.join(change, "city", "left")
    )


@query
def forecast_by_city(t):
    _, means, model = fitted_classifier(t)
    return congestion_model.forecast_by_city(congestion_model.forecast(model, means, AS_OF_LIVE))


@query
def forecast_steps(t):
    """Present predictions with stored ones of an earlier hour, and a placeholder."""
    rows, means, model = fitted_classifier(t)
    columns = ["city", "horizon_minutes", "predicted_level", "predicted_at"]
    cached = congestion_model.forecast(model, means, AS_OF_LIVE).select(columns)
    earlier = congestion_model.forecast(
        model, means, "2024-01-30 10:00:00", speed_share={30: 1.0, 60: 0.95, 90: 0.9}
    ).select(columns)
    steps = serving.forecast_steps(cached, earlier)
    cities = rows.select("city").distinct()
    return serving.with_placeholder(steps, cities)


# The same queries over fixed predictions and clusters, which SQL can follow.


def newest_per_horizon(predictions: DataFrame) -> DataFrame:
    return cleaning.keep_latest(predictions, ("city", "horizon_minutes"), [F.col("predicted_at").desc()])


@query
def latest_predictions(t):
    return serving.newest_predictions(samples.prediction_table(t), 24).drop("current_avg_speed")


@query
def forecast_sides(t):
    """Both horizons of the newest predictions side by side."""
    newest = newest_per_horizon(samples.prediction_table(t).where("horizon_minutes <= 60"))
    return congestion_model.forecast_by_city(
        newest.withColumn("predicted_label", bands.level_label("predicted_level"))
    )


@query
def forecast_steps_stored(t):
    """Cached predictions of two cities, stored ones of all, a placeholder for the others."""
    predictions = stage(samples.prediction_table(t).drop("current_avg_speed"), "predictions")
    cached = newest_per_horizon(predictions.where("city <> 'city_2' AND horizon_minutes <= 60"))
    stored = predictions.where(F.col("predicted_at") < F.lit("2024-01-25").cast("timestamp"))
    cities = t.events.select(F.concat(F.lit("city_"), (F.col("user_id") % 5).cast("string")).alias("city"))
    return serving.with_placeholder(serving.forecast_steps(cached, stored), cities.distinct())


def fixed_clusters(t: SampleTables) -> DataFrame:
    return stage(samples.with_fixed_clusters(impact.road_impact(silver(t))), "fixed-clusters")


@query
def cluster_ranking(t):
    """Zone label of every fixed road cluster, by its rank."""
    roads = fixed_clusters(t)
    sizes = roads.groupBy("zone_cluster").agg(F.count("*").alias("roads"))
    return zones.zone_names(roads).join(sizes, "zone_cluster")


@query
def cluster_levels(t):
    """Impact level of every fixed cluster, joined back to its roads."""
    drops = fixed_clusters(t).select(
        "city", "road_name", F.col("zone_cluster").alias("cluster"),
        F.col("delta_congestion").alias("avg_mobility_drop"),
    )
    return drops.join(zones.impact_levels(drops), "cluster").select(
        "city", "road_name", "cluster", "impact_level"
    )


@query
def cluster_overview_fixed(t):
    roads = fixed_clusters(t)
    labelled = stage(roads.join(zones.zone_names(roads), "zone_cluster"), "labelled-roads")
    overview = serving.cluster_overview(labelled, stage(impact.modal_zone(labelled), "city-zones"))
    return overview.select("city", "road_name", "zone_cluster", "zone_label", "city_zone", "impact_level")


@query
def confusion_metrics(t):
    """Accuracy and F1 of a fixed guess: the level that the speed alone suggests."""
    rows = silver(t)
    guess = F.when(F.col("current_speed") > 50, 0.0).when(F.col("current_speed") > 40, 1.0).when(
        F.col("current_speed") > 32, 2.0).otherwise(3.0)
    predictions = rows.select(F.col("congestion_level").cast("double").alias("label"), guess.alias("prediction"))
    counts = rows.agg(
        F.count_if(F.col("hour") < 12).alias("train_rows"), F.count_if(F.col("hour") > 20).alias("dropped_rows")
    )
    return congestion_model.metrics(predictions, counts)


def clustered_roads(t: SampleTables) -> DataFrame:
    """Roads with their cluster zone; without rows when there are fewer roads than clusters."""
    return zones.cluster_roads(stage(impact.road_impact(silver(t)), "roads")).frame


@query
def road_zones(t):
    return clustered_roads(t)


@query
def cluster_overview(t):
    roads = stage(clustered_roads(t), "zones")
    return serving.cluster_overview(roads, stage(impact.modal_zone(roads), "city-zones"))


@query
def city_clusters(t):
    return zones.fit_city_clusters(stage(samples.city_impact(t), "cities")).frame


@query
def city_cluster_scores(t):
    """Cities scored by a saved and reloaded cluster model."""
    cities = stage(samples.city_impact(t), "cities")
    model = zones.fit_city_clusters(cities).model
    if model is None:
        return zones.score_cities(None, None, cities)
    path = scratch_path(t.spark, "clusters")
    zones.save_clusters(model, zones.impact_levels(model.transform(cities)), path)
    return zones.score_cities(*zones.load_clusters(t.spark, path), cities)


def fitted_forecast(t: SampleTables):
    """Forecast inputs, and the weights per city with their errors."""
    inputs = features.forecast_inputs(stored_features(t))
    return inputs, mobility_forecast.fit_forecast(sequences.sequence_rows(inputs), steps_per_day=1)


@query
def mobility_gram(t):
    """The normal equations of every city, one mean product a row."""
    built = sequences.sequence_rows(features.forecast_inputs(stored_features(t)))
    rows = mobility_forecast.training_rows(sequences.chronological_split(built), steps_per_day=1)
    sums = mobility_forecast.gram_sums(rows.where("split = 'train'"))
    n = F.col("gram")[0]
    means = F.transform(F.concat("gram", "moments"), lambda total: total / n)
    flat = sums.select("city", F.posexplode(means).alias("place", "mean_product"))
    return rounded(flat, "mean_product", digits=5)


@query
def mobility_forecast_errors(t):
    return fitted_forecast(t)[1].frame


@query
def mobility_forecast_steps(t):
    inputs, fitted = fitted_forecast(t)
    if not fitted.held:
        return t.spark.createDataFrame([], mobility_forecast.STEPS_SCHEMA)
    return mobility_forecast.forecast_mobility(fitted.model, inputs, steps_per_day=1)


# --- the whole cycle ---------------------------------------------------------


@query
def medallion_cycle(t):
    """Seed bronze, run one cycle with models, and count the rows of every table."""
    lake = cycle.Lake(t.spark, scratch_path(t.spark, "lake"))
    tables.seed_bronze(bronze(t), lake.path("bronze_traffic"))
    written = cycle.run_cycle(lake, "2024-02-01 00:00:00")
    return impact.table_counts(t.spark, {name: lake.read(name) for name in sorted(set(written))})


CYCLE_AS_OF = "2024-02-01 00:00:00"
# A cycle in the middle of the readings, of which two days were corrected after an earlier one.
CYCLE_EARLY, CYCLE_LATE = "2024-01-20 12:00:00", "2024-01-26 18:30:00"
CYCLE_BAD_DAYS = ("2024-01-10", "2024-01-23")


def corrected_lake(t: SampleTables) -> cycle.Lake:
    """A full cycle, two days withdrawn by a later batch, then an incremental cycle."""
    lake = cycle.Lake(t.spark, scratch_path(t.spark, "lake"))
    readings = bronze(t)
    tables.seed_bronze(readings, lake.path("bronze_traffic"))
    cycle.run_cycle(lake, CYCLE_EARLY, with_models=False)
    bad = readings.where(F.to_date("recorded_at").cast("string").isin(*CYCLE_BAD_DAYS))
    fixed = bad.withColumns(
        {"ingest_seq": F.col("ingest_seq") + 10**12, "current_speed": F.lit(0.0)}
    )
    tables.write_partitioned(
        cleaning.with_defaults(fixed).withColumn("ingest_batch", F.lit(1)),
        lake.path("bronze_traffic"), by=tables.BRONZE_PARTITIONS,
    )
    cycle.run_cycle(lake, CYCLE_LATE, with_models=False, incremental=True)
    return lake


@query
def cycle_silver(t):
    """Readings per city and day that silver holds after the correction."""
    lake = corrected_lake(t)
    days = lake.read("silver_traffic").groupBy("city", F.to_date("recorded_at").alias("day"))
    return dated(days.agg(F.count("*").alias("readings")), "day")


@query
def cycle_comparison(t):
    rows = corrected_lake(t).keyed("gold_city_comparison").read().drop("computed_at")
    return rounded(rows, "avg_congestion", "avg_speed")


@query
def cycle_hourly(t):
    rows = corrected_lake(t).keyed("gold_hourly_pattern").read().drop("computed_at")
    return rounded(rows, "avg_congestion", "avg_speed")


@query
def cycle_daily(t):
    """Two summaries: the newest day of either cycle."""
    rows = corrected_lake(t).keyed("gold_daily_summary").read().drop("computed_at")
    return dated(rounded(rows, "avg_congestion_index", "avg_speed"), "summary_date")


@query
def cycle_anomaly_rate(t):
    return corrected_lake(t).keyed("gold_anomaly_rate").read().drop("computed_at")


@query
def cycle_top_anomalies(t):
    lake = corrected_lake(t)
    rows = lake.stored("gold_anomalies")
    return rounded(rows, "baseline_mean", "baseline_stddev", "zscore")


@query
def gold_summary(t):
    """The serving documents after one cycle without models."""
    lake = cycle.Lake(t.spark, scratch_path(t.spark, "lake"))
    tables.seed_bronze(bronze(t), lake.path("bronze_traffic"))
    cycle.run_cycle(lake, CYCLE_AS_OF, with_models=False)
    return lake.read("serving_documents")


@query
def snapshot_pages(t):
    """Road records per city in bounded pages."""
    # One row per road: both the page count and the pages read it.
    pages = latest.road_pages(stage(latest.latest_readings(bronze(t)), "latest"))
    return pages.select("city", "page", F.to_json("roads").alias("roads"))


@query
def snapshot_roads(t):
    """The road records of all pages, one row each: no road is lost or doubled by the paging."""
    pages = latest.road_pages(stage(latest.latest_readings(bronze(t)), "latest"))
    records = pages.select("city", F.explode("roads").alias("r")).select("city", "r.*")
    return rounded(records, "lat", "lon", "current_speed")


@query
def gold_summary_fields(t):
    """The comparison documents after one cycle, parsed back into their fields."""
    lake = cycle.Lake(t.spark, scratch_path(t.spark, "lake"))
    tables.seed_bronze(bronze(t), lake.path("bronze_traffic"))
    cycle.run_cycle(lake, CYCLE_AS_OF, with_models=False)
    side = "struct<avg_congestion: double, avg_speed: double, records: bigint>"
    parsed = F.from_json("document", f"before {side}, after {side}, change_pct double")
    documents = lake.read("serving_documents").where(F.col("key").startswith("comparison:"))
    return documents.select(F.col("key"), parsed.alias("d")).select(
        "key", "d.change_pct",
        *[F.col(f"d.{p}.{f}").alias(f"{p}_{f}") for p in ("before", "after")
          for f in ("avg_congestion", "avg_speed", "records")],
    )


@query
def daily_documents(t):
    """The daily documents of a corrected lake, parsed back into their fields."""
    fields = ("avg_congestion_index double, avg_speed double, est_extra_fuel_cost_idr double, "
              "est_extra_travel_min double, summary_date timestamp, city string")
    documents = corrected_lake(t).read("serving_documents").where(F.col("key").startswith("daily:"))
    return documents.select("key", F.from_json("document", fields).alias("d")).select("key", "d.*")


@query
def hourly_documents(t):
    """The hourly documents of a corrected lake, one row per city, period and hour."""
    cell = "struct<avg_congestion: double, avg_speed: double>"
    documents = corrected_lake(t).read("serving_documents").where(F.col("key").startswith("hourly:"))
    parsed = documents.select("key", F.from_json("document", f"map<string, map<string, {cell}>>").alias("d"))
    hours = parsed.select("key", F.explode("d").alias("period", "hours")).select(
        "key", "period", F.explode("hours").alias("hour", "c")
    )
    return hours.select("key", "period", F.col("hour").cast("int").alias("hour"), "c.*")


@query
def timeseries_store(t):
    """Points appended in two batches, one of them twice, with the expired days removed."""
    path = scratch_path(t.spark, "points")
    points = metric_points(t)
    late = F.col("ts") >= F.lit("2024-01-29 12:00:00").cast("timestamp")
    for batch, rows in enumerate((points.where(~late), points.where(late), points.where(late))):
        tables.append_points(rows, path, min(batch, 1))
    tables.expire_points(t.spark, path, AS_OF_LIVE, keep_seconds=86_400)
    return latest.series_range(
        tables.read_points(t.spark, path), AS_OF_LIVE, "2024-01-29 00:00:00", "2024-01-30 06:00:00"
    )
