"""The periodic medallion cycle: bronze to silver, gold and models."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import ImpactSettings
from tidemark.operators import anomaly, cleaning, congestion_model, impact, latest, zones
from tidemark.session import stage
from tidemark.sources import files, tables
from tidemark.sources.tables import KeyedTable

# Keyed gold tables and their natural keys.
GOLD_KEYS = {
    "gold_city_comparison": ("city", "period"),
    "gold_hourly_pattern": ("city", "hour", "period"),
    "gold_daily_summary": ("summary_date", "city"),
    "gold_road_clusters": ("city", "road_name"),
    "gold_anomaly_rate": ("period",),
    "cycle_state": ("task",),
}
# Tables that every cycle replaces as a whole.
REPLACED = (
    "silver_baseline", "gold_anomalies", "gold_road_impact", "latest_roads", "serving_documents",
)


@dataclass(frozen=True)
class Lake:
    """Where the tables of one deployment live."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        """A table at its published precision; one that was never written is empty."""
        return tables.published_precision(self.stored(table))

    def stored(self, table: str) -> DataFrame:
        """A table as it is stored: unrounded, so that differences of means are not
        differences of rounded means."""
        if table in GOLD_KEYS:
            return self.keyed(table).read()
        if not self.has(table) and table in schemas.GOLD:
            return self.spark.createDataFrame([], schemas.GOLD[table])
        if table in REPLACED:
            return tables.read_replaced(self.spark, self.path(table))
        if table == "silver_traffic":
            return tables.read_silver(self.spark, self.path(table))
        return self.spark.read.parquet(self.path(table))

    def has(self, table: str) -> bool:
        return tables.table_exists(self.spark, self.path(table))

    def keyed(self, table: str) -> KeyedTable:
        return KeyedTable(self.spark, self.path(table), GOLD_KEYS[table], schema=schemas.GOLD.get(table))


def _ingest_order(readings: DataFrame) -> str:
    """The column that tells which copy of a reading came in last."""
    known = (c for c in ("ingest_seq", "ingested_at") if c in readings.columns)
    return next(known, "recorded_at")


def _noted(lake: Lake):
    """What the last finished cycle noted; None before the first."""
    return lake.keyed("cycle_state").read().where("task = 'silver'").first()


def last_batch(lake: Lake) -> int | None:
    """The newest ingest batch that a finished cycle has cleaned; None before the first."""
    noted = _noted(lake)
    return noted["last_batch"] if noted else None


def changed_days(as_of: str, noted_at: str, touched: list[str], trailing_days: int) -> list[str]:
    """Days of the window whose cells may differ from those of the cycle at ``noted_at``: the
    touched ones, and those that either end of the window has passed or holds a part of."""
    now, before = date.fromisoformat(as_of[:10]), date.fromisoformat(noted_at[:10])
    span = timedelta(days=trailing_days)
    days = {date.fromisoformat(d) for d in touched}
    for low, high in (sorted((now, before)), sorted((now - span, before - span))):
        days |= {low + timedelta(days=k) for k in range((high - low).days + 1)}
    return sorted(str(d) for d in days if now - span <= d <= now)


def refresh_cells(
    lake: Lake, as_of: str, trailing_days: int, days: list[str] | None
) -> DataFrame:
    """The stored reading cells of the trailing window, by date; only ``days`` are computed
    again (None: all).  Days that left the window, or lost all their readings, go."""
    spark, path = lake.spark, lake.path("silver_cells")
    silver = tables.within(lake.stored("silver_traffic"), as_of, trailing_days)
    if days is not None:
        silver = silver.where(F.col("date").isin([F.lit(d).cast("date") for d in days]))
    fresh = stage(impact.reading_cells(silver), "cells")
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    first = str(date.fromisoformat(as_of[:10]) - timedelta(days=trailing_days))
    # One value a day.
    filled = {str(r["date"]) for r in fresh.select("date").distinct().collect()}
    for name in files.children(spark, path):
        day = name.removeprefix("date=")
        stale = day not in filled if days is None else day in days and day not in filled
        if name.startswith("date=") and (day < first or day > as_of[:10] or stale):
            files.remove(spark, f"{path}/{name}")
    return lake.stored("silver_cells")


def run_cycle(
    lake: Lake,
    as_of: str,
    settings: ImpactSettings = ImpactSettings(),
    with_models: bool = True,
    after_batch: int | None = None,
    incremental: bool = False,
) -> list[str]:
    """One pass at time ``as_of``; returns the tables that were written.

    With ``after_batch`` only the days that later ingest batches touched are
    cleaned again; ``incremental`` takes the batch that the last finished cycle
    noted.  Gold always follows the readings of the trailing window up to
    ``as_of``, also when no batch is new, since the window moves on.  Every step
    reads stored tables, so a failed cycle can simply run again: it replaces what
    it wrote.  The cells of days that nothing touched are kept from the cycle before.
    The driver sees only guards, dates and k-means centres.
    """
    spark = lake.spark
    noted = _noted(lake) if incremental else None
    if noted and after_batch is None:
        after_batch = noted["last_batch"]
    if not lake.has("bronze_traffic"):
        return []
    # Whole days, since silver partitions are replaced by day.  Later readings are cleaned
    # too: a cycle that reaches their time need not find their batch new.
    midnight = f"{as_of[:10]} 00:00:00"
    stored = spark.read.parquet(lake.path("bronze_traffic"))
    batch = stored.agg(F.max("ingest_batch").alias("batch")).first()["batch"]
    bronze = tables.within(stored, midnight, settings.trailing_days, ahead=True)
    days = touched = None
    if after_batch is not None:
        days = stage(tables.touched_dates(bronze, after_batch), "touched-days")
        # One value a day.
        touched = [str(r["date"]) for r in days.collect()]
        bronze = bronze.where(F.col("date").isin([F.lit(d).cast("date") for d in touched]))
    written = []
    sequence = _ingest_order(stored)
    if touched is None or touched:
        bronze = tables.trailing_window(bronze, midnight, settings.trailing_days, ahead=True)
        tables.refresh_silver(
            cleaning.silver_readings(cleaning.nan_to_null(bronze), sequence),
            lake.path("silver_traffic"), days,
        )
        written.append("silver_traffic")
    if not lake.has("silver_traffic"):
        return []
    version = int(datetime.fromisoformat(as_of).replace(tzinfo=timezone.utc).timestamp())

    def put(table: str, rows: DataFrame, within: Column | None = None) -> DataFrame:
        """Store the rows of this pass; keys (``within`` a condition) that it lacks are gone."""
        stamped = rows.withColumn("computed_at", F.lit(as_of).cast("timestamp"))
        keyed = lake.keyed(table)
        gone = None
        if keyed.exists():
            held = keyed.read().select(*keyed.keys)
            if within is not None:
                held = held.where(within)
            # Null is a key like any other.
            known = stamped.select(*(F.col(k).alias(f"_{k}") for k in keyed.keys))
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keyed.keys]
            gone = stage(held.join(known, reduce(lambda a, b: a & b, same), "left_anti"), "gone-keys")
        keyed.put(stamped, version, gone)
        written.append(table)
        return stamped

    def replace(table: str, rows: DataFrame) -> DataFrame:
        tables.replace_table(rows, lake.path(table))
        written.append(table)
        return tables.read_replaced(spark, lake.path(table))

    # The means below roll up from the few rows of the cells.
    since = None
    if touched is not None and noted and noted["as_of"] and lake.has("silver_cells"):
        since = changed_days(as_of, noted["as_of"], touched, settings.trailing_days)
    cells = refresh_cells(lake, as_of, settings.trailing_days, since)
    written.append("silver_cells")
    comparison = put(
        "gold_city_comparison",
        impact.roll_up(cells, "city", "period").select(
            "city", "period", "avg_congestion", "avg_speed", "record_count"
        ),
    )
    hourly = put(
        "gold_hourly_pattern",
        impact.roll_up(cells, "city", "period", "hour").select(
            "city", "period", "hour", "avg_congestion", "avg_speed"
        ),
    )
    daily = impact.roll_up(cells, "city", "date").withColumnsRenamed(
        {"date": "summary_date", "avg_congestion": "avg_congestion_index"}
    )
    # Summaries of earlier days stay: they are a history.
    today = F.col("summary_date") == cells.agg(F.max("date")).first()[0]
    daily = put(
        "gold_daily_summary", impact.latest_day(impact.with_estimates(daily, settings.economics)), today
    )

    baseline = replace("silver_baseline", anomaly.baseline_from_cells(cells))
    silver = tables.within(lake.stored("silver_traffic"), as_of, settings.trailing_days)
    # One pass over the readings; the ranking and the rate read its few anomalies.
    scored = anomaly.score_readings(silver, baseline, settings.zscore_limit)
    anomalies = stage(anomaly.anomalies_only(scored), "anomalies")
    replace("gold_anomalies", anomaly.top_anomalies(anomalies, settings.top_anomalies))
    rates = put("gold_anomaly_rate", anomaly.rate_from_cells(cells, anomalies))
    served = {
        "comparison": comparison, "hourly": hourly, "daily": daily.drop("computed_at"), "rates": rates
    }
    if with_models:
        roads = replace("gold_road_impact", impact.road_impact(silver))
        clustered = zones.cluster_roads(roads, seed=settings.seed)
        served["clusters"] = put("gold_road_clusters", clustered.frame)
        newest = latest.latest_readings(silver, sequence)
        tables.write_latest(newest.select(*schema_names("latest_roads", newest)), lake.path("latest_roads"))
        written.append("latest_roads")
        current = lake.stored("latest_roads")
        _run_forecast(lake, silver, cells, current, comparison, as_of, settings, written, served)
    _write_documents(lake, served)
    # Noted last: a cycle that fails before cleans and counts the same days again.
    state = spark.createDataFrame(
        [("silver", batch, as_of)], "task string, last_batch long, as_of string"
    )
    lake.keyed("cycle_state").put(state, version)
    for table in GOLD_KEYS:
        lake.keyed(table).fold()
    return written


def schema_names(table: str, rows: DataFrame) -> list[str]:
    """Columns of a stored table that ``rows`` has."""
    known = [f.split()[0] for f in schemas.GOLD[table].split(", ")]
    return [c for c in known if c in rows.columns]


def _run_forecast(
    lake: Lake, silver: DataFrame, cells: DataFrame, current: DataFrame, comparison: DataFrame,
    as_of: str, settings: ImpactSettings, written: list[str], served: dict[str, DataFrame],
) -> None:
    fitted = congestion_model.fit_classifier(silver, settings)
    if not fitted.held:
        return
    run_id = as_of.replace(" ", "T").replace(":", "")
    tables.append_history(fitted.frame, lake.path("gold_model_metrics"), run_id, as_of)
    means = impact.roll_up(cells, "city").select(
        "city", F.col("avg_speed").alias("mean_speed"), F.col("avg_free_flow").alias("free_flow_speed")
    )
    now = latest.city_snapshot(current).select("city", F.col("avg_congestion").alias("current_congestion"))
    change = impact.comparison_wide(comparison).select("city", "change_pct")
    predictions = congestion_model.forecast(
        fitted.model, means, as_of, now.join(change, "city", "left")
    )
    tables.append_history(predictions, lake.path("gold_predictions"), run_id, as_of)
    for table, name in (("gold_model_metrics", "metrics"), ("gold_predictions", "predictions")):
        served[name] = _one_run(lake, table, run_id)
        written.append(table)


def _one_run(lake: Lake, table: str, run_id: str) -> DataFrame:
    """The rows of one run of a history table."""
    rows = lake.spark.read.parquet(lake.path(table))
    return rows.where(F.col("run_id").cast("string") == run_id)


def _write_documents(lake: Lake, served: dict[str, DataFrame]) -> None:
    """Serving documents from the rows of this pass, one row per key.

    Whatever this pass did not produce (a city without readings, the results of models
    with too few) is not served, though tables of earlier passes may hold it.
    """
    read = tables.published_precision
    parts = [
        tables.comparison_documents(impact.comparison_wide(served["comparison"])),
        tables.hourly_documents(served["hourly"]),
        tables.row_documents(read(served["rates"]), "anomaly_rate", ["period"]),
        tables.row_documents(read(served["daily"]), "daily", ["city"]),
    ]
    if lake.has("price_policy"):
        parts.append(tables.row_documents(lake.read("price_policy"), "price_policy", ["fuel_type"]))
    optional = {
        "predictions": ("prediction", ["city", "horizon_minutes"]),
        "metrics": ("model_metrics", ["model_name", "metric_name"]),
        "clusters": ("cluster", ["city", "road_name"]),
    }
    for name, (prefix, key) in optional.items():
        if name in served:
            parts.append(tables.row_documents(read(served[name]), prefix, key))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    tables.replace_table(merged, lake.path("serving_documents"))
