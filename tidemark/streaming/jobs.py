"""Streaming queries: windowed aggregates, bronze ingest, live state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions import scores
from tidemark.operators import cleaning, windows
from tidemark.session import rocksdb_state, shuffle_width
from tidemark.sources.tables import BRONZE_PARTITIONS, KeyedTable, table_exists, write_partitioned
from tidemark.streaming import freshness
from tidemark.streaming.events import parse_events


# The state's code travels by value: the processes that run it need not have this package.
cloudpickle.register_pickle_by_value(freshness)


def _paced(writer, trigger: str | None):
    """A processing-time trigger, or one drain of what is there when None."""
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def write_keyed(
    rows: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    trigger: str | None = "30 seconds",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep ``table`` at the newest row per key of an update-mode stream.

    The batch id is the version, so a batch that runs again after a failure
    replaces its own rows.  An empty batch writes nothing; it is not counted
    first, which would run the batch twice.  Older versions are folded as they
    gather, so readers meet a bounded number of them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.put(batch, batch_id)
        table.fold()

    writer = (
        rows.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    with shuffle_width(rows.sparkSession, state_partitions):
        return _paced(writer, trigger).start()


def write_console(
    rows: DataFrame, output_mode: str = "update", trigger: str | None = "30 seconds"
) -> StreamingQuery:
    writer = rows.writeStream.outputMode(output_mode).format("console").option("truncate", False)
    return _paced(writer, trigger).start()


@dataclass(frozen=True)
class WindowJob:
    """One of the four windowed streams."""

    topic: str
    schema: str
    aggregate: object
    keys: Sequence[str]
    table: str
    kind: str

    def keyed(self, spark: SparkSession, lake: str, per: str = "day") -> KeyedTable:
        """The job's table, in days (or ``per`` another unit) of its windows."""

        def schema():
            nothing = spark.createDataFrame([], "topic string, value string, broker_ts timestamp")
            return self.aggregate(parse_events(nothing, self.schema)).schema

        return KeyedTable(spark, f"{lake}/{self.table}", self.keys, "window_start", schema, per)


# Topics and tables of the four streams.
WINDOW_JOBS = (
    WindowJob("fuel-price-stream", schemas.FUEL_EVENT, windows.fuel_windows,
              windows.FUEL_KEYS, "fuel_price_agg", "fuel"),
    WindowJob("traffic-stream", schemas.TRAFFIC_EVENT, windows.traffic_windows,
              windows.TRAFFIC_KEYS, "traffic_agg", "traffic"),
    WindowJob("weather-stream", schemas.WEATHER_EVENT, windows.weather_windows,
              windows.CITY_KEYS, "weather_agg", "weather"),
    WindowJob("transport-stream", schemas.TRANSPORT_EVENT, windows.transport_windows,
              windows.CITY_KEYS, "transport_agg", "transport"),
)


def start_windows(
    sources: Mapping[str, DataFrame],
    lake: str,
    checkpoints: str,
    width: str = "5 minutes",
    delay: str = "2 minutes",
    trigger: str | None = "30 seconds",
    state_partitions: int | None = None,
) -> dict[str, StreamingQuery]:
    """Start the window jobs whose topic is in ``sources``, one query and checkpoint each.

    Invalid events are counted as they pass (see :func:`log_progress`).
    """
    running = {}
    for job in WINDOW_JOBS:
        if job.topic not in sources:
            continue
        raw = sources[job.topic]
        events = counted(parse_events(raw, job.schema, delay), windows.stream_rules()[job.kind])
        running[job.table] = write_keyed(
            job.aggregate(events, width), job.keyed(raw.sparkSession, lake),
            f"{checkpoints}/{job.table}", trigger, state_partitions,
        )
    return running


def run_until_any_stops(
    spark: SparkSession, running: Mapping[str, StreamingQuery], log: str | None = None,
    every: float = 60.0,
) -> None:
    """Block until one query ends (or fails), then stop the others.

    With a folder ``log`` the progress of all of them is stored every so many seconds.
    """

    def note() -> None:
        for name, job in running.items():
            if log is not None:
                log_progress(job, name, progress_log(spark, log, name))

    try:
        if log is None:
            spark.streams.awaitAnyTermination()
        while log is not None and not spark.streams.awaitAnyTermination(every):
            note()
    finally:
        for job in running.values():
            job.stop()
        note()


# --- what a stream leaves out --------------------------------------------------

_OBSERVED = "events"
PROGRESS_SCHEMA = (
    "stream string, batch bigint, events bigint, invalid bigint, no_time bigint, late bigint, watermark string"
)


def counted(events: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Parsed events, unchanged, that count themselves while they pass: all of them, those that
    break a rule (a null counts as a break) and those without a readable time."""
    sound = reduce(lambda a, b: a & b, [F.coalesce(r, F.lit(False)) for r in rules.values()])
    return events.observe(
        _OBSERVED,
        F.count(F.lit(1)).alias("events"),
        F.count_if(~sound).alias("invalid"),
        F.count_if(F.col("event_time").isNull()).alias("no_time"),
    )


def progress_log(spark: SparkSession, path: str, name: str) -> KeyedTable:
    """Where the progress of one stream is kept."""
    return KeyedTable(spark, f"{path}/{name}", ("batch",), schema=PROGRESS_SCHEMA)


def log_progress(query: StreamingQuery, name: str, log: KeyedTable) -> None:
    """Store what the batches that a query still remembers took in and left out.

    ``late`` counts the rows that the state refused as older than the watermark, after
    they were combined per key and task.  Storing a batch again changes nothing.
    """
    rows, stored = [], log.newest_version()
    for p in query.recentProgress:
        seen = p.observedMetrics.get(_OBSERVED)
        if seen is None or not p.numInputRows or p.batchId <= stored:
            continue
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        mark = (p.eventTime or {}).get("watermark")
        rows.append((name, p.batchId, seen["events"], seen["invalid"], seen["no_time"], late, mark))
    if rows:
        spark = log.spark
        log.put(spark.createDataFrame(rows, PROGRESS_SCHEMA), max(r[1] for r in rows))
        log.fold()


def join_windows(
    fuel: DataFrame, traffic: DataFrame, weather: DataFrame, transport: DataFrame,
    width: str = "5 minutes",
) -> DataFrame:
    """The four event streams joined per (city, window), for append mode.

    Each side is aggregated to one row per key first; a window appears once the
    watermark has passed it, with nulls for streams that had nothing.
    """

    def per_window(events: DataFrame, *aggregates) -> DataFrame:
        return events.groupBy(F.window("event_time", width).alias("w"), "city").agg(*aggregates)

    sides = (
        per_window(windows.valid_traffic(traffic), F.avg("congestion_level").alias("avg_congestion"),
                   F.avg("avg_speed").alias("avg_speed")),
        per_window(windows.valid_weather(weather), F.avg("weather_score").alias("avg_weather_score")),
        per_window(windows.valid_transport(transport), F.sum("ridership").alias("total_ridership")),
    )
    joined = per_window(windows.valid_fuel(fuel), F.avg("price").alias("avg_price"))
    for side in sides:
        joined = joined.join(side, ["w", "city"], "left_outer")
    return joined.select(F.col("w.start").alias("window_start"), "city", *[
        c for c in joined.columns if c not in ("w", "city")
    ])


# --- bronze ------------------------------------------------------------------


def parse_readings(raw: DataFrame, schema: str, **defaults) -> DataFrame:
    """Readings with their ingest defaults; rows without city or time are dropped."""
    rows = raw.select(
        F.from_json("value", schema).alias("r"), F.col("broker_ts").alias("ingested_at")
    ).select("r.*", "ingested_at")
    rows = rows.withColumn("recorded_at", F.try_to_timestamp("recorded_at"))
    rows = cleaning.nan_to_null(rows.where("city IS NOT NULL AND recorded_at IS NOT NULL"))
    return cleaning.with_defaults(rows, **defaults)


def append_bronze(
    readings: DataFrame, path: str, checkpoint: str, trigger: str | None = "30 seconds"
) -> StreamingQuery:
    """Append readings to the ``city=/date=`` table, each message exactly once."""
    writer = (
        readings.writeStream.format("parquet")
        .partitionBy("city", "date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _paced(writer, trigger).start()


# Raw topics, by bronze table, and their ingest defaults.
BRONZE_TOPICS = {
    "bronze_traffic": ("traffic.raw", schemas.ROAD_READING, {"source": "tomtom"}),
    "bronze_weather": (
        "weather.raw", schemas.WEATHER_READING, {"source": "openweathermap", "rain_1h": 0.0}
    ),
}


def rejected_messages(raw: DataFrame) -> DataFrame:
    """Messages that no bronze table can take, as they came, with the reason."""
    known = raw.withColumn("_at", F.try_to_timestamp(F.get_json_object("value", "$.recorded_at")))
    reason = (
        F.when(~F.col("topic").isin(*(t for t, _, _ in BRONZE_TOPICS.values())), "unknown_topic")
        .when(F.get_json_object("value", "$").isNull(), "unreadable")
        .when(F.get_json_object("value", "$.city").isNull(), "no_city")
        .when(F.col("_at").isNull(), "no_time")
    )
    marked = known.withColumn("reason", reason).where(F.col("reason").isNotNull())
    return marked.select(F.coalesce("topic", F.lit("")).alias("topic"), "value", "broker_ts", "reason")


def split_topics(
    raw: DataFrame, lake: str, checkpoint: str, trigger: str | None = "30 seconds"
) -> StreamingQuery:
    """One subscription, one bronze table per topic.

    A batch is kept while the tables are written, and each row carries its batch
    as the last partition, so a repeated batch replaces its own files.  Messages
    that fit neither table go to ``bronze_rejects`` with the reason.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for table, (topic, schema, defaults) in BRONZE_TOPICS.items():
                rows = parse_readings(batch.where(F.col("topic") == topic), schema, **defaults)
                write_partitioned(
                    rows.withColumn("ingest_batch", F.lit(batch_id)), f"{lake}/{table}",
                    by=BRONZE_PARTITIONS,
                )
            write_partitioned(
                rejected_messages(batch).withColumn("ingest_batch", F.lit(batch_id)),
                f"{lake}/bronze_rejects", by=("topic", "ingest_batch"),
            )
        finally:
            batch.unpersist()

    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _paced(writer, trigger).start()


def bronze_rows(spark: SparkSession, lake: str, table: str) -> DataFrame:
    """A table that :func:`split_topics` writes, ``bronze_rejects`` included; empty before its
    first message."""
    path = f"{lake}/{table}"
    if table_exists(spark, path):
        return spark.read.parquet(path)
    nothing = spark.createDataFrame([], "topic string, value string, broker_ts timestamp")
    if table in BRONZE_TOPICS:
        _, schema, defaults = BRONZE_TOPICS[table]
        made = parse_readings(nothing, schema, **defaults)
    else:
        made = rejected_messages(nothing)
    return made.withColumn("ingest_batch", F.lit(0))


def distinct_readings(readings: DataFrame, delay: str = "2 minutes") -> DataFrame:
    """Drop repeated readings of a road and time while the watermark allows it."""
    return readings.withWatermark("recorded_at", delay).dropDuplicatesWithinWatermark(
        list(cleaning.READING_KEY)
    )


ROADS_SCHEMA = (
    "city string, road_name string, recorded_at timestamp, congestion_index double, current_speed double, "
    "period string"
)


# --- live state --------------------------------------------------------------


def latest_road_stream(readings: DataFrame) -> DataFrame:
    """Latest state per road in update mode; the state holds one row per road."""
    # Ordered by time, then by the values: readings at one time have a defined winner.
    state = F.struct("recorded_at", "congestion_index", "current_speed", "period")
    return readings.groupBy("city", "road_name").agg(F.max(state).alias("s")).select("city", "road_name", "s.*")


def fresh_values(
    values: DataFrame, ttl: Mapping[str, int], delay: str | None = None
) -> DataFrame:
    """The latest value per (kind, city) of a stream while it outlives its kind's lifetime.

    ``values`` are (kind, city, ts, value).  Update mode: a row with ``fresh`` for a new
    latest value, one without when it has run out, so a keyed table that takes the latter
    as gone (:func:`write_fresh`) holds what ``latest.fresh_latest`` finds at the newest
    time seen.  State is one row a key, and a timer clears it; kinds without a lifetime
    are left out.  The watermark stays behind by the longest lifetime, since a value may
    come that late and still be fresh.
    """
    longest = max(ttl.values())
    known = values.where(F.col("kind").isin(*ttl)).select("kind", "city", "ts", "value")
    return (
        known.withWatermark("ts", delay or f"{longest} seconds")
        .groupBy("kind", "city")
        .transformWithStateInPandas(
            freshness.Freshness({k: s - longest for k, s in ttl.items()}),
            "kind string, city string, ts timestamp, value double, fresh boolean", "Update", "EventTime",
        )
    )


def write_fresh(
    rows: DataFrame, table: KeyedTable, checkpoint: str, trigger: str | None = "30 seconds",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep ``table`` (by kind and city) at the fresh values of :func:`fresh_values`.

    Their state lies in RocksDB, also in a session whose other streams have another store.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        last = cleaning.keep_latest(batch, table.keys, [F.col("ts").desc(), F.col("fresh")]).persist()
        try:
            table.put(last.where("fresh").drop("fresh"), batch_id, last.where("NOT fresh"))
        finally:
            last.unpersist()
        table.fold()

    writer = (
        rows.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    with shuffle_width(rows.sparkSession, state_partitions), rocksdb_state(rows.sparkSession):
        return _paced(writer, trigger).start()


def live_feed(roads: DataFrame) -> DataFrame:
    """City feed from the latest road states."""
    return roads.groupBy("city").agg(
        scores.mobility_score(F.avg("congestion_index")).alias("mobility_score"),
        scores.half_up(F.avg("congestion_index"), 2).alias("congestion_level"),
        scores.half_up(F.avg("current_speed"), 2).alias("avg_speed"),
        F.max_by("period", F.struct("recorded_at", "road_name")).alias("period"),
        F.max("recorded_at").alias("updated_at"),
    )
