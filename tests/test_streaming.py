import json
from datetime import datetime, timedelta
from pathlib import Path

from conftest import SMALL, rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import windows
from tidemark.plans import catalog
from tidemark.sources import samples
from tidemark.sources.samples import SampleTables
from tidemark.sources.tables import KeyedTable
from tidemark.streaming import jobs
from tidemark.streaming.events import json_folder, parse_events

T0 = datetime(2026, 6, 1, 12, 0, 0)


def send(folder: str, name: str, *messages) -> None:
    Path(folder).mkdir(parents=True, exist_ok=True)
    lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    Path(folder, name).write_text("\n".join(lines) + "\n")


def fuel(minutes: float, price=9000.0, city="a", **extra):
    at = (T0 + timedelta(minutes=minutes)).isoformat()
    return {"timestamp": at, "city": city, "fuel_type": "F", "price": price, **extra}


def drain(spark, folder, lake, **options):
    raw = json_folder(spark, folder, "fuel-price-stream", options.pop("max_files", None))
    running = jobs.start_windows(
        {"fuel-price-stream": raw}, lake, f"{lake}/cp", trigger=None, state_partitions=2, **options
    )
    running["fuel_price_agg"].awaitTermination()
    jobs.log_progress(running["fuel_price_agg"], "fuel", jobs.progress_log(spark, f"{lake}/progress", "fuel"))
    return rows(jobs.WINDOW_JOBS[0].keyed(spark, lake).read(), "window_start")


def test_bad_messages_and_time_formats(spark, lake):
    send(
        f"{lake}/in", "1.json",
        fuel(0), "{broken", fuel(0, price=0.0), fuel(0, price=-1.0), fuel(0, city=None),
        fuel(0, price="no number"), {"city": "a"}, fuel(0, extra_field=1),
        {**fuel(0), "timestamp": "2026-06-01T12:00:00Z"},
        {**fuel(0), "timestamp": "2026-06-01T19:00:00+07:00"},
        {**fuel(0), "timestamp": "yesterday"},
    )
    got = drain(spark, f"{lake}/in", f"{lake}/lake")
    assert [(g["window_start"], g["sample_count"]) for g in got] == [(T0, 4)]
    log = rows(jobs.progress_log(spark, f"{lake}/lake/progress", "fuel").read())
    # Cut off, no price (three times), no city, a city alone: those break a rule.
    assert [(g["events"], g["invalid"], g["no_time"], g["late"]) for g in log] == [(11, 6, 3, 0)]


def test_late_rows_and_open_windows(spark, lake):
    folder, out = f"{lake}/in", f"{lake}/lake"
    send(folder, "1.json", fuel(0), fuel(11))
    assert [g["sample_count"] for g in drain(spark, folder, out)] == [1, 1]
    # Watermark 12:09: the 12:00 window is closed, the 12:05 and 12:10 ones are open.
    send(folder, "2.json", fuel(1), fuel(8), fuel(10.5))
    got = drain(spark, folder, out)
    assert [(g["window_start"].minute, g["sample_count"]) for g in got] == [(0, 1), (5, 1), (10, 2)]


def test_late_rows_are_counted(spark, lake):
    """Five late rows of five windows and cities, one by one as the state refuses them."""
    folder, out = f"{lake}/in", f"{lake}/lake"
    send(folder, "1.json", fuel(0), fuel(60))
    drain(spark, folder, out)
    late = [fuel(1, city="x"), fuel(6, city="x"), fuel(11, city="y"), fuel(16, city="z"), fuel(21, city="z")]
    send(folder, "2.json", *late, fuel(61), fuel(62, price=-5.0))
    drain(spark, folder, out)
    drain(spark, folder, out)  # nothing new: nothing is logged twice
    log = rows(jobs.progress_log(spark, f"{out}/progress", "fuel").read(), "batch")
    assert sum(g["late"] for g in log) == 5 and sum(g["events"] for g in log) == 9
    assert sum(g["invalid"] for g in log) == 1


def test_fresh_values_by_state(spark, lake):
    """After every part of the stream the table holds what the batch filter finds."""
    from tidemark.operators import latest

    ttl = {"fuel": 30, "alert": 300, "cluster": 3600}
    table = KeyedTable(
        spark, f"{lake}/fresh", ("kind", "city"), schema="kind string, city string, ts timestamp, value double"
    )
    schema = "kind string, city string, ts timestamp, value double"
    parts = [
        [("fuel", "a", 0, 1.0), ("fuel", "b", 5, 2.0), ("alert", "a", 0, 3.0), ("other", "a", 0, 9.0)],
        [("fuel", "a", 40, 4.0), ("fuel", "a", 20, 5.0), ("alert", "b", 100, 6.0), ("fuel", None, 100, 1.0)],
        [("cluster", "a", 900, 7.0), ("cluster", "a", 900, 8.0), ("alert", "c", 700, 1.0)],
        [("fuel", "a", 1000, 1.5), ("alert", "d", 650, 2.5)],
        [("cluster", "b", 9000, 1.0)],
    ]
    so_far = []
    for number, part in enumerate(parts):
        data = [(k, c, T0 + timedelta(seconds=s), v) for k, c, s, v in part]
        so_far += data
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{lake}/in")
        values = spark.readStream.schema(schema).parquet(f"{lake}/in")
        jobs.write_fresh(
            jobs.fresh_values(values, ttl), table, f"{lake}/cp", trigger=None, state_partitions=2
        ).awaitTermination()
        now = max(r[2] for r in so_far)
        expected = latest.fresh_latest(spark.createDataFrame(so_far, schema), str(now), ttl)
        assert rows(table.read(), "kind", "city") == rows(expected, "kind", "city"), number


def test_fresh_values_whatever_state_store_the_session_has(spark, lake):
    """A driver's own session has Spark's default store, which takes no timers; its setting stays."""
    plain = spark.newSession()
    store = "spark.sql.streaming.stateStore.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    plain.conf.set(store, default)
    schema = "kind string, city string, ts timestamp, value double"
    table = KeyedTable(plain, f"{lake}/fresh", ("kind", "city"), schema=schema)
    for part in ([("fuel", "a", 0, 1.0), ("fuel", "b", 5, 2.0)], [("fuel", "a", 32, 3.0)]):
        data = [(k, c, T0 + timedelta(seconds=s), v) for k, c, s, v in part]
        plain.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{lake}/in")
        values = plain.readStream.schema(schema).parquet(f"{lake}/in")
        jobs.write_fresh(
            jobs.fresh_values(values, {"fuel": 30}), table, f"{lake}/cp", trigger=None, state_partitions=2
        ).awaitTermination()
    # The second part finds the state of the first; b lives for three seconds more.
    assert [(g["city"], g["value"]) for g in rows(table.read(), "city")] == [("a", 3.0), ("b", 2.0)]
    assert plain.conf.get(store) == default


def test_restart_continues_from_the_checkpoint(spark, lake):
    folder, out = f"{lake}/in", f"{lake}/lake"
    send(folder, "1.json", fuel(0, 9000.0))
    drain(spark, folder, out)
    send(folder, "2.json", fuel(1, 9500.0))
    got = drain(spark, folder, out)
    assert [(g["sample_count"], g["avg_price"], g["max_price"]) for g in got] == [(2, 9250.0, 9500.0)]
    assert drain(spark, folder, out) == got


def test_stream_equals_batch(spark):
    t = SampleTables(spark, SMALL)
    for job, kind in zip(jobs.WINDOW_JOBS, ("fuel", "traffic", "weather", "transport")):
        messages = samples.event_messages(t.events, kind)
        batch = job.aggregate(parse_events(messages, job.schema))
        stream = catalog.drain_windows(t, kind, job.table)
        # Means are added up in another order.
        exact = [F.round(c, 9).alias(c) if k == "double" else F.col(c) for c, k in sorted(batch.dtypes)]
        assert rows(batch.select(exact), *job.keys) == rows(stream.select(exact), *job.keys)


def reading(road, minutes, ci, speed=30.0, **extra):
    at = (T0 + timedelta(minutes=minutes)).isoformat()
    return {"city": "a", "road_name": road, "current_speed": speed, "free_flow_speed": 60.0,
            "congestion_index": ci, "period": "before", "recorded_at": at, **extra}


def test_demultiplexed_bronze(spark, lake):
    send(f"{lake}/traffic", "1.json", reading("r1", 0, 10.0), reading("r2", 1440, 20.0, source="x"),
         reading("r3", 0, 30.0, recorded_at="bad"))
    send(f"{lake}/weather", "1.json",
         {"city": "a", "temp": 30.0, "humidity": 80, "weather_desc": "clear",
          "recorded_at": T0.isoformat()})
    raw = json_folder(spark, f"{lake}/traffic", "traffic.raw").unionByName(
        json_folder(spark, f"{lake}/weather", "weather.raw")
    )
    for _ in range(2):
        jobs.split_topics(raw, f"{lake}/bronze", f"{lake}/cp", trigger=None).awaitTermination()
    traffic = rows(spark.read.parquet(f"{lake}/bronze/bronze_traffic"), "road_name")
    assert [(g["road_name"], g["source"], g["ingested_via"], str(g["date"])) for g in traffic] == [
        ("r1", "tomtom", "kafka", "2026-06-01"), ("r2", "x", "kafka", "2026-06-02")
    ]
    weather = rows(spark.read.parquet(f"{lake}/bronze/bronze_weather"))
    assert [(g["source"], g["rain_1h"]) for g in weather] == [("openweathermap", 0.0)]


def test_bronze_append_is_exactly_once_across_restarts(spark, lake):
    def ingest():
        raw = json_folder(spark, f"{lake}/in", "traffic.raw")
        stream = jobs.parse_readings(raw, schemas.ROAD_READING)
        jobs.append_bronze(stream, f"{lake}/b", f"{lake}/cp", trigger=None).awaitTermination()
        return spark.read.parquet(f"{lake}/b").count()

    send(f"{lake}/in", "1.json", reading("r1", 0, 10.0))
    assert ingest() == 1 == ingest()
    send(f"{lake}/in", "2.json", reading("r2", 0, 10.0), reading("r3", 0, 10.0))
    assert ingest() == 3
    assert Path(lake, "b", "city=a", "date=2026-06-01").is_dir()


def test_duplicates_within_the_watermark(spark, lake):
    send(f"{lake}/in", "1.json", reading("r1", 0, 10.0), reading("r1", 0, 10.0), reading("r1", 1, 10.0))
    raw = json_folder(spark, f"{lake}/in", "traffic.raw")
    stream = jobs.distinct_readings(jobs.parse_readings(raw, schemas.ROAD_READING))
    with jobs.shuffle_width(spark, 2):
        jobs.append_bronze(stream, f"{lake}/b", f"{lake}/cp", trigger=None).awaitTermination()
    assert spark.read.parquet(f"{lake}/b").count() == 2


def test_live_feed(spark, lake):
    send(f"{lake}/in", "1.json", reading("r1", 0, 10.0), reading("r1", 5, 30.0), reading("r2", 1, 50.0))
    raw = json_folder(spark, f"{lake}/in", "traffic.raw")
    stream = jobs.latest_road_stream(jobs.parse_readings(raw, schemas.ROAD_READING))
    table = KeyedTable(spark, f"{lake}/roads", ("city", "road_name"))
    jobs.write_keyed(stream, table, f"{lake}/cp", trigger=None, state_partitions=2).awaitTermination()
    feed = rows(jobs.live_feed(table.read()))[0]
    assert (feed["mobility_score"], feed["congestion_level"], feed["avg_speed"]) == (0.6, 40.0, 30.0)
    assert feed["period"] == "before"


def test_console_and_any_termination(spark, lake, capfd):
    send(f"{lake}/in", "1.json", fuel(0))
    raw = json_folder(spark, f"{lake}/in", "fuel-price-stream")
    counted = windows.fuel_windows(parse_events(raw, schemas.FUEL_EVENT))
    with jobs.shuffle_width(spark, 2):
        shown = jobs.write_console(counted, trigger=None)
    jobs.run_until_any_stops(spark, {"shown": shown})
    assert not shown.isActive and shown.exception() is None
    spark.streams.resetTerminated()


def test_mode_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("a", T0, w, 50.0, 1.0, 1.0, 0.0) for w in ("Rain", "Clear", "Rain", "Clear")],
        "city STRING, event_time TIMESTAMP, weather_main STRING, weather_score DOUBLE, "
        "temperature DOUBLE, humidity DOUBLE, rain_1h DOUBLE",
    )
    assert rows(windows.weather_windows(df))[0]["dominant_weather"] == "Clear"


def test_window_extras(spark):
    weather = spark.createDataFrame(
        [("a", T0, w, 50.0, 1.0, 1.0, 0.0) for w in ("Rain", "Clear", "Rain")],
        "city STRING, event_time TIMESTAMP, weather_main STRING, weather_score DOUBLE, "
        "temperature DOUBLE, humidity DOUBLE, rain_1h DOUBLE",
    )
    got = rows(windows.weather_windows(weather, extras=True))[0]
    assert (got["first_weather"], got["dominant_weather"]) == ("Clear", "Rain")
    transport = spark.createDataFrame(
        [("a", T0, m, 5, 10.0) for m in ("bus", "bus", "train")],
        "city STRING, event_time TIMESTAMP, transport_mode STRING, ridership INT, load_factor_pct DOUBLE",
    )
    got = rows(windows.with_estimates(windows.transport_windows(transport, extras=True)))[0]
    assert (got["active_modes"], got["distinct_modes"]) == (3, 2)
    traffic = spark.createDataFrame(
        [("a", T0, r, 10.0, 30.0, 90.0) for r in ("r1", "r2", "r1")],
        "city STRING, event_time TIMESTAMP, road_id STRING, congestion_level DOUBLE, avg_speed DOUBLE, "
        "mobility_index DOUBLE",
    )
    got = rows(windows.with_estimates(windows.traffic_windows(traffic, extras=True)))[0]
    assert (got["roads_monitored"], got["distinct_roads"]) == (3, 2)
    # Severities of one window share roads; the union counts them once.
    shared = traffic.unionByName(traffic.withColumn("congestion_level", F.lit(90.0)))
    merged = windows.with_estimates(windows.merge_traffic(windows.traffic_windows(shared, extras=True)))
    assert [(g["roads_monitored"], g["distinct_roads"]) for g in rows(merged)] == [(6, 2)]
    means = rows(windows.traffic_means(traffic))[0]
    assert (means["roads_monitored"], means["avg_congestion"]) == (3, 10.0)


def test_rejected_messages(spark):
    raw = spark.createDataFrame(
        [("traffic.raw", '{"city":"a","recorded_at":"2026-06-01 08:00:00"}'), ("traffic.raw", '{"city":'),
         ("traffic.raw", '{"recorded_at":"2026-06-01 08:00:00"}'), ("weather.raw", '{"city":"a"}'),
         ("x", "{}"), ("traffic.raw", None)],
        "topic STRING, value STRING",
    ).withColumn("broker_ts", F.lit(T0))
    got = sorted((r["topic"], r["reason"]) for r in rows(jobs.rejected_messages(raw)))
    assert got == [
        ("traffic.raw", "no_city"), ("traffic.raw", "unreadable"), ("traffic.raw", "unreadable"),
        ("weather.raw", "no_time"), ("x", "unknown_topic"),
    ]


def test_weighted_merge(spark):
    df = spark.createDataFrame(
        [(T0, "a", "light", 10.0, 50.0, None, 3), (T0, "a", "heavy", 70.0, 10.0, 30.0, 1)],
        "window_start TIMESTAMP, city STRING, traffic_severity STRING, avg_congestion DOUBLE, "
        "avg_speed DOUBLE, avg_mobility_index DOUBLE, roads_monitored LONG",
    )
    got = rows(windows.merge_traffic(df))[0]
    assert (got["avg_congestion"], got["avg_speed"], got["avg_mobility_index"]) == (25.0, 40.0, 30.0)
    assert got["roads_monitored"] == 4


def test_rejects(spark):
    df = spark.createDataFrame([(1.0, "a"), (0.0, None), (None, "a")], "price DOUBLE, city STRING")
    got = {g["rule"]: (g["rejected"], g["total"]) for g in rows(
        windows.rejected_counts(df, "fuel", windows.stream_rules()["fuel"]))}
    assert got == {"price_positive": (2, 3), "city_present": (1, 3)}


def test_kafka_reader_is_refused_without_its_package(spark):
    """The reader is plain options; without the connector Spark names what is missing."""
    import pytest
    from pyspark.errors import AnalysisException

    from tidemark.streaming.events import subscribe

    with pytest.raises(AnalysisException, match="(?i)kafka"):
        subscribe(spark, ["fuel-price-stream"], "localhost:9092")
