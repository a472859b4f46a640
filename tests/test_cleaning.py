import math
import random
from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import bands, scores
from tidemark.operators import cleaning

READING = (
    "city STRING, road_name STRING, recorded_at STRING, congestion_index DOUBLE, "
    "current_speed DOUBLE, free_flow_speed DOUBLE, ingest_seq LONG"
)


def readings(spark, data):
    df = spark.createDataFrame(data, READING)
    return df.withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))


def test_level_bounds(spark):
    values = [0.0, 19.99, 20.0, 39.99, 40.0, 59.99, 60.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    out = df.select(
        bands.congestion_level("v").alias("l"),
        bands.level_label(bands.congestion_level("v")).alias("n"),
    ).collect()
    assert [r.l for r in out] == [0, 0, 1, 1, 2, 2, 3, 3]
    assert [r.n for r in out][::2] == ["Lancar", "Ramai Lancar", "Padat", "Macet"]


def test_price_and_severity_bounds(spark):
    prices = [9999.99, 10000.0, 13999.99, 14000.0, 15999.99, 16000.0]
    df = spark.createDataFrame([(v,) for v in prices], "v DOUBLE")
    got = [r[0] for r in df.select(bands.price_category("v")).collect()]
    assert got == ["subsidi", "ron90", "ron90", "ron95", "ron95", "premium"]
    marks = [40.0, 40.01, 60.0, 60.01, 80.0, 80.01]
    df = spark.createDataFrame([(v,) for v in marks], "v DOUBLE")
    got = [r[0] for r in df.select(bands.traffic_severity("v")).collect()]
    assert got == ["light", "moderate", "moderate", "heavy", "heavy", "critical"]


def test_validity_and_nan(spark):
    at = "2026-06-01 10:00:00"
    data = [
        ("a", f"r{i}", at, ci, speed, 60.0, i)
        for i, (ci, speed) in enumerate(
            [(0.0, 1.0), (100.0, 0.01), (100.01, 5.0), (-0.01, 5.0), (None, 5.0),
             (math.nan, 5.0), (50.0, 0.0), (50.0, None), (50.0, math.nan)]
        )
    ]
    clean = cleaning.silver_readings(cleaning.nan_to_null(readings(spark, data)))
    assert sorted(r.road_name for r in clean.collect()) == ["r0", "r1"]


def test_dedup_keeps_the_last_ingested_and_runs_before_validity(spark):
    at = "2026-06-01 10:00:00"
    data = [
        ("a", "valid_last", at, 500.0, 5.0, 60.0, 1), ("a", "valid_last", at, 50.0, 5.0, 60.0, 2),
        ("a", "invalid_last", at, 50.0, 5.0, 60.0, 1), ("a", "invalid_last", at, 500.0, 5.0, 60.0, 2),
    ]
    clean = cleaning.silver_readings(readings(spark, data))
    assert [r.road_name for r in clean.collect()] == ["valid_last"]
    once = cleaning.deduplicate_readings(readings(spark, data))
    assert rows(once, "road_name") == rows(cleaning.deduplicate_readings(once), "road_name")


def test_calendar_and_period(spark):
    data = [("a", "r", f"2026-06-{d:02d} 23:59:59", 1.0, 1.0, 1.0, d) for d in (6, 7, 8, 9, 10)]
    df = cleaning.tag_period(cleaning.add_calendar(readings(spark, data)), "2026-06-10")
    got = rows(df, "recorded_at")
    assert [g["day_of_week"] for g in got] == [7, 1, 2, 3, 4]
    assert [g["is_weekend"] for g in got] == [1, 1, 0, 0, 0]
    assert [g["period"] for g in got] == ["before"] * 4 + ["after"]
    assert {g["hour"] for g in got} == {23}


def test_congestion_from_speeds(spark):
    data = [("a", f"r{i}", "2026-06-01", 0.0, c, f, i)
            for i, (c, f) in enumerate([(30.0, 60.0), (60.0, 60.0), (70.0, 60.0), (5.0, 0.0), (5.0, None)])]
    got = rows(cleaning.derive_congestion(readings(spark, data)), "ingest_seq")
    assert [(g["derived_index"], g["derived_percent"]) for g in got] == [
        (50.0, 50.0), (5.0, 0.0), (5.0, -16.67)
    ]


def test_defaults(spark):
    df = spark.createDataFrame(
        [("a", None, None, datetime(2026, 6, 1, 5)), ("b", "x", 2.0, datetime(2026, 6, 2, 5))],
        "city STRING, source STRING, rain_1h DOUBLE, recorded_at TIMESTAMP",
    )
    got = rows(cleaning.with_defaults(df, source="openweathermap", rain_1h=0.0), "city")
    assert [(g["source"], g["rain_1h"], g["ingested_via"]) for g in got] == [
        ("openweathermap", 0.0, "kafka"), ("x", 2.0, "kafka")
    ]
    assert str(got[1]["date"]) == "2026-06-02"


def test_history_falls_back_to_bronze(spark):
    bronze = readings(spark, [("a", "r", "2026-06-01", 45.0, 5.0, 60.0, 1)]).withColumn(
        "period", F.lit("before")
    )
    silver = cleaning.silver_readings(bronze)
    from_bronze = rows(cleaning.history_rows(None, bronze))
    assert from_bronze == rows(cleaning.history_rows(silver, bronze.where("false")))
    assert from_bronze == rows(cleaning.history_rows(silver.where("false"), bronze))
    assert from_bronze[0]["congestion_level"] == 2


def test_weather_score(spark):
    data = [("Clear", 0.0, 100.0), ("Rain", 1.0, 35.0), ("Rain", 50.0, 10.0),
            ("Thunderstorm", 50.0, 0.0), ("Snow", 0.0, 70.0), ("Fog", 0.01, 50.0 - 0.1)]
    df = spark.createDataFrame(data, "c STRING, rain DOUBLE, want DOUBLE")
    got = df.select(scores.weather_score(F.col("c"), F.col("rain")).alias("s"), "want").collect()
    # 49.95 rounds half up to 50.0
    assert [r.s for r in got][:-1] == [r.want for r in got][:-1] and got[-1].s == 50.0


def test_half_up(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (-0.125,), (1e9 + 0.005,), (None,)], "v DOUBLE")
    got = [r[0] for r in df.select(scores.half_up(F.col("v"), 2)).collect()]
    assert got == [0.13, 2.68, -0.13, 1000000000.01, None]


def test_half_up_equals_decimal_rounding(spark):
    rng = random.Random(7)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 8) for _ in range(3000)]
    values += [k / 2 / 10**d for d in range(7) for k in range(-21, 22)]
    values += [v + rng.choice((-1, 1)) * 1e-13 for v in values[-200:]]
    values += [0.0, -0.0, -1e-12, 1e12 + 0.5, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    for digits in (1, 2, 4, 6):
        exact = F.round(F.col("v").try_cast("decimal(28,10)"), digits).cast("double")
        got = df.select(scores.half_up(F.col("v"), digits).alias("a"), exact.alias("b")).collect()
        assert [repr(r.a) for r in got] == [repr(r.b) for r in got]


def test_minmax_null_policy(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (50.0,), (500.0,)], "v DOUBLE")
    seen = [r[0] for r in df.select(scores.minmax(F.col("v"), 0, 100)).collect()]
    kept = [r[0] for r in df.select(scores.minmax(F.col("v"), 0, 100, "propagate")).collect()]
    assert seen == [1.0, 0.0, 0.5, 1.0] and kept == [None, 0.0, 0.5, 1.0]
