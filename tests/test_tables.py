import json
from datetime import datetime

from conftest import plan, rows
from pyspark.sql import functions as F

from tidemark.operators import anomaly, cleaning, impact
from tidemark.plans import catalog
from tidemark.session import stage
from tidemark.sources import samples, tables
from tidemark.sources.samples import SampleTables
from tidemark.sources.tables import KeyedTable

SMALL = "/root/testdata/sf0.001"


def frame(spark, *data):
    return spark.createDataFrame(list(data), "city STRING, period STRING, v INT")


def test_upsert_twice_is_once(spark):
    target = frame(spark, ("a", "before", 1), ("a", "after", 2), ("b", "before", 3))
    updates = frame(spark, ("a", "after", 20), ("c", "before", 30))
    once = tables.upsert(target, updates, ["city", "period"])
    twice = tables.upsert(once, updates, ["city", "period"])
    got = {(g["city"], g["period"]): g["v"] for g in rows(once)}
    assert got == {("a", "before"): 1, ("a", "after"): 20, ("b", "before"): 3, ("c", "before"): 30}
    assert rows(once, "city", "period") == rows(twice, "city", "period")


def test_keyed_table_versions(spark, lake):
    table = KeyedTable(spark, f"{lake}/t", ["city", "period"])
    assert not table.exists()
    table.put(frame(spark, ("a", "before", 1), ("b", "before", 2)), 1)
    table.put(frame(spark, ("a", "before", 10)), 2)
    table.put(frame(spark, ("a", "before", 11)), 2)  # the same version again
    expected = [{"city": "a", "period": "before", "v": 11}, {"city": "b", "period": "before", "v": 2}]
    assert table.exists() and rows(table.read(), "city") == expected
    table.fold(most=1)
    assert rows(table.read(), "city") == expected


def test_versions_stay_bounded(spark, lake):
    """Fifty batches leave few versions, and the last one can still run again."""
    table = KeyedTable(spark, f"{lake}/t", ["city", "period"])
    for batch in range(50):
        table.put(frame(spark, (f"c{batch % 7}", "before", batch), ("x", "after", batch)), batch)
        table.fold(most=5)
    table.put(frame(spark, ("x", "after", 1000)), 49)
    table.fold(most=5)
    # Three levels at most, and what the last fold has merged.
    assert len(table._levels(table.path)) <= 18 and table.newest_version() == 49
    got = {g["city"]: g["v"] for g in rows(table.read())}
    assert got == {f"c{k}": max(b for b in range(49) if b % 7 == k) for k in range(7)} | {"x": 1000}


def test_keys_can_go(spark, lake):
    table = KeyedTable(spark, f"{lake}/t", ["city", "period"], schema="city string, period string, v int")
    assert rows(table.read()) == [] and table.newest_version() == -1
    table.put(frame(spark, ("a", "before", 1), ("b", "before", 2), (None, "before", 3)), 1)
    gone = frame(spark, ("a", "before", 0), (None, "before", 0))
    table.put(frame(spark, ("c", "before", 4)), 2, gone=gone)
    assert sorted(g["city"] for g in rows(table.read())) == ["b", "c"]
    table.put(frame(spark, ("a", "before", 5)), 3)
    for most in (1, 1, 0):
        table.fold(most=most)
        assert {g["city"]: g["v"] for g in rows(table.read())} == {"a": 5, "b": 2, "c": 4}


def _windows(spark, minutes, value):
    start = F.timestamp_seconds(F.lit(1780272000) + F.lit(60) * F.col("m"))
    return spark.createDataFrame([(m,) for m in minutes], "m long").select(
        F.concat(F.lit("c"), (F.col("m") % 3).cast("string")).alias("city"), start.alias("window_start"),
        F.lit(value).alias("v"),
    )


def test_bytes_written_grow_with_the_rows_put(spark, lake):
    """Sixty batches over six days: a row is rewritten a few times, whatever the table holds."""
    from pathlib import Path

    table = KeyedTable(spark, f"{lake}/t", ["city", "window_start"], day="window_start")
    written, seen, at = 0, set(), []
    for batch in range(60):
        # The last window of the batch before changes again.
        table.put(_windows(spark, range(batch * 144 - 12, batch * 144 + 133, 12), batch), batch)
        table.fold(most=4)
        for file in Path(lake, "t").rglob("*.parquet"):
            if str(file) not in seen:
                seen.add(str(file))
                written += file.stat().st_size
        at.append(written)
    assert at[59] < 2.3 * at[29]
    found = table.read()
    assert found.count() == found.select("city", "window_start").distinct().count() == 721
    low = table.read("2026-06-03", "2026-06-04")
    assert low.count() == 240 and low.agg(F.min("v")).first()[0] == 20
    # Folded days are neither ranked nor read for other days.
    text = plan(table.read("2026-06-02", "2026-06-02"))
    assert "PartitionFilters" in text and "day" in text.split("PartitionFilters")[1]
    held = table._folders(table._stored())
    assert all(len(v) == 1 for d, v in held.items() if d < "2026-06-05")


def test_late_rows_reach_a_folded_day(spark, lake):
    table = KeyedTable(spark, f"{lake}/t", ["city", "window_start"], day="window_start")
    for batch in range(5):
        table.put(_windows(spark, [batch * 1440], batch), batch)
        table.fold(most=2)
    table.put(_windows(spark, [0], 77), 9)
    table.fold(most=2)
    assert sorted(r.v for r in table.read().collect()) == [1, 2, 3, 4, 77]
    table.fold_days()
    table.fold_days()
    assert sorted(r.v for r in table.read().collect()) == [1, 2, 3, 4, 77]
    assert sorted(r.v for r in table.changes(2).collect()) == [3, 4, 77]


def test_reader_of_folded_versions_is_not_disturbed(spark, lake):
    table = KeyedTable(spark, f"{lake}/t", ["city", "period"])
    for batch in range(4):
        table.put(frame(spark, (f"c{batch}", "before", batch)), batch)
    listed = table.read()
    table.fold(most=2)
    assert listed.count() == 4  # what it listed is still there
    table.fold(most=2)
    assert table.read().count() == 4


def test_counts_come_from_footers(spark, lake):
    df = spark.range(0, 1000, 1, 4).select("id", F.when(F.col("id") % 4 > 0, F.col("id")).alias("v"))
    df.withColumn("p", F.col("id") % 3).write.partitionBy("p").parquet(f"{lake}/t")
    got = tables.footer_counts(spark, {"all": (f"{lake}/t", None), "v": (f"{lake}/t", "v"), "no": (f"{lake}/x", None)})
    assert got == {"all": 1000, "v": 750, "no": 0}
    with tables._footers_answer(spark):
        for column in (None, "v"):
            assert "PushedAggregation: [COUNT" in plan(tables.footer_count(spark, f"{lake}/t", column))
    assert "PushedAggregation" not in plan(spark.read.parquet(f"{lake}/t").agg(F.count("v")))


def test_lookup_reads_sorted_files(spark, lake):
    states = spark.range(0, 5000, 1, 4).select(
        F.concat(F.lit("city_"), (F.col("id") % 5).cast("string")).alias("city"),
        F.concat(F.lit("road_"), F.col("id").cast("string")).alias("road_name"), F.col("id").alias("v"),
    )
    tables.write_latest(states, f"{lake}/t")
    stored = tables.read_replaced(spark, f"{lake}/t")
    found = tables.find_roads(stored, [("city_2", "road_7"), ("city_3", "road_8"), ("city_0", "road_9")])
    assert sorted(r.v for r in found.collect()) == [7, 8]
    text = plan(found)
    assert "Window" not in text and "In(road_name" in text and "In(city" in text
    assert tables.find_roads(stored, []).isEmpty()


def test_precision_losses_are_counted(spark):
    df = spark.createDataFrame([(1e300, 1.0), (12.0, None), (None, 1e9)], "zscore DOUBLE, avg_speed DOUBLE")
    got = {g["column_name"]: g["dropped"] for g in rows(tables.beyond_precision(df))}
    assert got == {"zscore": 1, "avg_speed": 1}
    assert rows(tables.beyond_precision(df.select(F.lit(1).alias("other")))) == []


def test_jdbc_options():
    got = tables.jdbc_options("jdbc:x", "t", "id", (1, 9), 4, {"user": "u"})
    assert got == {
        "url": "jdbc:x", "dbtable": "t", "partitionColumn": "id", "lowerBound": "1", "upperBound": "9",
        "numPartitions": "4", "user": "u",
    }


def test_upsert_keys(spark):
    """Null is a key; several updates of one key leave one row."""
    target = spark.createDataFrame([(None, 1), ("a", 1), ("b", 5)], "k STRING, v INT")
    updates = spark.createDataFrame([(None, 2), ("a", 2), ("a", 3)], "k STRING, v INT")
    got = {g["k"]: g["v"] for g in rows(tables.upsert(target, updates, ["k"]))}
    assert got == {None: 2, "a": 3, "b": 5} and tables.upsert(target, updates, ["k"]).count() == 3


def test_withdrawn_days_leave_silver(spark, lake):
    readings = samples.road_readings(SampleTables(spark, SMALL).events)
    clean = cleaning.silver_readings(readings)
    tables.refresh_silver(clean, f"{lake}/s")
    days = clean.select(F.to_date("recorded_at").alias("date")).distinct().orderBy("date").limit(2)
    first = days.orderBy("date").first()["date"]
    tables.refresh_silver(clean.where(F.lit(False)), f"{lake}/s", days.where(F.col("date") == F.lit(first)))
    left = tables.read_silver(spark, f"{lake}/s")
    assert left.count() == clean.where(F.to_date("recorded_at") != F.lit(first)).count()
    tables.refresh_silver(clean.where(F.to_date("recorded_at") == F.lit(first)), f"{lake}/s")
    left = tables.read_silver(spark, f"{lake}/s")
    assert left.count() == clean.where(F.to_date("recorded_at") == F.lit(first)).count()


def test_read_queries_stage_small_tables_only(spark, tmp_path, monkeypatch):
    """They write baselines and cells, never silver, and all of it can be cleaned."""
    from pathlib import Path

    from tidemark import session

    def size(place):
        return sum(f.stat().st_size for f in Path(place).rglob("*.parquet"))

    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path / "own"))
    monkeypatch.setattr(session, "_STAGED", [])
    folder = "/root/testdata/sf0.01"  # here silver is larger than the tables that roll it up
    tables.replace_table(catalog.silver(SampleTables(spark, folder)), str(tmp_path / "silver"))
    before = 0
    for name in ("anomaly_scored", "anomaly_rate", "top_anomalies", "top_anomalies_city", "alerts",
                 "mobility_score"):
        catalog.REGISTRY[name](spark, folder).collect()
        assert size(tmp_path / "own") - before < size(tmp_path / "silver"), name
        before = size(tmp_path / "own")
    assert before > 0
    session.clean_scratch(spark)
    assert size(tmp_path / "own") == 0


def test_silver_refresh_is_idempotent(spark, lake):
    bronze = samples.road_readings(SampleTables(spark, SMALL).events)
    clean = cleaning.silver_readings(bronze)
    path = f"{lake}/silver"
    tables.refresh_silver(clean, path)
    first = tables.read_silver(spark, path).count()
    tables.refresh_silver(clean, path)
    assert tables.read_silver(spark, path).count() == first == clean.count()


def test_partition_pruning_of_the_trailing_window(spark, lake):
    bronze = samples.road_readings(SampleTables(spark, SMALL).events)
    tables.seed_bronze(bronze, f"{lake}/bronze")
    stored = spark.read.parquet(f"{lake}/bronze")
    assert {r.ingested_via for r in stored.select("ingested_via").distinct().collect()} == {"batch_seed"}
    recent = tables.trailing_window(stored, "2024-01-25 00:00:00", 10)
    text = plan(recent)
    assert "PartitionFilters: [isnotnull(date" in text and "date#" in text.split("PartitionFilters")[1]
    wanted = bronze.where("recorded_at BETWEEN '2024-01-15' AND '2024-01-25'")
    assert recent.count() == wanted.count()
    assert tables.trailing_window(stored, "2030-01-01 00:00:00", 10).isEmpty()
    ahead = tables.trailing_window(stored, "2024-01-25 00:00:00", 10, ahead=True)
    assert ahead.count() == bronze.where("recorded_at >= '2024-01-15'").count()


def test_history_and_replace(spark, lake):
    df = frame(spark, ("a", "before", 1))
    for run in ("r1", "r2", "r2"):
        tables.append_history(df, f"{lake}/h", run, "2026-06-01 00:00:00")
    assert spark.read.parquet(f"{lake}/h").count() == 2
    for _ in range(2):
        tables.replace_table(df, f"{lake}/p")
    assert tables.read_replaced(spark, f"{lake}/p").count() == 1
    for _ in range(3):
        tables.replace_table(df.unionAll(df), f"{lake}/p")
    assert tables.read_replaced(spark, f"{lake}/p").count() == 2
    assert len(tables._versions(spark, f"{lake}/p", "load")) == 2


def test_csv_report_per_city(spark, lake):
    report = spark.createDataFrame([("a", "p", 0.5), ("b", "p", 0.1)], "city STRING, pair STRING, r DOUBLE")
    tables.export_csv(report, f"{lake}/csv")
    back = spark.read.option("header", True).csv(f"{lake}/csv")
    assert rows(back.select("city", "pair", "r"), "city") == [
        {"city": "a", "pair": "p", "r": "0.5"}, {"city": "b", "pair": "p", "r": "0.1"}
    ]


def test_documents(spark):
    silver = spark.createDataFrame(
        [("a", "before", 8, 10.004, 40.0), ("a", "after", 8, 30.0, 20.0), ("a", "after", 9, 50.0, 10.0)],
        "city STRING, period STRING, hour INT, congestion_index DOUBLE, current_speed DOUBLE",
    )
    wide = impact.comparison_wide(impact.city_comparison(silver))
    doc = rows(tables.comparison_documents(wide))[0]
    assert doc["key"] == "comparison:a"
    assert json.loads(doc["document"]) == {
        "before": {"avg_congestion": 10.0, "avg_speed": 40.0, "records": 1},
        "after": {"avg_congestion": 40.0, "avg_speed": 15.0, "records": 2},
        "change_pct": 30.0,
    }
    hourly = rows(tables.hourly_documents(impact.hourly_pattern(silver)))[0]
    assert json.loads(hourly["document"]) == {
        "before": {"8": {"avg_congestion": 10.0, "avg_speed": 40.0}},
        "after": {
            "8": {"avg_congestion": 30.0, "avg_speed": 20.0},
            "9": {"avg_congestion": 50.0, "avg_speed": 10.0},
        },
    }


def test_published_precision(spark):
    df = spark.createDataFrame([(1.005, 12.3456, "a")], "avg_speed DOUBLE, zscore DOUBLE, city STRING")
    got = rows(tables.published_precision(df))[0]
    assert str(got["zscore"]) == "12.346" and got["city"] == "a"


def test_hot_key_is_limited_before_the_shuffle(spark):
    """A third of the rows on one key: each input task sends one row of it."""
    n = 30_000
    df = spark.range(0, n, 1, 8).select(
        F.lit("a").alias("city"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id").cast("string")))
        .alias("road_name"),
        F.lit(datetime(2026, 6, 1)).alias("recorded_at"),
        F.col("id").alias("ingest_seq"),
    )
    once = cleaning.deduplicate_readings(df)
    text = plan(once)
    assert "WindowGroupLimit" in text and "Partial" in text
    got = once.where("road_name = 'hot'").collect()
    assert [r.ingest_seq for r in got] == [n - 3] and once.count() == n - n // 3 + 1


def test_baseline_is_broadcast_by_its_stored_size(spark):
    t = SampleTables(spark, SMALL)
    silver = stage(catalog.silver(t), "silver")
    scored = anomaly.score_readings(silver, stage(anomaly.baseline_stats(silver), "baseline"))
    assert "BroadcastHashJoin" in plan(scored) and "Exchange hashpartitioning" not in plan(scored)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(scored.select("*"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_query_uses_a_cross_join(spark):
    # Streams, cycles and models run inside their query; their results are plain reads.
    heavy = ("stream_", "cycle_", "medallion", "gold_summary", "rf_", "forecast_", "mobility_forecast",
             "bronze_rejects", "city_cluster", "cluster_o", "road_zones", "feature_store", "layer_counts",
             "daily_documents", "hourly_documents")
    for name in (n for n in catalog.REGISTRY if not n.startswith(heavy)):
        text = plan(catalog.REGISTRY[name](spark, SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_scratch_needs_a_shared_folder_off_local(spark, monkeypatch):
    import pytest

    from tidemark import session

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        Cluster.sparkContext.master = master
        with pytest.raises(ValueError):
            session.scratch_root(Cluster)


def test_a_hot_partition_becomes_several_files(spark, lake):
    from pathlib import Path

    n = 60_000
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 40).cast("string")))
        .alias("city"),
        F.lit("2026-06-01").cast("date").alias("date"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "200KB")
    try:
        tables.write_partitioned(df, f"{lake}/t")
    finally:
        spark.conf.unset(key)
    assert len(list(Path(lake, "t", "city=hot").rglob("*.parquet"))) > 2
    assert spark.read.parquet(f"{lake}/t").count() == n
