import math

import numpy as np
import pytest
from conftest import SMALL, rows
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import ImpactSettings
from tidemark.operators import congestion_model, features, mobility_forecast, sequences, zones
from tidemark.plans import catalog
from tidemark.plans.cycle import Lake, last_batch, run_cycle
from tidemark.session import stage
from tidemark.sources import samples, tables
from tidemark.sources.samples import SampleTables


@pytest.fixture(scope="module")
def silver(spark):
    return stage(catalog.silver(SampleTables(spark, SMALL)), "silver")


def test_split_is_stable_and_near_the_share(silver):
    marked = congestion_model.mark_split(silver)
    first = marked.where("is_train").count()
    assert first == congestion_model.mark_split(silver.repartition(7)).where("is_train").count()
    assert 0.75 < first / silver.count() < 0.85
    timed = congestion_model.mark_split(silver, chronological=True)
    edges = timed.groupBy("is_train").agg(
        F.min("recorded_at").alias("lo"), F.max("recorded_at").alias("hi")
    )
    got = {r.is_train: r for r in edges.collect()}
    assert got[True].hi < got[False].lo


def test_metrics_equal_the_library_ones(spark):
    rng = np.random.default_rng(1)
    data = [(float(a), float(b)) for a, b in rng.integers(0, 4, size=(200, 2))]
    preds = spark.createDataFrame(data, "label DOUBLE, prediction DOUBLE")
    counts = spark.createDataFrame([(7, 0)], "train_rows LONG, dropped_rows LONG")
    got = {g["metric_name"]: g for g in rows(congestion_model.metrics(preds, counts))}
    for name in ("accuracy", "f1"):
        want = MulticlassClassificationEvaluator(labelCol="label", metricName=name).evaluate(preds)
        assert got[name]["metric_value"] == pytest.approx(want, abs=5e-5)
        assert (got[name]["train_rows"], got[name]["test_rows"]) == (7, 200)


def test_classifier_and_forecast(silver):
    settings = ImpactSettings(trees=10)
    fitted = congestion_model.fit_classifier(silver, settings)
    model, means = fitted.model, congestion_model.speed_means(silver)
    assert fitted.held and all(0 < m["metric_value"] <= 1 for m in rows(fitted.frame))
    got = rows(congestion_model.forecast(model, means, "2024-01-30 23:45:00"), "city", "horizon_minutes")
    assert len(got) == 6 and {g["horizon_minutes"] for g in got} == {30, 60}
    assert all(g["predicted_level"] in range(4) and g["predicted_label"] for g in got)
    wide = rows(congestion_model.forecast_by_city(
        congestion_model.forecast(model, means, "2024-01-30 23:45:00")), "city")
    assert [w["predicted_30m"] for w in wide] == [g["predicted_level"] for g in got if g["horizon_minutes"] == 30]
    few = congestion_model.fit_classifier(silver.limit(49), settings)
    assert not few.held and "50" in few.reason and few.model is None
    assert few.frame.dtypes == fitted.frame.dtypes and few.frame.isEmpty()
    nothing = congestion_model.forecast(None, means, "2024-01-30 23:45:00")
    assert nothing.isEmpty() and nothing.columns == congestion_model.forecast(model, means, "2024-01-30 23:45:00").columns


def roads(spark, *data):
    full = [(f"c{i}", f"r{i}", b, b + d, d, -6.0, 106.0) for i, (b, d) in enumerate(data)]
    return spark.createDataFrame(
        full, "city STRING, road_name STRING, ci_before DOUBLE, ci_after DOUBLE, "
        "delta_congestion DOUBLE, lat DOUBLE, lon DOUBLE"
    )


def test_road_zones_follow_the_mean_change(spark):
    data = [(30.0, d) for d in (0.0, 0.5, 1.0, 10.0, 10.5, 11.0, 30.0, 30.5, 31.0)]
    got = rows(zones.cluster_roads(roads(spark, *data)).frame, "delta_congestion")
    assert [g["zone_label"] for g in got] == (
        ["Dampak Rendah"] * 3 + ["Dampak Sedang"] * 3 + ["Dampak Tinggi"] * 3
    )
    few = zones.cluster_roads(roads(spark, (1.0, 1.0), (2.0, 2.0)))
    enough = zones.cluster_roads(roads(spark, (1.0, 1.0), (2.0, 2.0), (9.0, 9.0)))
    assert not few.held and few.frame.isEmpty() and enough.frame.count() == 3
    assert few.frame.dtypes == enough.frame.dtypes


# The demonstration rows: six cities, five measures.
CITIES = [
    ("Jakarta", 8.5, 12.3, 0.42, -5.2, 0.85), ("Surabaya", 7.2, 8.7, 0.28, -3.8, 0.70),
    ("Bandung", 9.1, 15.2, 0.21, -7.1, 0.65), ("Medan", 10.3, 18.5, 0.15, -8.9, 0.60),
    ("Makassar", 8.8, 11.1, 0.19, -4.5, 0.58), ("Semarang", 7.9, 9.4, 0.25, -3.2, 0.67),
]


def cities(spark):
    names = ", ".join(f"{n} DOUBLE" for n in zones.CITY_CLUSTER_FEATURES)
    return spark.createDataFrame(CITIES, f"city STRING, {names}")


def test_city_clusters_save_and_score(spark, lake):
    df = cities(spark)
    fitted = zones.fit_city_clusters(df)
    model, labelled = fitted.model, rows(fitted.frame, "city")
    few = zones.fit_city_clusters(df.limit(2))
    assert not few.held and few.frame.isEmpty() and few.frame.dtypes == fitted.frame.dtypes
    same = df.withColumns({n: F.lit(1.0) for n in zones.CITY_CLUSTER_FEATURES})
    assert zones.fit_city_clusters(same).reason
    means = {}
    for g in labelled:
        means.setdefault((g["cluster"], g["impact_level"]), []).append(g["avg_mobility_drop"])
    ranked = sorted(means.items(), key=lambda m: -np.mean(m[1]))
    assert ranked[0][0][1] == "high_impact" and ranked[-1][0][1] == "low_impact"
    assert all(level == "moderate_impact" for (_, level), _ in ranked[1:-1])
    zones.save_clusters(model, zones.impact_levels(model.transform(df)), f"{lake}/m")
    scored = rows(zones.score_cities(*zones.load_clusters(spark, f"{lake}/m"), df), "city")
    assert [(g["cluster"], g["impact_level"]) for g in scored] == [
        (g["cluster"], g["impact_level"]) for g in labelled
    ]
    assert all(g["cluster"] == int(np.argmin(g["distances"])) for g in scored)


@pytest.mark.parametrize("k", [2, 5])
def test_impact_levels_for_other_k(spark, k):
    df = spark.createDataFrame([(i, float(i)) for i in range(k)], "cluster INT, avg_mobility_drop DOUBLE")
    got = [g["impact_level"] for g in rows(zones.impact_levels(df), "cluster")]
    assert got == ["low_impact"] + ["moderate_impact"] * (k - 2) + ["high_impact"]


def test_mobility_forecast_learns_the_daily_cycle(spark):
    n = 48 * 8
    step = F.col("id").cast("int")
    hour = (step % 48) / 2
    swing = F.sin(2 * math.pi * hour / 24)
    df = spark.range(n).select(
        F.explode(F.array(F.lit("a"), F.lit("b"))).alias("city"),
        F.timestamp_seconds(F.lit(1767225600) + step * 1800).alias("window_start"),
        F.lit(0.0).alias("fuel_price_delta"), (0.5 - 0.3 * swing).alias("traffic_index"),
        F.lit(0.5).alias("weather_score_norm"), F.lit(0.5).alias("transport_usage_norm"),
        F.floor(hour).cast("int").alias("time_of_day"), F.lit(1).alias("day_of_week"),
        F.lit(0).alias("holiday_flag"), (0.5 + 0.3 * swing).alias("mobility_composite"),
    )
    inputs = features.forecast_inputs(stage(df, "daily"))
    built = stage(sequences.training_sequences(inputs), "sequences")
    fitted = mobility_forecast.fit_forecast(built)
    got = rows(fitted.frame, "city")
    # The plain mean would be off by about 0.19.
    assert [g["city"] for g in got] == ["a", "b"] and all(g["mae"] < 0.06 for g in got)
    steps = rows(mobility_forecast.forecast_mobility(fitted.model, inputs), "city", "step")
    assert len(steps) == 96 and all(0 <= s["mobility_score"] <= 1 for s in steps)
    assert (steps[1]["forecast_at"] - steps[0]["forecast_at"]).total_seconds() == 1800
    few = mobility_forecast.fit_forecast(built.where("pos < 0"))
    assert not few.held and few.frame.dtypes == fitted.frame.dtypes and few.frame.isEmpty()


def test_weights_equal_a_ridge_solved_at_once(spark):
    """Coefficients against numpy on the rows themselves; an input that does not vary gets none."""
    names = ("a", "b")
    random = np.random.default_rng(6)
    data = []
    for city, shift in (("x", 0.0), ("y", 3.0)):
        for k in range(300):
            a, step = float(random.normal()) + shift, float(k % 48)
            last_b, mean_a = 0.7, a * 0.5 + float(random.normal()) * 0.1
            label = 0.2 + 0.1 * a - 0.05 * mean_a + 0.01 * step + float(random.normal()) * 0.01
            data.append((city, a, last_b, mean_a, a * a, step, math.sin(step), math.cos(step), label))
    columns = ["city", "last_a", "last_b", "mean_a", "mean_b", "step", "step_sin", "step_cos", "label"]
    rows_ = spark.createDataFrame(data, columns)
    size = len(mobility_forecast.inputs_of(names))
    solved = mobility_forecast.solve_cities(mobility_forecast.gram_sums(rows_, names), size)
    got = {r.city: np.array(r.weights) for r in solved.collect()}
    for city in ("x", "y"):
        x = np.array([d[1:8] for d in data if d[0] == city])
        y = np.array([d[8] for d in data if d[0] == city])
        mean, scale = x.mean(axis=0), x.std(axis=0)
        varies = scale > 1e-9
        z = (x[:, varies] - mean[varies]) / scale[varies]
        inner = np.linalg.solve(z.T @ z / len(z) + 1e-3 * np.eye(z.shape[1]), z.T @ (y - y.mean()) / len(z))
        weights = np.zeros(7)
        weights[varies] = inner / scale[varies]
        assert got[city][1:] == pytest.approx(weights, abs=1e-7)
        assert got[city][0] == pytest.approx(y.mean() - weights @ mean, abs=1e-7) and got[city][2] == 0
    scored = rows(mobility_forecast.predicted(solved, rows_.where("city = 'x'").limit(5), names))
    for s in scored:
        inputs = np.array([1.0, *(s[c] for c in columns[1:8])])
        assert s["mobility_score"] == pytest.approx(min(1.0, max(0.0, float(got["x"] @ inputs))))


def test_cycle_runs_twice_to_the_same_tables(spark, lake):
    t = SampleTables(spark, SMALL)
    place = Lake(spark, lake)
    tables.seed_bronze(samples.road_readings(t.events), place.path("bronze_traffic"))
    settings = ImpactSettings(trees=5)
    assert run_cycle(place, "2030-01-01 00:00:00", settings) == []
    written = run_cycle(place, "2024-01-31 12:00:00", settings)
    before = {name: place.read(name).count() for name in written}
    assert run_cycle(place, "2024-01-31 12:00:00", settings) == written
    assert {name: place.read(name).count() for name in written} == before
    # Tables that were never written have the columns of those that were.
    nothing = Lake(spark, f"{lake}/nothing")
    for name in set(schemas.GOLD) - {"silver_traffic"}:
        assert dict(place.stored(name).dtypes) == dict(nothing.stored(name).dtypes), name
        assert nothing.read(name).isEmpty()
    docs = place.read("serving_documents")
    prefixes = {r.p for r in docs.select(F.split("key", ":")[0].alias("p")).collect()}
    assert prefixes == {
        "comparison", "hourly", "anomaly_rate", "daily", "prediction", "model_metrics", "cluster"
    }
    assert docs.count() == docs.select("key").distinct().count()
    comparison = place.read("gold_city_comparison")
    assert dict(comparison.dtypes)["avg_congestion"] == "decimal(6,2)"


def test_incremental_cycle_only_cleans_touched_days(spark, lake):
    t = SampleTables(spark, SMALL)
    place = Lake(spark, lake)
    bronze = samples.road_readings(t.events)
    tables.seed_bronze(bronze, place.path("bronze_traffic"))
    run_cycle(place, "2024-01-31 12:00:00", with_models=False)
    full = place.read("silver_traffic").count()
    # A later batch corrects one day: every reading of it is now invalid.
    day = bronze.where("to_date(recorded_at) = '2024-01-30'")
    fixed = day.withColumns({"ingest_seq": F.col("ingest_seq") + 10**9, "current_speed": F.lit(0.0)})
    tables.write_partitioned(
        tables_with_batch(fixed, 1), place.path("bronze_traffic"), by=tables.BRONZE_PARTITIONS
    )
    added = bronze.where("to_date(recorded_at) = '2024-01-29'").limit(1).selectExpr(
        "* EXCEPT (road_name)", "'road_new' AS road_name"
    ).withColumns({"congestion_index": F.lit(50.0), "current_speed": F.lit(9.0)})
    tables.write_partitioned(
        tables_with_batch(added, 2), place.path("bronze_traffic"), by=tables.BRONZE_PARTITIONS
    )
    run_cycle(place, "2024-01-31 12:10:00", with_models=False, after_batch=1)
    assert place.read("silver_traffic").count() == full + 1
    assert place.read("gold_anomaly_rate").agg(F.sum("total_records")).first()[0] == full + 1
    # The corrections of batch 1 were passed over; the noted position has seen batch 2.
    assert last_batch(place) == 2
    run_cycle(place, "2024-01-31 12:20:00", with_models=False, after_batch=0)
    gone = day.where("congestion_index BETWEEN 0 AND 100 AND current_speed > 0").dropDuplicates(
        ["city", "road_name", "recorded_at"]
    ).count()
    left = place.read("silver_traffic")
    assert left.count() <= full + 1 - gone and left.where("to_date(recorded_at) = '2024-01-30'").count() == 0
    # Nothing new: silver stays, gold follows the window.
    written = run_cycle(place, "2024-02-25 00:00:00", with_models=False, incremental=True)
    assert "silver_traffic" not in written and "gold_anomaly_rate" in written
    since = left.where("recorded_at >= '2023-12-27'").count()
    assert place.read("gold_anomaly_rate").agg(F.sum("total_records")).first()[0] == since


def test_changed_days():
    from tidemark.plans.cycle import changed_days

    days = changed_days("2024-03-03 01:00:00", "2024-03-01 23:00:00", ["2024-02-20", "2023-12-01"], 60)
    assert days == ["2024-01-03", "2024-02-20", "2024-03-01", "2024-03-02", "2024-03-03"]
    back = changed_days("2024-03-01 00:00:00", "2024-03-02 00:00:00", [], 60)
    assert back == ["2024-01-01", "2024-01-02", "2024-03-01"]


def _gold(place):
    cells = place.read("silver_cells")
    return {
        name: rows(df.drop("computed_at").select(sorted(c for c in df.columns if c != "computed_at")),
                   *sorted(c for c in df.columns if c != "computed_at"))
        for name, df in {
            "cells": cells, "comparison": place.read("gold_city_comparison"),
            "hourly": place.read("gold_hourly_pattern"), "rate": place.read("gold_anomaly_rate"),
            "top": place.read("gold_anomalies"), "documents": place.read("serving_documents"),
        }.items()
    }


def test_incremental_cycles_equal_a_full_one(spark, tmp_path, monkeypatch):
    """Corrections, new days and a moving window: kept cells and fresh ones give one result,
    and only the days that changed are read for them."""
    from tidemark.operators import impact

    t = SampleTables(spark, SMALL)
    bronze = samples.road_readings(t.events)
    kept, fresh = Lake(spark, str(tmp_path / "kept")), Lake(spark, str(tmp_path / "fresh"))
    settings = ImpactSettings(trailing_days=9)
    late = "to_date(recorded_at) IN ('2024-01-14', '2024-01-16')"
    for place in (kept, fresh):
        tables.seed_bronze(bronze.where(f"NOT {late}"), place.path("bronze_traffic"))
    run_cycle(kept, "2024-01-16 10:30:00", settings, with_models=False, incremental=True)
    fixed = bronze.where("to_date(recorded_at) = '2024-01-12' AND city = 'city_1'")
    fixed = fixed.withColumns({"ingest_seq": F.col("ingest_seq") + 10**9, "current_speed": F.lit(0.0)})
    for place in (kept, fresh):
        for batch, part in ((1, bronze.where(late)), (2, fixed)):
            tables.write_partitioned(
                tables_with_batch(part, batch), place.path("bronze_traffic"), by=tables.BRONZE_PARTITIONS
            )
    read = []
    whole = impact.reading_cells

    def watched(silver):
        read.extend(str(r["date"]) for r in silver.select("date").distinct().collect())
        return whole(silver)

    monkeypatch.setattr(impact, "reading_cells", watched)
    run_cycle(kept, "2024-01-18 06:15:00", settings, with_models=False, incremental=True)
    assert set(read) == {"2024-01-09", "2024-01-12", "2024-01-14", "2024-01-16", "2024-01-17", "2024-01-18"}
    monkeypatch.undo()
    run_cycle(fresh, "2024-01-18 06:15:00", settings, with_models=False)
    assert _gold(kept) == _gold(fresh)


def test_withdrawn_city_is_not_served(spark, lake):
    """All readings of a city corrected away: no document and no gold row of it stays."""
    t = SampleTables(spark, SMALL)
    place = Lake(spark, lake)
    bronze = samples.road_readings(t.events)
    tables.seed_bronze(bronze, place.path("bronze_traffic"))
    run_cycle(place, "2024-01-31 12:00:00", with_models=False)
    keys = {r.key for r in place.read("serving_documents").collect()}
    assert {"comparison:city_1", "daily:city_1", "hourly:city_1"} <= keys
    gone = bronze.where("city = 'city_1'").withColumns(
        {"ingest_seq": F.col("ingest_seq") + 10**9, "current_speed": F.lit(0.0)}
    )
    tables.write_partitioned(
        tables_with_batch(gone, 1), place.path("bronze_traffic"), by=tables.BRONZE_PARTITIONS
    )
    run_cycle(place, "2024-01-31 12:10:00", with_models=False, incremental=True)
    assert not [r.key for r in place.read("serving_documents").collect() if "city_1" in r.key]
    for table in ("gold_city_comparison", "gold_hourly_pattern", "gold_daily_summary", "silver_cells"):
        assert place.read(table).where("city = 'city_1'").isEmpty() and not place.read(table).isEmpty()


def test_cycle_sees_nothing_after_its_time(spark, lake):
    t = SampleTables(spark, SMALL)
    place = Lake(spark, lake)
    tables.seed_bronze(samples.road_readings(t.events), place.path("bronze_traffic"))
    run_cycle(place, "2024-01-10 00:00:00", with_models=False)
    cells = place.read("silver_cells")
    assert cells.where("date > '2024-01-10'").count() == 0 < cells.count()
    assert place.read("gold_city_comparison").where("period = 'after'").count() == 0


def test_constant_hours_have_no_false_anomalies(spark, lake):
    """Equal readings have deviation 0 in both baselines; their published score can be read."""
    from tidemark.operators import anomaly, impact

    rows_ = spark.range(20_000).select(
        F.concat(F.lit("c"), (F.col("id") % 17).cast("string")).alias("city"),
        F.lit("r").alias("road_name"),
        F.when(F.col("id") % 5 == 0, "after").otherwise("before").alias("period"),
        (F.col("id") % 24).cast("int").alias("hour"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("recorded_at"),
        (30.1 + F.col("id") % 17 / 7 + F.when(F.col("id") % 5 == 0, 1.5).otherwise(0.0)).alias("congestion_index"),
        F.lit(20.0).alias("current_speed"), F.lit(40.0).alias("free_flow_speed"),
    ).repartition(13)
    for baseline in (anomaly.baseline_stats(rows_), anomaly.baseline_from_cells(impact.reading_cells(rows_))):
        assert baseline.where("sigma > 0").count() == 0
        scored = anomaly.score_readings(rows_, stage(baseline, "b"))
        assert scored.where("is_anomaly = 1").count() == 0
    wild = spark.createDataFrame([(1e300,), (12.3456,)], "zscore DOUBLE")
    assert [str(r[0]) for r in tables.published_precision(wild).collect()] == ["None", "12.346"]


def test_readings_without_a_feature_are_counted(spark, silver):
    holes = silver.withColumn("free_flow_speed", F.when(F.col("hour") != 7, F.col("free_flow_speed")))
    got = rows(congestion_model.fit_classifier(holes, ImpactSettings(trees=3)).frame)[0]
    assert got["dropped_rows"] == silver.where("hour = 7").count() > 0
    assert got["train_rows"] + got["test_rows"] + got["dropped_rows"] == silver.count()


def test_no_horizon_hides_behind_repeated_predictions(spark):
    from tidemark.plans import serving

    stored = spark.createDataFrame(
        [("a", 30, 1, f"2026-01-02 {h:02d}:{m:02d}:00") for h in range(12) for m in (0, 20, 40)]
        + [("a", 90, 2, "2026-01-01 00:00:00")],
        "city STRING, horizon_minutes INT, predicted_level INT, predicted_at STRING",
    )
    steps = rows(serving.forecast_steps(stored.limit(0), stored), "hour_offset")
    assert [s["hour_offset"] for s in steps] == [0.5, 1.5]


def tables_with_batch(df, batch):
    from tidemark.operators.cleaning import with_defaults

    return with_defaults(df).withColumn("ingest_batch", F.lit(batch))
