from datetime import date, datetime

import pytest
from conftest import rows

from tidemark.operators import alerts, anomaly, impact, latest
from tidemark.plans import serving

SILVER = (
    "city STRING, road_name STRING, lat DOUBLE, lon DOUBLE, current_speed DOUBLE, "
    "free_flow_speed DOUBLE, congestion_index DOUBLE, period STRING, recorded_at TIMESTAMP, hour INT"
)


def silver(spark, *data):
    full = [
        (city, road, -6.0, 106.0, speed, 60.0, ci, period, at, at.hour)
        for city, road, period, at, ci, speed in data
    ]
    return spark.createDataFrame(full, SILVER)


T0 = datetime(2026, 6, 1, 8)


def test_comparison_with_a_missing_side(spark):
    df = silver(
        spark,
        ("both", "r", "before", T0, 10.0, 40.0), ("both", "r", "after", T0, 30.0, 20.0),
        ("old", "r", "before", T0, 10.0, 40.0), ("new", "r", "after", T0, 25.0, 30.0),
    )
    got = {g["city"]: g for g in rows(impact.comparison_wide(impact.city_comparison(df)))}
    assert got["both"]["change_pct"] == 20.0
    assert got["old"]["change_pct"] == -10.0 and got["old"]["after_records"] == 0
    assert got["new"]["change_pct"] == 25.0 and not got["new"]["has_before"]
    zones = impact.modal_zone(impact.road_impact(df), "zone_band")
    scored = {g["city"]: g for g in rows(serving.mobility(
        impact.comparison_wide(impact.city_comparison(df)), zones))}
    assert scored["old"]["mobility_score"] is None and not scored["old"]["has_after"]
    assert scored["both"]["mobility_score"] == 0.7
    assert scored["both"]["impact_level"] == "high_impact"
    assert scored["new"]["impact_level"] == "moderate_impact"


def test_road_impact_drops_one_sided_roads(spark):
    df = silver(
        spark,
        ("a", "r1", "before", T0, 10.0, 40.0), ("a", "r1", "after", T0, 15.0, 20.0),
        ("a", "r2", "before", T0, 10.0, 40.0),
        ("a", "r3", "before", T0, 10.0, 40.0), ("a", "r3", "after", T0, 25.0, 20.0),
        ("a", "r4", "before", T0, 10.0, 40.0), ("a", "r4", "after", T0, 25.01, 20.0),
    )
    got = rows(impact.ranked_roads(impact.road_impact(df)))
    assert [(g["road_name"], g["zone_band"]) for g in got] == [
        ("r4", "Dampak Tinggi"), ("r3", "Dampak Sedang"), ("r1", "Dampak Sedang")
    ]
    mode = rows(impact.modal_zone(impact.road_impact(df), "zone_band"))[0]
    assert (mode["zone"], mode["roads"]) == ("Dampak Sedang", 3)


def test_hourly_profile_is_dense_and_best_hour(spark):
    df = silver(
        spark,
        ("a", "r", "after", T0, 30.0, 20.0), ("a", "r", "after", T0.replace(hour=5), 10.0, 20.0),
        ("a", "r", "after", T0.replace(hour=3), 10.0, 20.0), ("b", "r", "before", T0, 1.0, 20.0),
    )
    hourly = impact.hourly_pattern(df)
    dense = rows(impact.hourly_profile(hourly), "city", "hour")
    assert len(dense) == 48 and dense[8]["after_congestion"] == 30.0
    assert sum(d["before_congestion"] for d in dense) == 1.0
    best = rows(impact.best_travel_hour(hourly, 8), "city")
    assert [(b["best_travel_hour"], b["expected_congestion"]) for b in best] == [
        (3, "Tinggi"), (6, "Tinggi")
    ]
    quiet = rows(impact.best_travel_hour(hourly, 12), "city")[0]
    assert quiet["expected_congestion"] == "Sedang"


def test_daily_summary_economics_and_latest_day(spark):
    df = silver(
        spark,
        ("a", "r", "after", datetime(2026, 6, 1), 50.0, 30.0),
        ("a", "r", "after", datetime(2026, 6, 2), 100.0, 30.0),
        ("b", "r", "after", datetime(2026, 6, 1), 0.0, 60.0),
    )
    daily = impact.daily_summary(df)
    got = {(g["city"], g["summary_date"].day): g for g in rows(daily)}
    # 30 km at 12 km/l; +25 % and +50 % fuel at 16250 per litre
    assert got["a", 1]["est_extra_fuel_cost_idr"] == 10156.25
    assert got["a", 2]["est_extra_fuel_cost_idr"] == 20312.5
    assert got["a", 1]["est_extra_travel_min"] == 30.0
    assert got["b", 1]["est_extra_fuel_cost_idr"] == 0.0 == got["b", 1]["est_extra_travel_min"]
    newest = rows(impact.latest_day(daily))
    assert [(g["city"], g["summary_date"]) for g in newest] == [("a", date(2026, 6, 2))]
    assert [g["city"] for g in rows(impact.newest_daily(daily, 2))] == ["a", "a"]


def test_anomaly_baseline_edges(spark):
    def at(hour):
        return T0.replace(hour=hour)

    df = silver(
        spark,
        # constant baseline: sigma 0 counts as 1
        ("a", "r1", "before", at(1), 10.0, 1.0), ("a", "r2", "before", at(1), 10.0, 1.0),
        ("a", "r1", "after", at(1), 12.0, 1.0), ("a", "r2", "after", at(1), 12.01, 1.0),
        # one baseline row: sigma null counts as 1
        ("a", "r1", "before", at(2), 10.0, 1.0), ("a", "r1", "after", at(2), 7.0, 1.0),
        # no baseline hour: no score, still counted
        ("a", "r1", "after", at(3), 90.0, 1.0),
    )
    scored = anomaly.score_readings(df, anomaly.baseline_stats(df))
    after = rows(scored.where("period = 'after'"), "hour", "road_name")
    assert [round(g["zscore"], 6) if g["zscore"] is not None else None for g in after] == [
        2.0, 2.01, -3.0, None
    ]
    assert [g["is_anomaly"] for g in after] == [0, 1, 1, 0]
    rate = {g["period"]: g for g in rows(anomaly.anomaly_rate(scored))}
    assert rate["after"]["total_records"] == 4 and rate["after"]["anomaly_rate_pct"] == 50.0
    assert rate["before"]["anomaly_rate_pct"] == 0.0
    top = rows(anomaly.top_anomalies(scored, 1))
    assert top[0]["zscore"] == -3.0


def test_latest_ties_and_snapshot(spark):
    df = silver(
        spark,
        ("a", "r1", "before", T0, 10.0, 10.0), ("a", "r1", "before", T0, 20.0, 20.0),
        ("a", "r2", "after", T0.replace(day=2), 40.0, 30.0),
    ).selectExpr("*", "CAST(congestion_index AS BIGINT) AS ingest_seq")
    now = latest.latest_readings(df)
    assert sorted(g["congestion_index"] for g in rows(now)) == [20.0, 40.0]
    snap = rows(latest.city_snapshot(now))[0]
    assert (snap["avg_congestion"], snap["mobility_index"], snap["roads_monitored"]) == (30.0, 70.0, 2)
    assert snap["period"] == "after" and snap["updated_at"].day == 2


def test_road_pages_hold_every_road_once(spark):
    df = silver(
        spark, *[("a", f"r{i}", "after", T0, float(i), 1.0) for i in range(57)]
    ).selectExpr("*", "0L AS ingest_seq")
    pages = rows(latest.road_pages(latest.latest_readings(df), page_size=10))
    names = [r["road_name"] for p in pages for r in p["roads"]]
    assert len(names) == 57 == len(set(names)) and len(pages) > 1


PRICES = [
    ("F1", 12300.0, 16250.0, date(2024, 1, 21)), ("F2", 12900.0, 17000.0, date(2024, 1, 21)),
    ("F3", 10000.0, 10000.0, date(2024, 1, 21)), ("F4", 10000.0, 10500.0, date(2024, 2, 1)),
]


def prices(spark):
    return spark.createDataFrame(
        PRICES, "fuel_type STRING, price_before DOUBLE, price_after DOUBLE, effective_date DATE"
    )


def test_price_alerts_and_union(spark):
    got = {g["fuel_type"]: g for g in rows(alerts.price_alerts(prices(spark)))}
    assert {k: (v["pct_change"], v["severity"]) for k, v in got.items()} == {
        "F1": (32.11, "high"), "F2": (31.78, "high"), "F4": (5.0, "medium")
    }
    assert rows(alerts.price_policy(prices(spark)))[0]["fuel_type"] == "F4"
    for after, expected in ((10.0, 3), (10.01, 4)):
        rates = spark.createDataFrame(
            [("before", 5.0), ("after", after)], "period STRING, anomaly_rate_pct DOUBLE"
        )
        assert alerts.active_alerts(prices(spark), rates).count() == expected


def test_budget(spark):
    use = spark.createDataFrame(
        [(1, "F1", 5.0)], "consumer INT, fuel_type STRING, litres_per_day DOUBLE"
    )
    got = rows(alerts.budget_projection(use, prices(spark)))[0]
    assert (got["extra_daily"], got["extra_monthly"], got["extra_yearly"]) == (
        19750.0, 592500.0, 7208750.0
    )


def test_fresh_latest_and_series_range(spark):
    data = [
        ("traffic", "a", datetime(2026, 6, 1, 11, 59, 30), 1.0),
        ("traffic", "b", datetime(2026, 6, 1, 11, 59, 29), 2.0),
        ("cluster", "a", datetime(2026, 5, 31, 12, 0, 0), 3.0),
        ("cluster", "a", datetime(2026, 5, 31, 13, 0, 0), 4.0),
        ("cluster", "a", datetime(2026, 6, 1, 12, 0, 1), 5.0),
        ("other", "a", datetime(2026, 6, 1, 12, 0, 0), 6.0),
    ]
    df = spark.createDataFrame(data, "kind STRING, city STRING, ts TIMESTAMP, value DOUBLE")
    fresh = latest.fresh_latest(df, "2026-06-01 12:00:00", {"traffic": 30, "cluster": 86400})
    assert sorted(g["value"] for g in rows(fresh)) == [1.0, 4.0]
    points = df.withColumnRenamed("kind", "metric")
    kept = latest.series_range(points, "2026-06-01 12:00:00", "2026-05-31 12:00:00",
                               "2026-06-01 11:59:29")
    assert sorted(g["value"] for g in rows(kept)) == [2.0, 3.0, 4.0]


@pytest.mark.parametrize("missing", [True, False])
def test_forecast_placeholder(spark, missing):
    steps = spark.createDataFrame(
        [("a", 30, 0, T0)], "city STRING, horizon_minutes INT, predicted_level INT, predicted_at TIMESTAMP"
    )
    cities = spark.createDataFrame([("a",)] + ([("b",)] if missing else []), "city STRING")
    got = rows(serving.with_placeholder(serving.forecast_steps(steps, steps.where("false")), cities), "city")
    assert got[0]["mobility_score"] == 1.0 and len(got) == (2 if missing else 1)
    if missing:
        assert (got[1]["mobility_score"], got[1]["congestion_level"]) == (0.5, "Ramai Lancar")


def test_roll_ups_equal_the_direct_aggregates(spark):
    df = silver(
        spark,
        *[(c, "r", p, T0.replace(day=d, hour=h), 10.0 + d * h % 37, 20.0 + h)
          for c in ("a", "b") for p, days in (("before", (1, 2)), ("after", (10, 11)))
          for d in days for h in (3, 8, 20)],
    )
    cells = impact.reading_cells(df)
    direct = rows(impact.city_comparison(df), "city", "period")
    rolled = rows(impact.roll_up(cells, "city", "period"), "city", "period")
    for one, other in zip(direct, rolled):
        assert one["avg_congestion"] == pytest.approx(other["avg_congestion"])
        assert one["avg_speed"] == pytest.approx(other["avg_speed"])
        assert one["record_count"] == other["record_count"]
    for one, other in zip(
        rows(anomaly.baseline_stats(df), "city", "hour"),
        rows(anomaly.baseline_from_cells(cells), "city", "hour"),
    ):
        assert one["mu"] == pytest.approx(other["mu"]) and one["sigma"] == pytest.approx(other["sigma"])
