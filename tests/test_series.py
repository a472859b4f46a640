"""Positions, correlation, sequences and features against brute force."""

import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import stats
from tidemark.operators import correlation, features, ordered, sequences

START = datetime(2026, 1, 20)
PAIRS = (("x", "y", "pair"),)


def series(spark, **cities):
    data = []
    for city, (xs, ys) in cities.items():
        for k, (x, y) in enumerate(zip(xs, ys)):
            data.append((city, START + timedelta(minutes=30 * k), x, y))
    return spark.createDataFrame(data, "city STRING, window_start TIMESTAMP, x DOUBLE, y DOUBLE")


def noise(n, seed):
    return np.random.default_rng(seed).normal(size=n).tolist()


def pearson(x, y):
    keep = [(a, b) for a, b in zip(x, y) if a is not None and b is not None]
    a, b = np.array(keep, dtype=float).T
    return float(np.corrcoef(a, b)[0, 1]), len(keep)


def t_tail(r, n):
    """Two-sided p by numeric integration of the Student-t density."""
    v = n - 2
    t = abs(r) * math.sqrt(v / (1 - r * r))
    c = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
    grid = np.linspace(0, t, 200_001)
    density = c * (1 + grid**2 / v) ** (-(v + 1) / 2)
    return 1 - 2 * float(np.trapezoid(density, grid))


@pytest.mark.parametrize("n", [3, 4, 10, 47, 48, 201, 202, 203, 204, 500, 2000, 100_000])
def test_p_value(spark, n):
    scale = 1 / math.sqrt(n)
    rs = sorted({round(min(0.99, k * scale), 6) for k in (0.0, 0.1, 0.5, 1.0, 1.7, 2.0, 3.0, 5.0)})
    df = spark.createDataFrame([(r, n) for r in rs], "r DOUBLE, n LONG")
    got = [x.p for x in df.select(stats.pearson_p(F.col("r"), F.col("n")).alias("p")).collect()]
    for r, p in zip(rs, got):
        assert p == pytest.approx(t_tail(r, n), abs=1e-8)


def test_p_value_edges(spark):
    df = spark.createDataFrame([(0.5, 2), (1.0, 10), (None, 10), (0.9, 10**9)], "r DOUBLE, n LONG")
    got = [x.p for x in df.select(stats.pearson_p(F.col("r"), F.col("n")).alias("p")).collect()]
    assert got == [1.0, 0.0, None, 0.0]


def test_positions_match_a_plain_ranking(spark):
    df = series(spark, a=(noise(2000, 1), noise(2000, 2)), b=(noise(5, 3), noise(5, 4)))
    placed = rows(ordered.with_positions(df, ("city",), "window_start", "week"), "city", "window_start")
    assert [p["pos"] for p in placed] == list(range(2000)) + list(range(5))
    assert {p["n"] for p in placed[:2000]} == {2000} and placed[-1]["n"] == 5


def test_halo_has_every_neighbour(spark):
    df = series(spark, a=([float(k) for k in range(50)], noise(50, 1)))
    placed = ordered.with_halo(
        ordered.with_positions(df, ("city",), "window_start"), before=3, after=2, block_rows=7
    )
    w = ordered.block_window(("city",))
    out = placed.withColumn("near", F.collect_list("x").over(w.rowsBetween(-3, 2))).where("owned")
    got = rows(out, "pos")
    assert len(got) == 50
    for g in got:
        p = g["pos"]
        assert g["near"] == [float(k) for k in range(max(0, p - 3), min(50, p + 3))]


def test_overall_correlation_pairwise_complete(spark):
    x, y = noise(30, 1), noise(30, 2)
    x[3] = y[7] = None
    y[9] = math.nan
    df = series(spark, a=(x, y), short=([1.0, 2.0], [1.0, 2.0]), flat=([1.0] * 5, noise(5, 3)))
    got = {g["city"]: g for g in rows(correlation.overall_correlation(df, PAIRS))}
    y[9] = None
    r, n = pearson(x, y)
    assert got["a"]["n"] == n == 27 and got["a"]["pearson_r"] == pytest.approx(r)
    assert (got["short"]["pearson_r"], got["short"]["p_value"]) == (0.0, 1.0)
    flat = got["flat"]
    assert flat["pearson_r"] is None and flat["p_value"] is None and flat["significant"] is False
    assert (flat["direction"], flat["strength"]) == ("positive", "negligible")


def test_correlation_ignores_positive_affine_maps(spark):
    x, y = noise(60, 5), noise(60, 6)
    moved = ([3 * v + 100 for v in x], [0.5 * v - 7 for v in y])
    got = rows(correlation.overall_correlation(series(spark, a=(x, y), b=moved), PAIRS), "city")
    assert got[0]["pearson_r"] == pytest.approx(got[1]["pearson_r"])


@pytest.mark.parametrize("window,step", [(48, 6), (10, 4), (9, 3), (5, 7)])
def test_sliding_against_brute_force(spark, window, step):
    data = {}
    for n in (47, 48, 49, 54, 55, 120):
        x, y = noise(n, n), noise(n, n + 1)
        for k in range(0, n, 11):
            x[k] = None
        data[f"n{n}"] = (x, y)
    got = rows(correlation.sliding_correlation(series(spark, **data), window, step, PAIRS))
    found = {(g["city"], g["window_end"]): g for g in got}
    expected = 0
    for city, (x, y) in data.items():
        for i in range(window, len(x), step):
            r, n = pearson(x[i - window:i], y[i - window:i])
            g = found[city, i]
            assert g["n"] == n and g["r"] == pytest.approx(r, abs=6e-5)
            assert g["p_value"] == pytest.approx(t_tail(r, n), abs=2e-6)
            assert g["window_end_at"] == START + timedelta(minutes=30 * (i - 1))
            expected += 1
    assert len(found) == expected


@pytest.mark.parametrize("offset,spread", [(0.0, 1.0), (16_250.0, 0.001), (1e6, 0.1), (1e6, 0.01)])
def test_sliding_far_from_zero(spark, offset, spread):
    """Values large against their deviation, as prices are: four digits of a two-pass result."""
    base, other = noise(60, 3), noise(60, 4)
    x = [offset + spread * v for v in base]
    y = [offset + spread * (0.7 * v + 0.6 * w) for v, w in zip(base, other)]
    got = rows(correlation.sliding_correlation(series(spark, a=(x, y)), pairs=PAIRS), "window_end")
    assert [g["window_end"] for g in got] == [48, 54]
    for g in got:
        i = g["window_end"]
        a, b = (np.array(v[i - 48:i]) - offset for v in (x, y))
        r = float(np.corrcoef(a - a.mean(), b - b.mean())[0, 1])
        assert g["r"] == pytest.approx(r, abs=6e-5)


def test_sliding_constant_side(spark):
    got = rows(correlation.sliding_correlation(series(spark, a=([0.1] * 60, noise(60, 1))), pairs=PAIRS))
    assert got and all(g["r"] is None and g["significant"] is False for g in got)


def test_lag_against_brute_force(spark):
    x = noise(200, 7)
    y = [None] * 4 + [-v for v in x[:-4]]
    df = series(spark, a=(x, y), tiny=(noise(12, 1), noise(12, 2)), small=(noise(9, 1), noise(9, 2)))
    lags = correlation.lagged_correlation(df, pairs=PAIRS)
    got = {(g["city"], g["lag_steps"]): g for g in rows(lags)}
    for lag in range(13):
        r, n = pearson(x[:200 - lag], y[lag:])
        assert got["a", lag]["n"] == n and got["a", lag]["r"] == pytest.approx(r, abs=6e-5)
    assert sorted(k for c, k in got if c == "tiny") == [0, 1, 2]
    assert not any(c == "small" for c, _ in got)
    best = {g["city"]: g for g in rows(correlation.best_lag(lags))}
    assert (best["a"]["best_lag_steps"], best["a"]["best_lag_hours"], best["a"]["best_lag_r"]) == (
        4, 2.0, -1.0
    )
    report = {g["city"]: g for g in rows(correlation.correlation_report(
        correlation.overall_correlation(df, PAIRS), lags))}
    assert report["small"]["best_lag_hours"] == 0.0
    assert report["small"]["best_lag_r"] == report["small"]["pearson_r"]


def test_absent_column_skips_the_pair(spark):
    df = series(spark, a=(noise(20, 1), noise(20, 2)))
    got = correlation.overall_correlation(df, (*PAIRS, ("x", "missing", "other")))
    assert [g["pair"] for g in rows(got)] == ["pair"]


@pytest.mark.parametrize("n", [95, 96, 97, 98, 130])
def test_sequences(spark, n):
    df = series(spark, a=([float(k) for k in range(n)], [float(-k) for k in range(n)]))
    got = rows(sequences.training_sequences(df, names=["x"], target="y"), "pos")
    assert [g["pos"] for g in got] == list(range(48, n - 48))
    for g in got:
        i = g["pos"]
        assert [v[0] for v in g["x"]] == [float(k) for k in range(i - 48, i)]
        assert g["y"] == [float(-k) for k in range(i, i + 48)]


def test_chronological_split(spark):
    def one(n):
        return ([float(k) for k in range(n)], [0.0] * n)

    df = series(spark, enough=one(106), short=one(105))
    built = sequences.training_sequences(df, names=["x"], target="y")
    got = rows(sequences.chronological_split(built), "pos")
    assert {g["city"] for g in got} == {"enough"}
    assert [g["split"] for g in got] == ["train"] * 8 + ["validation"] * 2


def test_recent_context(spark):
    df = series(spark, full=(noise(60, 1), noise(60, 2)), short=(noise(47, 1), noise(47, 2)))
    got = rows(sequences.recent_context(df), "window_start")
    assert len(got) == 48 and {g["city"] for g in got} == {"full"}
    assert got[0]["window_start"] == START + timedelta(minutes=30 * 12)


def test_price_delta_edges(spark):
    data = [("a", "F", START + timedelta(minutes=5 * k), p)
            for k, p in enumerate([100.0, 110.0, 0.0, 50.0, None, 60.0])]
    df = spark.createDataFrame(data, "city STRING, fuel_type STRING, window_start TIMESTAMP, avg_price DOUBLE")
    got = [g["fuel_price_delta"] for g in rows(features.price_delta(df), "window_start")]
    assert got[:4] == [0.0, pytest.approx(10.0), -100.0, 0.0] and got[4] is None and got[5] == 0.0


def window_tables(spark):
    w = "TIMESTAMP '2026-01-01 07:00:00'"
    fuel = spark.sql(f"SELECT 'a' AS city, 'Pertamax' AS fuel_type, {w} AS window_start, 12000D AS avg_price")
    traffic = spark.sql(f"SELECT 'a' AS city, {w} AS window_start, 30D AS avg_congestion, 40D AS avg_speed, 70D AS avg_mobility_index")
    weather = spark.sql(f"SELECT 'a' AS city, {w} AS window_start, 80D AS avg_weather_score, 30D AS avg_temperature, 0D AS avg_rain_1h")
    transport = spark.sql(f"SELECT 'a' AS city, {w} AS window_start, 25000L AS total_ridership, 50D AS avg_load_factor")
    return fuel, traffic, weather, transport


def test_feature_row(spark):
    tables = window_tables(spark)
    got = rows(features.assemble_features(*tables, features.holiday_frame(spark), "Pertamax"))[0]
    # 0.4 * 0.7 + 0.3 * 0.8 + 0.2 * 0.5 + 0.1
    assert got["mobility_composite"] == 0.72
    assert (got["time_of_day"], got["day_of_week"], got["holiday_flag"]) == (7, 4, 1)
    fuel, traffic, weather, transport = tables
    for policy, composite, norm in (("observed", 0.82, 1.0), ("propagate", None, 0.0)):
        bare = features.assemble_features(
            fuel, traffic, weather, transport.where("false"),
            features.holiday_frame(spark, [date(2026, 1, 2)]), "Pertamax", null_policy=policy,
        )
        row = rows(bare)[0]
        assert (row["mobility_composite"], row["transport_usage_norm"]) == (composite, norm)
        assert row["avg_load_factor"] is None and row["holiday_flag"] == 0


def test_resample(spark):
    df = series(spark, a=([1.0, 3.0, 5.0], [0.0] * 3))
    got = rows(features.resample(df, "1 hour", ["x"]), "window_start")
    assert [g["x"] for g in got] == [2.0, 5.0]
