"""Overall, sliding and lagged Pearson correlation per city and pair."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import CORRELATION_PAIRS
from tidemark.functions import bands, scores, stats
from tidemark.operators.ordered import block_window, with_halo, with_positions

SERIES = ("city",)


def _present(features: DataFrame, pairs) -> list[tuple[str, str, str]]:
    have = set(features.columns)
    return [p for p in pairs if p[0] in have and p[1] in have]


def _pair_rows(pairs: Sequence[tuple[str, str, str]]) -> Column:
    """One struct (pair, x, y) per pair, to explode in place."""
    return F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("pair"),
                    F.col(x).cast("double").alias("x"),
                    F.col(y).cast("double").alias("y"),
                )
                for x, y, name in pairs
            ]
        )
    )


def _significant(p: str) -> Column:
    return F.coalesce(F.col(p) < 0.05, F.lit(False))


def overall_correlation(features: DataFrame, pairs=CORRELATION_PAIRS) -> DataFrame:
    """r, p and labels per city and pair over the pairwise complete rows."""
    rows = features.select("city", _pair_rows(_present(features, pairs)).alias("v"))
    moments = rows.select("city", "v.*").groupBy("city", "pair").agg(
        *stats.paired_moments(F.col("x"), F.col("y"))
    )
    scored = moments.withColumn("r", stats.pearson_r()).withColumn(
        "p_value", stats.pearson_p(F.col("r"), F.col("n"))
    )
    return scored.select(
        "city",
        "pair",
        "n",
        F.col("r").alias("pearson_r"),
        "p_value",
        _significant("p_value").alias("significant"),
        bands.direction("r").alias("direction"),
        bands.strength("r").alias("strength"),
    )


def sliding_correlation(
    features: DataFrame, window: int = 48, step: int = 6, pairs=CORRELATION_PAIRS,
    min_pairs: int = 3,
) -> DataFrame:
    """r over every ``window`` rows, moving by ``step``; the series end is left out.

    Rows are first reduced to centred co-moments of blocks of gcd(window, step) rows and
    the windows are put together from whole blocks, so a row is read once, not once
    per window, and no task holds a series.
    """
    block_rows = math.gcd(window, step)
    per_window = window // block_rows
    pairs = _present(features, pairs)
    placed = with_positions(features, SERIES, "window_start").withColumn("block", F.floor(F.col("pos") / block_rows))
    # The pairs of a block are aggregated side by side; only their few results become rows.
    by_pair = F.array(*[F.struct(F.lit(name).alias("pair"), F.col(f"_m{i}").alias("m")) for i, (*_, name) in enumerate(pairs)])
    blocks = (
        placed.groupBy("city", "n", "block")
        .agg(
            F.max("window_start").alias("last_at"),
            *[
                stats.centred_moments(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"_m{i}")
                for i, (x, y, _) in enumerate(pairs)
            ],
        )
        .select("city", "n", "block", "last_at", by_pair.alias("of_pair"))
    )
    # A block ends between 1 and per_window windows; keep those on the step grid.
    window_end = (F.col("block") + F.col("ahead")) * block_rows
    members = (
        blocks.withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(per_window))))
        .withColumn("window_end", window_end)
        .where(
            (F.col("window_end") >= window)
            & (F.col("window_end") < F.col("n"))
            & ((F.col("window_end") - window) % step == 0)
        )
    )
    # ``per_window`` blocks make a window, in the order of the series.
    windows = members.groupBy("city", "window_end").agg(
        F.max("last_at").alias("window_end_at"),
        F.array_sort(F.collect_list(F.struct("block", "of_pair"))).alias("parts"),
    )
    merged = windows.select(
        "city", "window_end", "window_end_at",
        F.posexplode(F.col("parts")[0]["of_pair"]["pair"]).alias("_i", "pair"), "parts",
    ).withColumn(
        "m", stats.merged_moments(F.transform("parts", lambda p: p["of_pair"][F.col("_i")]["m"]))
    )
    scored = (
        merged.select("city", "pair", "window_end", "window_end_at", F.col("m.k").cast("long").alias("k"), stats.centred_r(F.col("m")).alias("r_raw"))
        .where(F.col("k") >= min_pairs)
        .withColumn("p_raw", stats.pearson_p(F.col("r_raw"), F.col("k")))
    )
    return scored.select(
        "city",
        "pair",
        "window_end",
        "window_end_at",
        scores.half_up(F.col("r_raw"), 4).alias("r"),
        scores.half_up(F.col("p_raw"), 6).alias("p_value"),
        _significant("p_raw").alias("significant"),
        F.col("k").alias("n"),
    )


def lagged_correlation(
    features: DataFrame, max_lag: int = 12, pairs=CORRELATION_PAIRS, min_pairs: int = 10,
    step_hours: float = 0.5,
) -> DataFrame:
    """r between x at a row and y ``lag`` rows later, for every lag up to ``max_lag``.

    The later values come from ``lead`` inside position blocks, so there is no
    self-join; lags are exploded right before an aggregation that combines
    map-side, so the extra rows never reach the shuffle.
    """
    pairs = _present(features, pairs)
    names = sorted({name for p in pairs for name in p[:2]})
    placed = with_halo(
        with_positions(features.select("city", "window_start", *names), SERIES, "window_start"),
        before=0,
        after=max_lag,
    )
    ahead = block_window(SERIES)
    targets = sorted({p[1] for p in pairs})
    steps = F.array(
        *[
            F.struct(
                F.lit(lag).alias("lag_steps"),
                *[F.lead(y, lag).over(ahead).alias(y) for y in targets],
            )
            for lag in range(max_lag + 1)
        ]
    )
    rows = (
        placed.withColumn("_steps", steps)
        .where("owned")
        .select("city", *{p[0] for p in pairs}, F.explode("_steps").alias("_later"))
    )
    # The pairs of a lag are aggregated side by side; only their few results become rows.
    of_pair = [
        F.struct(
            *stats.paired_moments(F.col(x).cast("double"), F.col(f"_later.{y}").cast("double"))
        ).alias(f"_m{i}")
        for i, (x, y, _) in enumerate(pairs)
    ]
    results = F.array(
        *[F.struct(F.lit(name).alias("pair"), F.col(f"_m{i}").alias("m")) for i, (*_, name) in enumerate(pairs)]
    )
    moments = (
        rows.groupBy("city", F.col("_later.lag_steps").alias("lag_steps"))
        .agg(*of_pair)
        .select("city", "lag_steps", F.explode(results).alias("_r"))
        .select("city", "lag_steps", "_r.pair", "_r.m.*")
    )
    scored = (
        moments.where(F.col("n") >= min_pairs)
        .withColumn("r_raw", stats.pearson_r())
        .withColumn("p_raw", stats.pearson_p(F.col("r_raw"), F.col("n")))
    )
    return scored.select(
        "city",
        "pair",
        "lag_steps",
        (F.col("lag_steps") * step_hours).alias("lag_hours"),
        scores.half_up(F.col("r_raw"), 4).alias("r"),
        scores.half_up(F.col("p_raw"), 6).alias("p_value"),
        _significant("p_raw").alias("significant"),
        "n",
    )


def best_lag(lags: DataFrame) -> DataFrame:
    """The lag with the largest absolute r per city and pair; the shortest on a tie."""
    rank = F.struct(F.abs("r").alias("size"), (-F.col("lag_steps")).alias("nearness"))
    chosen = F.max_by(F.struct("lag_steps", "lag_hours", "r"), rank)
    return lags.groupBy("city", "pair").agg(chosen.alias("best")).select(
        "city",
        "pair",
        F.col("best.lag_steps").alias("best_lag_steps"),
        F.col("best.lag_hours").alias("best_lag_hours"),
        F.col("best.r").alias("best_lag_r"),
    )


def correlation_report(overall: DataFrame, lags: DataFrame) -> DataFrame:
    """Overall correlation with the best lag; without any lag the overall r stands."""
    return (
        overall.join(best_lag(lags), ["city", "pair"], "left")
        .withColumn("best_lag_hours", F.coalesce("best_lag_hours", F.lit(0.0)))
        .withColumn("best_lag_r", F.coalesce("best_lag_r", "pearson_r"))
        .drop("best_lag_steps", "n")
    )
