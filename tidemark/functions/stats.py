"""Pearson correlation and its two-sided p-value as Spark expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many degrees of freedom the finite series is used.
_SERIES_LIMIT = 200
# Continued-fraction steps beyond it (converges long before).
_FRACTION_STEPS = 120
_TINY = 1e-300


def paired_moments(x: Column, y: Column) -> list[Column]:
    """Aggregates over the rows where both values exist; all combine map-side."""
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    px, py = F.when(both, x), F.when(both, y)
    return [
        F.count(px).alias("n"),
        F.covar_pop(px, py).alias("cov_xy"),
        F.stddev_pop(px).alias("sd_x"),
        F.stddev_pop(py).alias("sd_y"),
        ((F.min(px) < F.max(px)) & (F.min(py) < F.max(py))).alias("varies"),
    ]


# Co-moments about the mean, of a block of pairs.
_CENTRED = ("k", "mean_x", "mean_y", "m2_x", "m2_y", "c_xy")


def centred_moments(x: Column, y: Column) -> Column:
    """Aggregate to a struct of the pairs where both values exist: their number, means, squared
    distances from the means and products of distances, with the range of both sides."""
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    px, py = F.when(both, x), F.when(both, y)
    k = F.count(px)
    values = (k.cast("double"), F.avg(px), F.avg(py), F.var_pop(px) * k, F.var_pop(py) * k, F.covar_pop(px, py) * k)
    return F.struct(
        *(F.coalesce(v, F.lit(0.0)).alias(name) for v, name in zip(values, _CENTRED, strict=True)),
        F.min(px).alias("low_x"), F.max(px).alias("high_x"), F.min(py).alias("low_y"), F.max(py).alias("high_y"),
    )


def merged_moments(blocks: Column) -> Column:
    """One :func:`centred_moments` struct for an array of them, combined pairwise.

    Blocks are put together by the distance of their means, so nothing is lost where
    values are large against their deviation.
    """

    def merge(a: Column, b: Column) -> Column:
        n = a["k"] + b["k"]
        share = F.when(n > 0, b["k"] / n).otherwise(F.lit(0.0))
        dx, dy, weight = b["mean_x"] - a["mean_x"], b["mean_y"] - a["mean_y"], a["k"] * share
        values = (
            n, a["mean_x"] + dx * share, a["mean_y"] + dy * share,
            a["m2_x"] + b["m2_x"] + dx * dx * weight,
            a["m2_y"] + b["m2_y"] + dy * dy * weight,
            a["c_xy"] + b["c_xy"] + dx * dy * weight,
        )
        return F.struct(
            *(v.alias(name) for v, name in zip(values, _CENTRED, strict=True)),
            F.least(a["low_x"], b["low_x"]).alias("low_x"), F.greatest(a["high_x"], b["high_x"]).alias("high_x"),
            F.least(a["low_y"], b["low_y"]).alias("low_y"), F.greatest(a["high_y"], b["high_y"]).alias("high_y"),
        )

    return F.aggregate(F.slice(blocks, 2, F.size(blocks)), blocks[0], merge)


def centred_r(moments: Column) -> Column:
    """r of a :func:`centred_moments` struct; a constant side gives null."""
    varies = (moments["low_x"] < moments["high_x"]) & (moments["low_y"] < moments["high_y"])
    r = F.try_divide(moments["c_xy"], F.sqrt(moments["m2_x"]) * F.sqrt(moments["m2_y"]))
    return F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def pearson_r() -> Column:
    """r from the columns of :func:`paired_moments`.

    Fewer than three pairs give 0; a constant side gives null.
    """
    r = F.try_divide(F.col("cov_xy"), F.col("sd_x") * F.col("sd_y"))
    return F.when(F.col("n") < 3, 0.0).when(
        F.col("varies"), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))
    )


def _t_series(r: Column, dof: Column) -> Column:
    """Student-t tail by its finite series for whole degrees of freedom
    (Abramowitz & Stegun 26.7.3-4)."""
    odd = dof % 2
    terms = F.floor((dof - odd) / 2).cast("int")
    cos2 = 1 - r * r
    steps = F.when(terms > 0, F.sequence(F.lit(0), terms - 1)).otherwise(
        F.array().cast("array<int>")
    )
    first = F.when(odd == 1, F.sqrt(cos2)).otherwise(1.0)
    total = F.aggregate(
        steps,
        F.struct(first.alias("term"), F.lit(0.0).alias("sum")),
        lambda acc, k: F.struct(
            (acc["term"] * cos2 * (2 * k + 1 + odd) / (2 * k + 2 + odd)).alias("term"),
            (acc["sum"] + acc["term"]).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    size = F.abs(r)
    inside = F.when(odd == 1, 2 / math.pi * (F.asin(size) + size * total)).otherwise(size * total)
    return 1 - inside


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, forward evaluation."""

    def away_from_zero(value: Column) -> Column:
        return F.when(F.abs(value) < _TINY, _TINY).otherwise(value)

    def advance(acc: Column, part: Column) -> tuple[Column, Column, Column]:
        den = 1 / away_from_zero(1 + part * acc["den"])
        num = away_from_zero(1 + part / acc["num"])
        return num, den, acc["value"] * num * den

    def state(num: Column, den: Column, value: Column) -> Column:
        return F.struct(num.alias("num"), den.alias("den"), value.alias("value"))

    def even_step(acc: Column, m: Column) -> Column:
        part = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        return state(*advance(acc, part))

    def odd_step(acc: Column, m: Column) -> Column:
        part = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return state(*advance(acc, part))

    start = 1 / away_from_zero(1 - (a + b) * x / (a + 1))
    # Each half step is its own fold element: even elements then odd ones.
    halves = F.sequence(F.lit(2), F.lit(2 * _FRACTION_STEPS + 1))
    return F.aggregate(
        halves,
        state(F.lit(1.0), start, start),
        lambda acc, h: F.when(h % 2 == 0, even_step(acc, (h / 2).cast("double"))).otherwise(
            odd_step(acc, ((h - 1) / 2).cast("double"))
        ),
        lambda acc: acc["value"],
    )


def _t_fraction(r: Column, dof: Column) -> Column:
    """Student-t tail for many degrees of freedom: I_x(dof/2, 1/2), x = 1 - r^2."""
    a, half = dof / 2, F.lit(0.5)
    x, y = 1 - r * r, r * r
    # Gamma(a + 1/2) / Gamma(a) for large a.
    ratio = F.sqrt(a) * (
        1 - 1 / (8 * a) + 1 / (128 * F.pow(a, 2)) + 5 / (1024 * F.pow(a, 3))
        - 21 / (32768 * F.pow(a, 4)) - 399 / (262144 * F.pow(a, 5))
    )
    front = F.exp(a * F.log1p(-y)) * F.abs(r) * ratio / math.sqrt(math.pi)
    near = front * _beta_fraction(a, half, x) / a
    far = 1 - front * _beta_fraction(half, a, y) / 0.5
    return F.when(x < (a + 1) / (a + 2.5), near).otherwise(far)


def pearson_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of r over n pairs; null r gives null, n < 3 gives 1."""
    dof = (n - 2).cast("double")
    tail = F.when(dof <= _SERIES_LIMIT, _t_series(r, dof)).otherwise(_t_fraction(r, dof))
    return (
        F.when(n < 3, 1.0)
        .when(F.abs(r) >= 1, 0.0)
        .when(r.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))
    )
