"""Multi-step mobility forecast per city.

One ridge regression per city over rows (time, step) replaces a model per step: the step is
an input.  The normal equations of all cities are sums of products in one aggregation; each
city's small system is then solved on its own row, so no city passes through the driver.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import SEQUENCE_FEATURES
from tidemark.functions import scores
from tidemark.operators.guards import Guarded, withheld
from tidemark.operators.sequences import chronological_split, recent_context
from tidemark.session import stage

# The solver travels by value: the workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ERRORS_SCHEMA = "city string, mae double, mse double, steps long"
STEPS_SCHEMA = "city string, step int, forecast_at timestamp, mobility_score double"
STEP_INPUTS = ("step", "step_sin", "step_cos")


def _names(features: Sequence[str]) -> list[str]:
    return [f"last_{f}" for f in features] + [f"mean_{f}" for f in features]


def _with_step(rows: DataFrame, step: Column, steps_per_day: int) -> DataFrame:
    """The step and the time of day it falls on, as a point on the daily circle."""
    day_share = F.col("last_time_of_day_norm") * 23 / 24 + step / steps_per_day
    turn = 2 * math.pi * day_share
    return rows.withColumns(
        {"step": step.cast("double"), "step_sin": F.sin(turn), "step_cos": F.cos(turn)}
    )


def training_rows(
    sequences: DataFrame, features: Sequence[str] = SEQUENCE_FEATURES, steps_per_day: int = 48
) -> DataFrame:
    """One row per sequence and future step: the last and mean past values, the target.

    Takes ``sequence_rows``, which have these values, or ``training_sequences``.
    """
    if "x" not in sequences.columns:
        rows = sequences.select(
            "city", "split", *_names(features), F.posexplode("y").alias("_at", "label")
        )
        return _with_step(rows, F.col("_at") + 1, steps_per_day).drop("_at")

    def mean_of(j: int) -> Column:
        total = F.aggregate("x", F.lit(0.0), lambda acc, row: acc + row[j])
        return total / F.size("x")

    last = F.element_at("x", -1)
    inputs = sequences.select(
        "city",
        "split",
        "y",
        *[last[j].alias(f"last_{f}") for j, f in enumerate(features)],
        *[mean_of(j).alias(f"mean_{f}") for j, f in enumerate(features)],
    )
    rows = inputs.select("*", F.posexplode("y").alias("_at", "label")).drop("y")
    return _with_step(rows, F.col("_at") + 1, steps_per_day).drop("_at")


def inputs_of(features: Sequence[str] = SEQUENCE_FEATURES) -> list[str]:
    """Inputs of the regression, the intercept first."""
    return ["one", *_names(features), *STEP_INPUTS]


def gram_sums(train: DataFrame, features: Sequence[str] = SEQUENCE_FEATURES) -> DataFrame:
    """(city, gram, moments) of :func:`training_rows`: per city the sums of products of every
    pair of inputs (row by row from the diagonal on) and of every input with the label."""
    x = [F.lit(1.0), *(F.col(c) for c in inputs_of(features)[1:])]
    products = [F.sum(x[i] * x[j]) for i in range(len(x)) for j in range(i, len(x))]
    moments = [F.sum(v * F.col("label")) for v in x]
    return train.groupBy("city").agg(
        F.array(*products).alias("gram"), F.array(*moments).alias("moments")
    )


def _solved(gram: np.ndarray, moments: np.ndarray, size: int, ridge: float) -> np.ndarray:
    """Weights of the ridge regression on standardised inputs, in the inputs' own units.

    An input that does not vary gets no weight.
    """
    a = np.zeros((size, size))
    a[np.triu_indices(size)] = gram
    a = a + np.triu(a, 1).T
    n, mean, label = a[0, 0], a[0, 1:] / a[0, 0], moments[0] / a[0, 0]
    spread = a[1:, 1:] / n - np.outer(mean, mean)
    deviation = np.sqrt(np.maximum(np.diag(spread), 0))
    varies = deviation > 1e-9 * (np.abs(mean) + 1)
    scale = np.where(varies, deviation, 1.0)
    together = (moments[1:] / n - mean * label) / scale
    system = (spread / np.outer(scale, scale))[np.ix_(varies, varies)]
    out = np.zeros(size)
    inner = np.zeros(size - 1)
    inner[varies] = np.linalg.solve(system + ridge * np.eye(int(varies.sum())), together[varies])
    out[1:] = inner / scale
    out[0] = label - out[1:] @ mean
    return out


def solve_cities(sums: DataFrame, size: int, ridge: float = 1e-3) -> DataFrame:
    """(city, weights) from :func:`gram_sums`, one small system a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            weights = [
                _solved(np.asarray(g, float), np.asarray(m, float), size, ridge)
                for g, m in zip(batch["gram"], batch["moments"])
            ]
            yield pd.DataFrame({"city": batch["city"], "weights": weights})

    return sums.mapInPandas(run, "city string, weights array<double>")


def fit_forecast(
    sequences: DataFrame, features: Sequence[str] = SEQUENCE_FEATURES, past: int = 48,
    future: int = 48, steps_per_day: int = 48, ridge: float = 1e-3,
) -> Guarded:
    """The weights per city (as the model, a stored frame) and their validation error (MAE, MSE).

    Trains on the first 80 percent of each city's sequences; withheld when no city
    has enough of them.
    """
    rows = training_rows(chronological_split(sequences, past, future), features, steps_per_day)
    sums = gram_sums(rows.where("split = 'train'"), features)
    weights = stage(solve_cities(sums, len(inputs_of(features)), ridge), "forecast-weights")
    if weights.isEmpty():
        return withheld(sequences.sparkSession, ERRORS_SCHEMA, "no city with enough sequences")
    scored = predicted(weights, rows.where("split = 'validation'"), features)
    error = F.col("mobility_score") - F.col("label")
    errors = scored.groupBy("city").agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.count("*").alias("steps"),
    )
    return Guarded(errors, weights)


def predicted(
    weights: DataFrame, rows: DataFrame, features: Sequence[str] = SEQUENCE_FEATURES
) -> DataFrame:
    """``rows`` of the cities that have weights, with ``mobility_score`` in [0, 1]."""
    x = [F.lit(1.0), *(F.col(c) for c in inputs_of(features)[1:])]
    total = sum((F.col("weights")[i] * v for i, v in enumerate(x)), F.lit(0.0))
    scored = rows.join(weights, "city").withColumn("mobility_score", scores.clamp(total, 0, 1))
    return scored.drop("weights")


def forecast_mobility(
    weights: DataFrame, inputs: DataFrame, features: Sequence[str] = SEQUENCE_FEATURES,
    past: int = 48, future: int = 48, steps_per_day: int = 48,
) -> DataFrame:
    """The next ``future`` steps of every city with weights and ``past`` recent rows."""
    recent = recent_context(inputs, past).fillna(0.0, subset=list(features))
    values = [F.col(f).cast("double") for f in features]
    latest = F.max_by(F.array(*values), "window_start")
    context = recent.groupBy("city").agg(
        F.max("window_start").alias("last_at"),
        latest.alias("_last"),
        *[F.avg(v).alias(f"mean_{f}") for v, f in zip(values, features)],
    )
    rows = context.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(future))).alias("_step")
    ).withColumns({f"last_{f}": F.col("_last")[j] for j, f in enumerate(features)})
    scored = predicted(weights, _with_step(rows, F.col("_step"), steps_per_day), features)
    ahead = F.make_dt_interval(secs=F.col("_step") * (86_400 // steps_per_day))
    return scored.select(
        "city",
        F.col("_step").alias("step"),
        (F.col("last_at") + ahead).alias("forecast_at"),
        scores.half_up(F.col("mobility_score"), 4).alias("mobility_score"),
    )
