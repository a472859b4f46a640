"""Congestion classifier and the half-hour and one-hour forecast."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import CLASSIFIER_FEATURES, ImpactSettings
from tidemark.functions import bands, scores
from tidemark.operators.cleaning import add_calendar
from tidemark.operators.guards import Guarded, at_least, withheld

# The published model name and the assumed speeds.
MODEL_NAME = "RandomForest_Congestion"
# Assumed share of the present mean speed at each horizon (minutes).
SPEED_SHARE = {30: 1.0, 60: 0.95}


METRICS_SCHEMA = (
    "model_name string, metric_name string, metric_value double, train_rows long, test_rows long, "
    "dropped_rows long"
)
FORECAST_SCHEMA = (
    "city string, horizon_minutes int, predicted_level int, predicted_label string, "
    "current_avg_speed double, predicted_at timestamp"
)


def mark_split(
    silver: DataFrame, seed: int = 42, share: float = 0.8, chronological: bool = False
) -> DataFrame:
    """Mark training rows.

    The random split is a function of the reading's key, so a recomputed task
    puts every row on the same side again.  The chronological one trains on the
    readings before the ``share`` quantile of time.
    """
    if chronological:
        seconds = F.unix_timestamp("recorded_at")
        cut = silver.agg(F.percentile_approx(seconds, share).alias("cut")).first()["cut"]
        return silver.withColumn("is_train", seconds < F.lit(cut))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "city", "road_name", "recorded_at"), F.lit(10_000))
    return silver.withColumn("is_train", bucket < int(share * 10_000))


def _complete():
    """Whether a reading has all features of the classifier."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in CLASSIFIER_FEATURES])


def fit_classifier(
    silver: DataFrame, settings: ImpactSettings = ImpactSettings(), chronological: bool = False
) -> Guarded:
    """The fitted forest with the frame of its metrics; withheld with too few readings.

    Readings without one of the features cannot be classified; they are left out
    of training and test and counted as ``dropped_rows``.
    """
    if not at_least(silver.where(_complete()), settings.min_classifier_rows):
        reason = f"fewer than {settings.min_classifier_rows} complete readings"
        return withheld(silver.sparkSession, METRICS_SCHEMA, reason)
    marked = mark_split(silver, settings.seed, chronological=chronological).select(
        *CLASSIFIER_FEATURES, F.col("congestion_level").cast("double").alias("label"), "is_train"
    )
    rows = marked.where(_complete())
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=settings.trees, seed=settings.seed
    )
    assembler = VectorAssembler(
        inputCols=list(CLASSIFIER_FEATURES), outputCol="features", handleInvalid="error"
    )
    model = Pipeline(stages=[assembler, forest]).fit(rows.where("is_train"))
    counts = marked.agg(
        F.count_if(F.col("is_train") & _complete()).alias("train_rows"),
        F.count_if(~_complete()).alias("dropped_rows"),
    )
    return Guarded(metrics(model.transform(rows.where(~F.col("is_train"))), counts), model)


def metrics(predictions: DataFrame, counts: DataFrame) -> DataFrame:
    """Accuracy and weighted F1 from one confusion table (at most 4 x 4 rows)."""
    confusion = predictions.groupBy("label", "prediction").agg(F.count("*").alias("n"))
    sides = confusion.select(
        "n",
        F.explode(
            F.array(
                F.struct(F.col("label").alias("level"), F.lit("actual").alias("side")),
                F.struct(F.col("prediction").alias("level"), F.lit("predicted").alias("side")),
            )
        ).alias("s"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
    )
    actual, predicted = F.col("s.side") == "actual", F.col("s.side") == "predicted"
    levels = sides.groupBy("s.level").agg(
        F.sum(F.when(actual, F.col("n")).otherwise(0)).alias("actual"),
        F.sum(F.when(predicted, F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(actual, F.col("hit")).otherwise(0)).alias("hits"),
    )
    # F1 = 2 TP / (actual + predicted), weighted by the actual rows.
    f1 = F.try_divide(2.0 * F.col("hits"), F.col("actual") + F.col("predicted"))
    total = levels.agg(
        F.try_divide(F.sum("hits"), F.sum("actual")).alias("accuracy"),
        F.try_divide(F.sum(f1 * F.col("actual")), F.sum("actual")).alias("f1"),
        F.sum("actual").alias("test_rows"),
    )
    both = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("metric_name"), F.col(name).alias("metric_value"))
                for name in ("accuracy", "f1")
            ]
        )
    )
    # Both frames are single rows; put together by an aggregate, there is nothing to join.
    both_rows = total.unionByName(counts, allowMissingColumns=True)
    joined = both_rows.agg(*[F.max(c).alias(c) for c in both_rows.columns])
    return joined.select("train_rows", "test_rows", "dropped_rows", both.alias("m")).select(
        F.lit(MODEL_NAME).alias("model_name"),
        "m.metric_name",
        scores.half_up(F.col("m.metric_value"), 4).alias("metric_value"),
        "train_rows",
        F.coalesce("test_rows", F.lit(0)).alias("test_rows"),
        "dropped_rows",
    )


def speed_means(silver: DataFrame) -> DataFrame:
    """(city, mean_speed, free_flow_speed) of the readings."""
    return silver.groupBy("city").agg(
        F.avg("current_speed").alias("mean_speed"), F.avg("free_flow_speed").alias("free_flow_speed")
    )


def forecast(
    model: PipelineModel | None,
    means: DataFrame,
    as_of: str,
    current: DataFrame | None = None,
    speed_share: Mapping[int, float] = SPEED_SHARE,
) -> DataFrame:
    """Predicted level per city and horizon, in one frame; empty without a model.

    ``means`` are :func:`speed_means`.  Calendar inputs belong to ``as_of`` plus the
    horizon.  ``current`` (city, current_congestion, change_pct) fills the columns
    that describe the present.
    """
    if model is None:
        nothing = means.sparkSession.createDataFrame([], FORECAST_SCHEMA)
        return _with_current(nothing, current)
    steps = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("horizon_minutes"), F.lit(float(s)).alias("share"))
                for m, s in speed_share.items()
            ]
        )
    )
    now = F.lit(as_of).cast("timestamp")
    scenario = means.select("*", steps.alias("step")).select(
        "city",
        "step.horizon_minutes",
        F.col("mean_speed").alias("current_avg_speed"),
        (F.col("mean_speed") * F.col("step.share")).alias("current_speed"),
        "free_flow_speed",
        (now + F.make_dt_interval(mins=F.col("step.horizon_minutes"))).alias("target_at"),
    )
    # A city without any free-flow speed has no forecast.
    predicted = model.transform(add_calendar(scenario, "target_at").where(_complete()))
    level = F.col("prediction").cast("int")
    result = predicted.select(
        "city",
        "horizon_minutes",
        level.alias("predicted_level"),
        bands.level_label(level).alias("predicted_label"),
        scores.half_up(F.col("current_avg_speed"), 1).alias("current_avg_speed"),
        now.alias("predicted_at"),
    )
    return _with_current(result, current)


def _with_current(result: DataFrame, current: DataFrame | None) -> DataFrame:
    if current is None:
        return result
    return result.join(current.select("city", "current_congestion", "change_pct"), "city", "left")


def forecast_by_city(predictions: DataFrame) -> DataFrame:
    """Both horizons side by side, one row per city."""

    def at(minutes: int, name: str):
        return F.max(F.when(F.col("horizon_minutes") == minutes, F.col(name)))

    return predictions.groupBy("city").agg(
        F.max("current_avg_speed").alias("current_avg_speed"),
        at(30, "predicted_level").alias("predicted_30m"),
        at(30, "predicted_label").alias("predicted_30m_label"),
        at(60, "predicted_level").alias("predicted_60m"),
        at(60, "predicted_label").alias("predicted_60m_label"),
        F.max("predicted_at").alias("updated_at"),
    )
