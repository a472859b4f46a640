"""Impact clusters of roads and of cities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from tidemark.config import CITY_CLUSTER_FEATURES, IMPACT_CODES, ZONE_LABELS
from tidemark.operators.guards import Guarded, withheld


def _ranked(clustered: DataFrame, cluster: str, value: str, descending: bool) -> DataFrame:
    """Clusters with ``place`` (0 first) and ``clusters``; one row per cluster id."""
    means = clustered.groupBy(cluster).agg(F.avg(value).alias("_mean"))
    key = F.col("_mean").desc() if descending else F.col("_mean")
    # A handful of rows: the number of clusters is fixed by k.
    order = Window.partitionBy().orderBy(key, cluster)
    return means.select(
        cluster,
        (F.row_number().over(order) - 1).alias("place"),
        F.count("*").over(Window.partitionBy()).alias("clusters"),
    )


def zone_names(clustered: DataFrame) -> DataFrame:
    """``zone_label`` of every ``zone_cluster``, by ascending mean change of its roads."""
    ranks = _ranked(clustered, "zone_cluster", "delta_congestion", descending=False)
    place = F.least(F.col("place"), F.lit(len(ZONE_LABELS) - 1))
    names = F.element_at(F.array(*map(F.lit, ZONE_LABELS)), place + 1)
    return ranks.select("zone_cluster", names.alias("zone_label"))


def cluster_roads(roads: DataFrame, most: int = 3, seed: int = 42) -> Guarded:
    """Roads with ``zone_cluster`` and ``zone_label`` (by ascending mean change).

    Withheld with fewer than three two-sided roads.
    """
    n = roads.limit(most).count()
    if n < 3:
        schema = StructType(roads.schema.fields + [
            StructField("zone_cluster", IntegerType()), StructField("zone_label", StringType())
        ])
        return withheld(roads.sparkSession, schema, "fewer than three roads with both sides")
    assembler = VectorAssembler(inputCols=["ci_before", "delta_congestion"], outputCol="features")
    kmeans = KMeans(
        k=min(most, n), seed=seed, featuresCol="features", predictionCol="zone_cluster"
    )
    model = Pipeline(stages=[assembler, kmeans]).fit(roads)
    clustered = model.transform(roads).drop("features")
    named = clustered.join(F.broadcast(zone_names(clustered)), "zone_cluster")  # at most k rows
    return Guarded(named.select(*roads.columns, "zone_cluster", "zone_label"), model)


def fit_city_clusters(
    cities: DataFrame, ks: Sequence[int] = range(2, 6), seed: int = 42,
    names: Sequence[str] = CITY_CLUSTER_FEATURES,
) -> Guarded:
    """The standardising k-means pipeline with the best silhouette, and the labelled cities.

    Withheld with fewer than three different cities; no k beyond their number is tried.
    """
    cities = cities.persist()
    try:
        different = cities.select(*names).distinct().limit(max(ks)).count()
        if different < 3:
            schema = StructType([
                StructField("cluster", IntegerType()), *cities.schema.fields,
                StructField("impact_level", StringType()),
            ])
            return withheld(cities.sparkSession, schema, "fewer than three different cities")
        evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
        best: tuple[float, PipelineModel] | None = None
        for k in (k for k in ks if k <= different):
            stages = [
                VectorAssembler(inputCols=list(names), outputCol="raw_features"),
                StandardScaler(
                    inputCol="raw_features", outputCol="features", withMean=True, withStd=True
                ),
                KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster"),
            ]
            model = Pipeline(stages=stages).fit(cities)
            score = evaluator.evaluate(model.transform(cities))
            if best is None or score > best[0]:
                best = (score, model)
    finally:
        cities.unpersist()
    return Guarded(label_cities(best[1], cities), best[1])


def impact_levels(clustered: DataFrame) -> DataFrame:
    """Label per cluster by descending mean mobility drop: the first is high, the
    last low, everything between moderate."""
    low, moderate, high = IMPACT_CODES
    ranks = _ranked(clustered, "cluster", "avg_mobility_drop", descending=True)
    level = (
        F.when(F.col("place") == 0, high)
        .when(F.col("place") == F.col("clusters") - 1, low)
        .otherwise(moderate)
    )
    return ranks.select("cluster", level.alias("impact_level"))


def label_cities(model: PipelineModel, cities: DataFrame) -> DataFrame:
    clustered = model.transform(cities).drop("raw_features", "features")
    labels = impact_levels(clustered)
    return clustered.join(F.broadcast(labels), "cluster")  # at most k rows


def save_clusters(model: PipelineModel, labels: DataFrame, path: str) -> None:
    """Keep the whole pipeline and the label of every cluster."""
    model.write().overwrite().save(f"{path}/model")
    labels.write.mode("overwrite").parquet(f"{path}/labels")


def load_clusters(spark, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/labels")


def score_cities(model: PipelineModel | None, labels: DataFrame, cities: DataFrame) -> DataFrame:
    """Cluster, label and the distance to every centre, in standardised space; without a
    model there is no row."""
    if model is None:
        schema = StructType([
            StructField("cluster", IntegerType()), *cities.schema.fields,
            StructField("distances", ArrayType(DoubleType())), StructField("impact_level", StringType()),
        ])
        return cities.sparkSession.createDataFrame([], schema)
    centres = [[float(v) for v in centre] for centre in model.stages[-1].clusterCenters()]
    scored = model.transform(cities).withColumn("_point", vector_to_array("features"))

    def distance(centre: list[float]):
        gaps = F.zip_with("_point", F.array(*map(F.lit, centre)), lambda a, b: (a - b) * (a - b))
        return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap))

    return (
        scored.withColumn("distances", F.array(*[distance(c) for c in centres]))
        .drop("raw_features", "features", "_point")
        .join(F.broadcast(labels), "cluster", "left")  # at most k rows
    )
