"""Every registered query on empty tables gives no row, or its defaults, under its usual schema."""

import pytest
from conftest import SMALL
from pyspark.sql import types as T

from tidemark.plans.catalog import REGISTRY

TABLES = "region nation customer supplier part orders lineitem events".split()
# Queries that run a stream, a cycle or a model; the others are compared by their plans alone.
HEAVY = ("stream_", "cycle_", "medallion", "gold_summary", "rf_", "forecast_", "mobility_forecast", "daily_documents",
         "hourly_documents", "bronze_rejects", "city_cluster", "cluster_", "road_zones", "feature_store", "layer_counts")


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in TABLES:
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        table.limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


def shape(kind):
    """A type without the nullability that a plan may or may not prove."""
    if isinstance(kind, T.StructType):
        return [(f.name, shape(f.dataType)) for f in kind.fields]
    if isinstance(kind, T.ArrayType):
        return ["array", shape(kind.elementType)]
    return kind.simpleString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_empty_tables(spark, empty, name):
    found = REGISTRY[name](spark, empty)
    found.collect()
    # The usual schema of a heavy query is that of its full run, which other tests have.
    usual = REGISTRY[name](spark, SMALL) if not name.startswith(HEAVY) else None
    if usual is not None:
        assert shape(found.schema) == shape(usual.schema)


@pytest.mark.parametrize("name", ["road_zones", "rf_metrics", "forecast_by_city", "city_clusters",
                                  "city_cluster_scores", "mobility_forecast_errors", "stream_live_feed"])
def test_empty_tables_of_models(spark, empty, name):
    assert shape(REGISTRY[name](spark, empty).schema) == shape(REGISTRY[name](spark, SMALL).schema)
