"""Every registered query with SQL gives the rows DuckDB gives."""

from datetime import datetime, timedelta

import duckdb
import pytest
from conftest import SMALL
from oracle_check import connect, differences

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SMALL).toPandas()
    assert differences(found, duck.execute(SQL[name]).df()) == ""


def test_stream_fresh_in_a_session_with_the_default_state_store(spark, tmp_path):
    """A driver's session sets no store; kinds at the end of their lifetime, ties and old values."""
    plain = spark.newSession()
    plain.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    )
    now = datetime(2024, 1, 30, 12)
    events = [
        # (seconds before now, user, type, value)
        (0, 0, "click", 1.0), (30, 1, "click", 2.0), (31, 2, "click", 3.0),
        (60, 0, "view", 4.0), (60, 3, "view", 5.0), (61, 1, "view", 6.0),
        (1800, 0, "purchase", 7.0), (1801, 1, "purchase", 8.0), (3600, 2, "signup", 9.0),
        (86400, 0, "error", 10.0), (9000, 3, "error", 11.0), (86401, 1, "error", 12.0),
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    made = [(i, now - timedelta(seconds=s), u, t, v, "{}") for i, (s, u, t, v) in enumerate(events)]
    plain.createDataFrame(made, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    expected = con.execute(SQL["stream_fresh"]).df()
    assert sorted(expected["value"]) == [1.0, 2.0, 5.0, 7.0, 9.0, 11.0]
    assert differences(QUERIES["stream_fresh"](plain, str(tmp_path)).toPandas(), expected) == ""


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
