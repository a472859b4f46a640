"""Session construction and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
# Stream state off the heap, with incremental checkpoints.
_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_STAGED: list[str] = []
_LOCAL_ROOT: list[str] = []


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE and no web UI; extra settings by keyword
    (dots written as double underscores)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        **_ROCKSDB,
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables and stream checkpoints.

    A cluster names it in ``spark.checkpoint.dir``.  Only a master of one process may go
    without: it gets a fresh temporary folder, the same for the whole program.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    # ``local-cluster`` runs executors of its own, which do not share the driver's folder.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder every executor can reach")
    # Kept here: Spark does not let a running session change this setting.
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="tidemark-"))
    return _LOCAL_ROOT[0]


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A path below the scratch root that nothing else uses."""
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where one intermediate feeds several branches.  The written table
    survives lost executors, cuts the lineage, and carries its real size, so
    Catalyst chooses broadcast or sort-merge for later joins from the bytes on
    disk and not from a guess.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    _STAGED.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_scratch(spark: SparkSession) -> None:
    """Remove every table that this program staged; frames that read them end with it."""
    from tidemark.sources import files

    while _STAGED:
        files.remove(spark, _STAGED.pop())


@contextmanager
def shuffle_width(spark: SparkSession, partitions: int | None):
    """Set the shuffle width while a stream starts.

    A stream's state keeps the width it was first started with, so it is chosen
    once, at start, and not left to the session default.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if partitions:
        spark.conf.set(key, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Keep the state of a stream in RocksDB, whatever the session has, while it starts.

    Keyed state with timers needs it: Spark's default store has one table only.
    """
    before = {key: spark.conf.get(key, None) for key in _ROCKSDB}
    for key, value in _ROCKSDB.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
