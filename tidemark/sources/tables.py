"""Lake tables: readers, writers and keyed tables on plain Parquet."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegerType, LongType, StructField, StructType

from tidemark import schemas
from tidemark.functions import scores
from tidemark.operators import cleaning
from tidemark.session import stage
from tidemark.sources import files

BRONZE_COLUMNS = (
    "city", "road_name", "lat", "lon", "current_speed", "free_flow_speed", "congestion_index",
    "period", "recorded_at",
)


def within(rows: DataFrame, as_of: str, days: int, ahead: bool = False) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of``; ``ahead`` keeps later ones too.

    On a table partitioned by ``date`` the same bounds are put on the partition
    column, which Catalyst cannot infer from ``recorded_at``.
    """
    now = F.lit(as_of).cast("timestamp")
    oldest = now - F.make_dt_interval(days=F.lit(days))
    kept = rows.where(F.col("recorded_at") >= oldest)
    if not ahead:
        kept = kept.where(F.col("recorded_at") <= now)
    if "date" in rows.columns:
        kept = kept.where(F.col("date") >= F.to_date(oldest))
        if not ahead:
            kept = kept.where(F.col("date") <= F.to_date(now))
    return kept


def trailing_window(
    bronze: DataFrame, as_of: str, days: int = 60, ahead: bool = False
) -> DataFrame:
    """Bronze rows of the last ``days`` days up to ``as_of``."""
    rows = within(bronze, as_of, days, ahead)
    extra = [c for c in ("ingest_seq", "ingested_at") if c in bronze.columns]
    return rows.select(*BRONZE_COLUMNS, *extra)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there are files or partitions at ``path``; starts no job."""
    return any(not name.startswith(("_", ".")) for name in files.children(spark, path))


@contextmanager
def _footers_answer(spark: SparkSession):
    """While this holds, counts over Parquet come from the footers of its files."""
    wanted = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def footer_count(spark: SparkSession, path: str, column: str | None = None) -> DataFrame:
    """One row with ``row_count``: rows of a Parquet table, or those with a value in ``column``."""
    counted = F.count(F.col(column) if column else F.lit(1)).alias("row_count")
    return spark.read.parquet(path).agg(counted)


def footer_counts(spark: SparkSession, wanted: Mapping[str, tuple[str, str | None]]) -> dict[str, int]:
    """Rows per named (path, column); no row group is read.  A table that is not there has none."""
    with _footers_answer(spark):
        return {
            name: footer_count(spark, path, column).first()["row_count"] if table_exists(spark, path) else 0
            for name, (path, column) in wanted.items()
        }


def jdbc_options(
    url: str, table: str, partition_column: str, bounds: tuple, partitions: int,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a database read in parallel ranges of ``partition_column``."""
    low, high = bounds
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        **(properties or {}),
    }


def jdbc_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A database table by :func:`jdbc_options`; needs the database's driver."""
    return spark.read.format("jdbc").options(**options).load()


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str] = ("city", "date"), mode: str = "overwrite",
    sort_by: Sequence[str] = (),
) -> None:
    """Write Hive-style partitions, replacing only the partitions present in ``df``.

    The rebalance hint lets AQE cut a partition value with many rows into
    several files and merge small ones.
    """
    balanced = df.hint("rebalance", *by)
    if sort_by:
        balanced = balanced.sortWithinPartitions(*by, *sort_by)
    (
        balanced.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


# Bronze partitions; the batch comes last so that a repeated batch replaces itself.
BRONZE_PARTITIONS = ("city", "date", "ingest_batch")
SEED_BATCH = -1


def seed_bronze(readings: DataFrame, path: str, source: str = "tomtom") -> None:
    """Bulk load of historical readings, tagged as a batch; may run again."""
    seeded = cleaning.with_defaults(readings, source=source, ingested_via="batch_seed")
    write_partitioned(
        seeded.withColumn("ingest_batch", F.lit(SEED_BATCH)), path, by=BRONZE_PARTITIONS
    )


def touched_dates(bronze: DataFrame, after_batch: int) -> DataFrame:
    """Dates that later ingest batches added to; reads partition values only."""
    return bronze.where(F.col("ingest_batch") > after_batch).select("date").distinct()


def refresh_silver(silver: DataFrame, path: str, days: DataFrame | None = None) -> None:
    """Replace the silver rows of ``days`` (a frame of dates; None: all) by ``silver``.

    A (city, date) that has rows in the table but none left in ``silver`` would
    survive a dynamic overwrite.  It is overwritten by a row of nulls, in the same
    commit; :func:`read_silver` leaves these out.  Running it again changes nothing.
    """
    rows = silver.withColumn("date", F.to_date("recorded_at"))
    if table_exists(silver.sparkSession, path):
        held = silver.sparkSession.read.parquet(path).select("city", "date").distinct()
        if days is not None:
            held = held.join(days, "date", "left_semi")
        rows = rows.unionByName(stage(held, "silver-days"), allowMissingColumns=True)
    write_partitioned(rows, path, sort_by=("road_name", "recorded_at"))


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The silver readings; emptied days hold no reading."""
    return spark.read.parquet(path).where(F.col("congestion_index").isNotNull())


def _precision(df: DataFrame) -> dict[str, str]:
    return {name: kind for name, kind in schemas.PUBLISHED_PRECISION.items() if name in df.columns}


def published_precision(df: DataFrame) -> DataFrame:
    """Round the known columns to the decimal precision they are published with.

    A value beyond the precision becomes null and does not fail the read;
    :func:`beyond_precision` counts them.
    """
    casts = {name: F.col(name).try_cast(kind) for name, kind in _precision(df).items()}
    return df.withColumns(casts) if casts else df


def beyond_precision(df: DataFrame) -> DataFrame:
    """(column_name, dropped): values of the known columns that :func:`published_precision`
    cannot hold, in one pass over the unrounded rows."""
    known = _precision(df)
    lost = [
        F.count_if(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()).alias(name)
        for name, kind in known.items()
    ]
    if not known:
        return df.sparkSession.createDataFrame([], "column_name string, dropped long")
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("dropped")) for n in known])
    return df.agg(*lost).select(F.explode(pairs).alias("p")).select("p.*")


def append_history(df: DataFrame, path: str, run_id: str, computed_at: str) -> None:
    """Add the rows of one run to a history table; a repeated run replaces itself."""
    stamped = df.withColumns(
        {"computed_at": F.lit(computed_at).cast("timestamp"), "run_id": F.lit(run_id)}
    )
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def append_points(points: DataFrame, path: str, batch: int) -> None:
    """Add time-series points as one batch; a repeated batch replaces itself."""
    stamped = points.withColumns({"date": F.to_date("ts"), "batch": F.lit(int(batch))})
    write_partitioned(stamped, path, by=("date", "batch"))


def read_points(
    spark: SparkSession, path: str,
    schema: str = "metric string, city string, ts timestamp, value double",
) -> DataFrame:
    """The stored points; without any an empty frame of ``schema``."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).drop("date", "batch")


def expire_points(spark: SparkSession, path: str, as_of: str, keep_seconds: int) -> None:
    """Remove the days that lie wholly before the retention at ``as_of``."""
    limit = F.to_date(F.lit(as_of).cast("timestamp") - F.make_dt_interval(secs=F.lit(keep_seconds)))
    oldest = spark.range(1).select(limit.cast("string")).first()[0]
    for name in files.children(spark, path):
        if name.startswith("date=") and name.split("=")[1] < oldest:
            files.remove(spark, f"{path}/{name}")


def replace_table(df: DataFrame, path: str, options: Mapping[str, str] | None = None) -> None:
    """Truncate and load: the rows become the next version below ``path``.

    Readers of the version before are not disturbed; older versions are removed.
    """
    spark = df.sparkSession
    versions = _versions(spark, path, "load")
    writer = df.write.mode("overwrite").options(**(options or {}))
    writer.parquet(f"{path}/load={max(versions, default=0) + 1}")
    for old in sorted(versions)[:-1]:
        files.remove(spark, f"{path}/load={old}")


LOOKUP_KEYS = ("city", "road_name")


def write_latest(latest: DataFrame, path: str) -> None:
    """Store one row per road for point lookups.

    Files hold ranges of (city, road_name), so their statistics tell which cities they
    lack, and carry a Bloom filter of the road names: a lookup by literal keys skips the
    row groups without them.  :func:`read_replaced` reads the table.
    """
    options = {"parquet.bloom.filter.enabled#road_name": "true"}
    ordered = latest.repartitionByRange(*LOOKUP_KEYS).sortWithinPartitions(*LOOKUP_KEYS)
    replace_table(ordered, path, options)


def find_roads(latest: DataFrame, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of a few (city, road_name) given as values; both reach the scan as filters."""
    pairs = [(F.col("city") == city) & (F.col("road_name") == road) for city, road in wanted]
    exact = reduce(lambda a, b: a | b, pairs, F.lit(False))
    near = F.col("city").isin(sorted({c for c, _ in wanted})) & F.col("road_name").isin(sorted({r for _, r in wanted}))
    return latest.where(near & exact)


def replaced_path(spark: SparkSession, path: str) -> str:
    """Where the newest finished version of a table written by :func:`replace_table` lies."""
    done = [v for v in _versions(spark, path, "load") if files.exists(spark, f"{path}/load={v}/_SUCCESS")]
    if not done:
        raise FileNotFoundError(path)
    return f"{path}/load={max(done)}"


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(replaced_path(spark, path))


def _versions(spark: SparkSession, path: str, key: str) -> list[int]:
    names = (n for n in files.children(spark, path) if n.startswith(f"{key}="))
    return [int(n.split("=")[1]) for n in names]


def export_csv(report: DataFrame, path: str, by: str = "city") -> None:
    report.write.mode("overwrite").partitionBy(by).option("header", True).csv(path)


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """``target`` with the rows of ``updates`` added or put in place by key.

    Null is a key like any other.  Of several updates with one key the first in
    ``order`` counts (by default the greatest by the other columns).
    """
    rest = [F.col(c).desc() for c in updates.columns if c not in keys]
    single = cleaning.keep_latest(updates, keys, [*order, *rest] or [F.lit(0)])
    wanted = single.select(*(F.col(k).alias(f"__{k}") for k in keys))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return target.join(wanted, same, "left_anti").unionByName(single)


_NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # how Hive names the partition of a null


class KeyedTable:
    """A table with a natural key on plain Parquet, cut by the day of one key if it has a time
    (``per`` names a longer unit for tables with few rows a day).

    ``put`` writes the changed rows as one more version, so a writer never reads and
    overwrites the same files, and putting a version again (a retried stream batch, a
    repeated cycle) replaces just that version.  A version can also name keys that are
    gone.  ``read`` resolves the newest row per key.

    Files lie in ``[day=]/level=/version=``.  ``fold`` merges the versions of a level into
    one of the next level, so a row is rewritten once per level and the bytes written grow
    with the rows put, not with the table.  A day behind the newest ones is folded whole;
    a day of one version is neither rewritten nor ranked again.  Folded versions stay until
    the next fold, for readers that have already listed them.
    """

    _CLOSED = 9  # the level of a day folded whole

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], day: str | None = None,
        schema: str | Callable | None = None, per: str = "day",
    ):
        self.spark, self.path, self.keys, self.day = spark, path, tuple(keys), day
        self.schema, self.per = schema, per
        self._parts = (["day"] if day else []) + ["level", "version"]

    def put(self, rows: DataFrame, version: int, gone: DataFrame | None = None) -> None:
        """Add ``rows`` and take the keys ``gone`` out, as ``version``."""
        marked = rows.withColumn("gone", F.lit(False))
        if gone is not None:
            gone = gone.select(*self.keys).withColumn("gone", F.lit(True))
            marked = marked.unionByName(gone, allowMissingColumns=True)
        self._write(marked, 0, version)

    def _write(self, marked: DataFrame, level: int, version: int) -> None:
        placed = marked.withColumns(
            {"level": F.lit(level), "version": F.lit(int(version)).cast("bigint")}
        )
        if self.day:
            # The rebalance gives a day few files, whatever the tasks that hold its rows.
            placed = placed.withColumn("day", self._slot(F.col(self.day))).hint("rebalance", "day")
        (
            placed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self._parts)
            .parquet(self.path)
        )

    def _slot(self, at: Column) -> Column:
        return F.to_date(F.date_trunc(self.per, at.cast("timestamp")))

    def _between(self, rows: DataFrame, low: str | None, high: str | None) -> DataFrame:
        if low is not None:
            rows = rows.where(F.col("day") >= self._slot(F.lit(low)))
        if high is not None:
            rows = rows.where(F.col("day") <= self._slot(F.lit(high)))
        return rows

    def _known(self) -> StructType | None:
        schema = self.schema() if callable(self.schema) else self.schema
        return self.spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema

    def _stored(self) -> DataFrame:
        known = self._known()
        if known is None:
            stored = self.spark.read.parquet(self.path)
        else:  # no job has to look for the schema
            day = [StructField("day", DateType())] if self.day else []
            more = [StructField("gone", BooleanType()), *day, StructField("level", IntegerType())]
            full = StructType([*known.fields, *more, StructField("version", LongType())])
            stored = self.spark.read.schema(full).parquet(self.path)
        return stored.withColumn("version", F.col("version").cast("bigint"))

    def _newest(self, stored: DataFrame) -> DataFrame:
        return cleaning.keep_latest(stored, self.keys, [F.col("version").desc(), F.col("level").desc()])

    def exists(self) -> bool:
        return table_exists(self.spark, self.path)

    def _or_empty(self) -> DataFrame | None:
        """None if there are rows; else an empty frame of the schema."""
        if self.exists():
            return None
        known = self._known()
        if known is None:
            raise FileNotFoundError(self.path)
        return self.spark.createDataFrame([], known)

    def read(self, low: str | None = None, high: str | None = None) -> DataFrame:
        """The newest row per key; with ``low`` and ``high`` only of those days (both included).

        A table without any row reads as an empty frame of ``schema``.
        """
        if (empty := self._or_empty()) is not None:
            return empty
        stored = self._stored()
        if not self.day:
            return self._newest(stored).where(~F.col("gone")).drop("gone", "level", "version")
        stored = self._between(stored, low, high)
        # Only days with several versions have rows to choose from.
        several = [d for d, held in self._folders(stored).items() if len(held) > 1]
        open_ = F.coalesce(F.col("day").cast("string"), F.lit(_NO_DAY)).isin(several)
        rows = stored.where(~open_).unionByName(self._newest(stored.where(open_)))
        return rows.where(~F.col("gone")).drop("gone", *self._parts)

    def changes(self, after: int, low: str | None = None) -> DataFrame:
        """Rows of versions later than ``after``, not resolved; a folded version brings all its rows."""
        rows = self._between(self._stored(), low, None).where(F.col("version") > after)
        return rows.drop("gone", "level")

    def newest_version(self) -> int:
        """The greatest version; -1 for a table without rows."""
        if not self.exists():
            return -1
        held = self._folders(self._stored()).values()
        return max((v for versions in held for _, v in versions), default=-1)

    def _folders(self, stored: DataFrame) -> dict[str, list[tuple[int, int]]]:
        """(level, version) by day, from the files that a read would open."""
        out: dict[str, set] = {}
        for file in stored.inputFiles():
            part = dict(p.split("=", 1) for p in file.split("/") if "=" in p)
            out.setdefault(part.get("day", ""), set()).add((int(part["level"]), int(part["version"])))
        return {d: sorted(held) for d, held in out.items()}

    def _levels(self, root: str) -> list[tuple[int, int]]:
        """(level, version) below one day, newest first; those that a higher level covers last."""
        return [
            (int(level.split("=")[1]), version)
            for level in files.children(self.spark, root) if level.startswith("level=")
            for version in _versions(self.spark, f"{root}/{level}", "version")
        ]

    def fold(self, most: int = 16, keep_open: int = 2) -> None:
        """Fold levels with more than ``most`` versions, and days behind the ``keep_open`` newest.

        The newest version of a day stays apart, so that its batch can still run again and
        replace just itself.  A reader finds the same rows before and after; a failure in
        between leaves versions that the next call folds.  Looks back from the newest day
        to the first one that needs no folding; :meth:`fold_days` looks at all.
        """
        if not self.day:
            self._fold_levels(self.path, None, most)
            return
        days = sorted(n.split("=")[1] for n in files.children(self.spark, self.path) if n.startswith("day="))
        for day in days[-keep_open:]:
            self._fold_levels(f"{self.path}/day={day}", day, most)
        behind = []
        for day in reversed(days[:-keep_open]):
            held = self._sweep(f"{self.path}/day={day}")
            if len(held) < 2:
                break
            behind.append((day, held))
        self._close(behind)

    def fold_days(self) -> None:
        """Fold every day of several versions whole, all in one job."""
        if self.exists():
            several = [d for d, held in self._folders(self._stored()).items() if len(held) > 1]
            held = [(day, self._sweep(f"{self.path}/day={day}")) for day in sorted(several)]
            self._close([(day, versions) for day, versions in held if len(versions) > 1])

    def _sweep(self, root: str) -> list[tuple[int, int]]:
        """Remove what an earlier fold has merged; the versions that count."""
        held = self._levels(root)
        covered = [(a, v) for a, v in held if any(b > a and w >= v for b, w in held)]
        for level, version in covered:
            files.remove(self.spark, f"{root}/level={level}/version={version}")
        return sorted(set(held) - set(covered))

    def _of_days(self, days: Sequence[str]) -> DataFrame:
        return self._stored().where(F.coalesce(F.col("day").cast("string"), F.lit(_NO_DAY)).isin(list(days)))

    def _fold_levels(self, root: str, day: str | None, most: int) -> None:
        held = self._sweep(root)
        newest = max((v for _, v in held), default=None)
        for level in range(self._CLOSED - 1):
            own = [v for a, v in held if a == level and (level or v != newest)]
            if len(own) > most:
                stored = self._stored() if day is None else self._of_days([day])
                chosen = stored.where((F.col("level") == level) & F.col("version").isin(own))
                rows = self._newest(chosen).drop(*self._parts)
                self._write(stage(rows, "folded"), level + 1, max(own))

    def _close(self, days: list[tuple[str, list[tuple[int, int]]]]) -> None:
        """Fold days whole, in one job; each has its (level, version)."""
        if days:
            rows = self._newest(self._of_days([day for day, _ in days])).drop(*self._parts)
            self._write(stage(rows, "folded"), self._CLOSED, max(v for _, held in days for _, v in held))


def comparison_documents(wide: DataFrame) -> DataFrame:
    """One JSON document per city: both sides and the change."""

    def side(period: str):
        return F.struct(
            scores.half_up(F.col(f"{period}_congestion"), 2).alias("avg_congestion"),
            scores.half_up(F.col(f"{period}_speed"), 2).alias("avg_speed"),
            F.col(f"{period}_records").alias("records"),
        ).alias(period)

    body = F.to_json(F.struct(side("before"), side("after"), "change_pct"))
    return wide.select(F.concat(F.lit("comparison:"), "city").alias("key"), body.alias("document"))


def hourly_documents(hourly: DataFrame) -> DataFrame:
    """One JSON document per city: {period: {hour: {avg_congestion, avg_speed}}}.

    The maps hold at most 24 hours and two periods per city.
    """
    cell = F.struct(
        scores.half_up(F.col("avg_congestion"), 2).alias("avg_congestion"),
        scores.half_up(F.col("avg_speed"), 2).alias("avg_speed"),
    )
    hours = F.map_from_entries(F.collect_list(F.struct(F.col("hour").cast("string"), cell)))
    by_period = hourly.groupBy("city", "period").agg(hours.alias("hours"))
    periods = F.map_from_entries(F.collect_list(F.struct("period", "hours")))
    return by_period.groupBy("city").agg(F.to_json(periods).alias("document")).select(
        F.concat(F.lit("hourly:"), "city").alias("key"), "document"
    )


def row_documents(df: DataFrame, prefix: str, key: Sequence[str]) -> DataFrame:
    """One JSON document per row, under ``prefix:key1:key2``."""
    name = F.concat_ws(":", F.lit(prefix), *[F.col(k).cast("string") for k in key])
    return df.select(name.alias("key"), F.to_json(F.struct(*df.columns)).alias("document"))
