"""Partitioned Parquet tables: scans, safe rewrites, CSV output."""

from __future__ import annotations

import hashlib
import re
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.functions import month_of
from subledger.operators.dedupe import dedupe_fact, with_batch
from subledger.operators.merge import fill_counters
from subledger.schemas import COUNTERS_SCHEMA, FACTS, Fact
from subledger.session import scratch_path


class RowCountMismatch(RuntimeError):
    """A table read back after a write does not hold the rows that were written."""


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _filesystem(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    files, target = _filesystem(spark, path)
    files.delete(target, True)


# A table is a folder of Parquet partitions that the session's catalog points at. A full load writes a new version beside the
# old one and moves the table's location to it. An append writes the partitions it touches to ``pending``, and Spark's dynamic
# partition overwrite brings them into the table; while ``pending`` stands, readers take those partitions from there. Either
# is visible from one rename on, and only after its rows were counted.
VERSION = "version-"
STAGING = "staging-"
PENDING = "pending"
MARK = "_SUCCESS"
# Spark's name for the partition of null.
UNNAMED = "__HIVE_DEFAULT_PARTITION__"
_DISCOVERED = "spark.sql.hive.manageFilesourcePartitions"
_SETTING = threading.Lock()  # loads may run side by side


def table_name(path: str) -> str:
    """The table's name in the session's catalog."""
    path = path.rstrip("/")
    return f"subledger_{re.sub('[^a-z0-9]+', '_', path.rpartition('/')[2].lower())}_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _children(spark: SparkSession, path: str) -> list[str]:
    files, folder = _filesystem(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def _rename(spark: SparkSession, source: str, target: str) -> None:
    files, old = _filesystem(spark, source)
    new = _filesystem(spark, target)[1]
    if files.exists(new) or not files.rename(old, new):
        raise OSError(f"{target} was published by another write")


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the full loads that were finished and are still there, oldest first."""
    return [f"{path.rstrip('/')}/{name}" for name in _children(spark, path) if name.startswith(VERSION)]


def partition_columns(spark: SparkSession, location: str) -> list[str]:
    found = []
    while names := partition_names(spark, location):
        found.append(names[0].partition("=")[0])
        location = f"{location}/{names[0]}"
    return found


def _written(rows: DataFrame, keys: Sequence[str], lookups: Sequence[str]) -> DataFrameWriter:
    """A writer by partition; files carry a bloom filter for each lookup column and are sorted by the first one."""
    if lookups:
        rows = rows.sortWithinPartitions(*keys, lookups[0])
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in lookups}
    return rows.write.options(**blooms, **{"compression": "snappy", "parquet.bloom.filter.adaptive.enabled": "true"}).partitionBy(*keys)


def _register(spark: SparkSession, path: str, location: str) -> None:
    """Enter a version into the catalog. Its partitions are found by listing, so moving the location is all a load needs."""
    keys = partition_columns(spark, location)
    fields = ", ".join(
        f"`{f.name}` {'string' if f.name in keys else f.dataType.simpleString()}" for f in spark.read.parquet(location).schema.fields)
    with _SETTING:
        before = spark.conf.get(_DISCOVERED, None)
        spark.conf.set(_DISCOVERED, "false")
        try:
            spark.sql(f"CREATE TABLE {table_name(path)} ({fields}) USING parquet "
                      f"PARTITIONED BY ({', '.join(keys)}) LOCATION {_quoted(location)}")
        finally:
            spark.conf.unset(_DISCOVERED) if before is None else spark.conf.set(_DISCOVERED, before)


def _point(spark: SparkSession, path: str, location: str) -> None:
    """Make a version the table."""
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        opened(spark, path)
    elif partition_names(spark, location) and set(spark.read.parquet(location).columns) == set(spark.table(name).columns):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(location)}")
    else:  # other columns, or no rows
        spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external
        opened(spark, path)


def opened(spark: SparkSession, path: str) -> str | None:
    """The table's catalog name, None where no load was finished or the last one had no rows.

    A catalog that does not know the table yet (a session without a metastore) takes the newest finished version.
    """
    path = path.rstrip("/")
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        found = versions(spark, path)
        if not found or not partition_names(spark, found[-1]):
            return None
        _register(spark, path, found[-1])
    return name


def _columns(spark: SparkSession, name: str) -> str:
    """The table's columns as DDL, from the catalog: no file is listed."""
    return ", ".join(f"`{c.name}` {c.dataType}" for c in spark.catalog.listColumns(name))


def location(spark: SparkSession, path: str) -> str | None:
    """The folder the catalog points at."""
    name = opened(spark, path)
    if name is None:
        return None
    return next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location")


_SEEN: dict[tuple[str, str], tuple[str, int]] = {}


def _refresh(spark: SparkSession, path: str) -> None:
    """List the table's files anew if a write of another session was committed since this one listed them."""
    folder = location(spark, path)
    files, mark = _filesystem(spark, f"{folder}/{MARK}")
    key, now = (spark._jsparkSession.sessionUUID(), table_name(path)), (folder, files.getFileStatus(mark).getModificationTime())
    if _SEEN.get(key) != now:
        spark.catalog.refreshTable(table_name(path))
        _SEEN[key] = now


def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table's rows, with columns of ``schema`` it lacks as nulls; None where there is no table."""
    name = opened(spark, path)
    if name is None:
        return None
    _refresh(spark, path)
    rows, folder = spark.table(name), f"{path.rstrip('/')}/{PENDING}"
    if exists(spark, folder):  # an append was published, but not brought in to the end
        keys = partition_columns(spark, folder)
        fresh = spark.read.schema(rows.schema).parquet(folder)
        touched = F.lit(False)
        for part in fresh.select(*keys).distinct().collect():  # its partitions
            touched = touched | reduce(Column.__and__, [F.col(k).eqNullSafe(F.lit(part[k])) for k in keys])
        rows = rows.where(~touched).unionByName(fresh)
    return rows if schema is None else _shaped(rows, schema)


def _shaped(rows: DataFrame, schema: T.StructType, *extra: Column) -> DataFrame:
    have = set(rows.columns)
    return rows.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], *extra)


def recover(spark: SparkSession, path: str, lookups: Sequence[str] = ()) -> None:
    """Bring published partitions into the table; doing it again after a break changes nothing."""
    path = path.rstrip("/")
    folder = f"{path}/{PENDING}"
    if exists(spark, folder):
        name, target = opened(spark, path), location(spark, path)
        keys = partition_columns(spark, folder)
        rows = spark.read.schema(_columns(spark, name)).parquet(folder)
        _written(rows, keys, lookups).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(target)
        files, mark = _filesystem(spark, f"{target}/{MARK}")
        files.create(mark, True).close()  # tells every session to list the files anew
        done = f"{path}/{STAGING}{uuid.uuid4().hex}"  # never half of ``pending``
        _rename(spark, folder, done)
        remove(spark, done)


def tidy(spark: SparkSession, path: str) -> None:
    """Remove versions older than the one before the current, which running readers may use, and what broken writes left."""
    path = path.rstrip("/")
    for folder in versions(spark, path)[:-2]:
        remove(spark, folder)
    for name in _children(spark, path):
        if name.startswith(STAGING):
            remove(spark, f"{path}/{name}")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, or an empty frame of its schema where none was ever written."""
    rows = read_current(spark, path, schema)
    return spark.createDataFrame([], schema) if rows is None else rows


def fact_path(root: str, fact: Fact) -> str:
    return f"{root.rstrip('/')}/{fact.name}"


# Facts lie by month and day: an append reads and rewrites the days it touches only.
FACT_PARTITIONS = ("year_month", "day")


def day_of(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def _with_day(fact: Fact) -> T.StructType:
    return T.StructType([*fact.stored_schema.fields, T.StructField("day", T.StringType())])


def _by_day(spark: SparkSession, root: str, fact: Fact) -> DataFrame:
    """A fact table with both its partition columns; one that lies by month only gets the day of the event."""
    rows = read_current(spark, fact_path(root, fact))
    if rows is None:
        return spark.createDataFrame([], _with_day(fact))
    day = F.col("day") if "day" in rows.columns else day_of(F.col(fact.event_date))
    return _shaped(rows, fact.stored_schema, day.alias("day"))


def _of_days(spark: SparkSession, root: str, fact: Fact, days: Sequence[str | None]) -> DataFrame:
    """Rows of some days (None: undated ones). Their folders are named, so no other folder is even listed."""
    path, dated = fact_path(root, fact).rstrip("/"), [d for d in days if d is not None]
    touched = F.col("year_month").isin(sorted({d[:7] for d in dated})) & F.col("day").isin(dated)
    if len(dated) < len(days):
        touched = touched | F.col("day").isNull()
    name = opened(spark, path)
    if name is None or exists(spark, f"{path}/{PENDING}") or "day" not in [c.name for c in spark.catalog.listColumns(name)]:
        return _by_day(spark, root, fact).where(touched)
    folder = location(spark, path)
    parts = [f"{folder}/year_month={d[:7]}/day={d}" if d else f"{folder}/year_month={UNNAMED}/day={UNNAMED}" for d in days]
    there = [part for part in parts if exists(spark, part)]
    if not there:
        return spark.createDataFrame([], _with_day(fact))
    return spark.read.option("basePath", folder).schema(_with_day(fact)).parquet(*there).where(touched)


def read_fact(
    spark: SparkSession, root: str, fact: Fact, months: Sequence[str] | None = None, days: Sequence[str] | None = None,
) -> DataFrame:
    """A fact table with its ``year_month`` column; ``months`` and ``days`` prune partitions.

    A day filter says nothing about the event time, so the time range of the days is given too: it is pushed to the scan.
    """
    rows = _by_day(spark, root, fact) if days is None else _of_days(spark, root, fact, days)
    if months is not None:
        rows = rows.where(F.col("year_month").isin(list(months)))
    if days:
        rows = _within(rows, fact, min(days), max(days))
    return rows.select(*fact.stored_columns)


def _within(rows: DataFrame, fact: Fact, start: str, end: str) -> DataFrame:
    at = F.col(fact.event_date)
    return rows.where((at >= F.lit(start).cast("timestamp_ntz")) & (at < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")))


def read_range(spark: SparkSession, root: str, fact: Fact, start: str, end: str) -> DataFrame:
    """Rows from start to end day, both included: months and days prune partitions, the time range row groups."""
    rows = _by_day(spark, root, fact).where(F.col("year_month").between(start[:7], end[:7]) & F.col("day").between(start, end))
    return _within(rows, fact, start, end).select(*fact.stored_columns)


def read_facts(
    spark: SparkSession, root: str, months: Sequence[str] | None = None, days: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    return {name: read_fact(spark, root, fact, months, days) for name, fact in FACTS.items()}


# Pushes whole counts down to the Parquet footers, which only Spark's second reader does.
_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
_READING: dict[str, SparkSession] = {}


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session whose settings are its own; its frames are combined with each other only."""
    key = spark.sparkContext.applicationId
    if key not in _READING:
        _READING[key] = spark.newSession()
        for name, value in {**_FOOTERS, "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone")}.items():
            _READING[key].conf.set(name, value)
    return _READING[key]


def footer_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """``row_count`` by partition from the files' footers, without reading a row; None where there is no table."""
    name = opened(spark, path)
    if name is None:
        return None
    folder = location(spark, path)
    keys = partition_columns(spark, folder)
    if exists(spark, f"{path.rstrip('/')}/{PENDING}"):
        counts = read_current(spark, path).groupBy(*keys).agg(F.count("*").alias("row_count"))
        return _footer_session(spark).createDataFrame(counts.collect(), counts.schema)
    rows = _footer_session(spark).read.schema(_columns(spark, name)).parquet(folder)
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count"))


def stored_days(spark: SparkSession, root: str, fact: Fact) -> DataFrame:
    """(``year_month``, ``date``, ``row_count``) of a fact table, from its footers; undated rows have null dates."""
    counts = footer_counts(spark, fact_path(root, fact))
    if counts is None:
        return _footer_session(spark).createDataFrame([], "year_month string, date date, row_count bigint")
    if "day" not in counts.columns:  # a table by month: its days are counted, and there are no more than the calendar has
        days = _by_day(spark, root, fact).groupBy("year_month", F.col("day").cast("date").alias("date")).agg(F.count("*").alias("row_count"))
        return _footer_session(spark).createDataFrame(days.collect(), days.schema)
    return counts.select("year_month", F.col("day").cast("date").alias("date"), "row_count")


def partition_counts(spark: SparkSession, root: str) -> DataFrame:
    """(``tx_type``, ``year_month``, ``row_count``) of all six types by partition, from footers."""
    found = [(fact, footer_counts(spark, fact_path(root, fact))) for fact in FACTS.values()]
    parts = [rows.select(F.lit(fact.tag).alias("tx_type"), "year_month", "row_count") for fact, rows in found if rows is not None]
    return reduce(DataFrame.unionByName, parts, _footer_session(spark).createDataFrame([], "tx_type string, year_month string, row_count bigint"))


def all_days(spark: SparkSession, root: str) -> DataFrame:
    """The same for all six types, with ``tx_type``."""
    parts = [stored_days(spark, root, fact).select(F.lit(fact.tag).alias("tx_type"), "*") for fact in FACTS.values()]
    return reduce(DataFrame.unionByName, parts)


# Columns by which single users are looked up.
LOOKUPS = ("tmuserid", "msisdn")


def fact_lookups(fact: Fact) -> list[str]:
    return [c for c in (*LOOKUPS, fact.subscription) if c in fact.columns]


def save_fact(
    rows: DataFrame, root: str, fact: Fact, keep_if_empty: bool = False, lookups: Sequence[str] = (),
    partitions: Sequence[str] = FACT_PARTITIONS,
) -> int:
    """Replace a fact table; returns its row count. Small histories may lie by month only, to keep their files few."""
    rows = rows.select(*fact.stored_columns).withColumn("day", day_of(F.col(fact.event_date)))
    return write_partitioned(
        rows.select(*fact.columns, *partitions), fact_path(root, fact), partitions, replace_all=True, keep_if_empty=keep_if_empty, lookups=lookups)


def write_partitioned(
    rows: DataFrame, path: str, partition: str | Sequence[str] = "year_month", replace_all: bool = False, owned: Sequence[str] = (),
    keep_if_empty: bool = False, lookups: Sequence[str] = (),
) -> int:
    """Snappy Parquet by partition; returns the number of rows written.

    ``lookups`` are columns asked for single values: their files carry bloom filters, and rows are sorted by the first one,
    so a scan for one value skips the row groups without it.

    By default only the partitions present in ``rows`` are replaced; ``replace_all`` replaces the table, unless
    there are no rows and ``keep_if_empty``. A partition in ``owned`` that gets no rows is removed.
    The rows may be computed from the table itself: they are written to a folder of their own, the copy's row count
    is checked, and one rename then makes them visible. A write that is cut off at any point leaves the old table or the
    new one, and the next write finishes or removes what it left. One writer per table at a time. The rebalance keeps files
    near the advisory size, splitting a partition that is too large for one task.
    """
    spark = rows.sparkSession
    path = path.rstrip("/")
    keys = [partition] if isinstance(partition, str) else list(partition)
    staged, written = f"{path}/{STAGING}{uuid.uuid4().hex}", Observation()
    dealt = rows.hint("rebalance", *keys).observe(written, F.count(F.lit(1)).alias("n"))
    _written(dealt, keys, lookups).parquet(staged)
    expected = observed_count(written)
    names = partition_names(spark, staged)
    verify_count(spark.read.parquet(staged) if names else spark.range(0), expected)
    recover(spark, path)  # of a write before; the rows were computed with it
    if replace_all or opened(spark, path) is None:
        if not (keep_if_empty and not expected):
            last = versions(spark, path)[-1:]
            number = int(last[0].rpartition(VERSION)[2]) + 1 if last else 1
            target = f"{path}/{VERSION}{number:010d}"
            _rename(spark, staged, target)
            _point(spark, path, target)
    else:
        emptied = {f"{keys[0]}={value}" for value in owned} - set(names)
        for name in emptied:
            remove(spark, f"{location(spark, path)}/{name}")
        if names:
            _rename(spark, staged, f"{path}/{PENDING}")
            recover(spark, path, lookups)
        if emptied:
            spark.catalog.refreshTable(opened(spark, path))
    tidy(spark, path)
    return expected


@contextmanager
def staged_copy(rows: DataFrame, label: str = "load") -> Iterator[DataFrame]:
    """The rows written once to the shared scratch folder, for everything that a load asks of them."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    try:
        yield rows.sparkSession.read.schema(rows.schema).parquet(path)
    finally:
        remove(rows.sparkSession, path)


def observed_count(metric: Observation) -> int:
    """Rows counted while a job ran; a plan that turned out empty at run time reports no metrics."""
    try:
        return metric.get["n"]
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):  # of an empty metrics row
            raise
        return 0


def partition_names(spark: SparkSession, path: str) -> list[str]:
    """Partition folders of a table, ``column=value``."""
    files, folder = _filesystem(spark, path)
    found = files.listStatus(folder) if files.exists(folder) else []
    return sorted(f.getPath().getName() for f in found if f.isDirectory() and "=" in f.getPath().getName())


def verify_count(table: DataFrame, expected: int) -> None:
    found = table.count()
    if found != expected:
        raise RowCountMismatch(f"{found} rows read back, {expected} expected")


@dataclass(frozen=True)
class Loaded:
    """What one load of a type did: row counts, unparsed dates per column, faulty rows per rejected file, days touched."""

    rows_before: int
    rows_read: int
    rows_stored: int
    null_dates: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)
    days: tuple[str | None, ...] = ()

    @property
    def duplicates(self) -> int:
        return self.rows_before + self.rows_read - self.rows_stored


def append_batch(spark: SparkSession, root: str, fact: Fact, incoming: DataFrame, lookups: Sequence[str] = ()) -> Loaded:
    """Append with keep-last: only the days the batch touches are read and rewritten. Appending twice changes nothing.

    The dedupe key holds the event time, so a stored row can only collide with an incoming row of its own day. The batch is
    written once to a typed staging table, from which its days, row count, unparsed dates and rows are read.
    """
    dates = [f.name for f in fact.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    recover(spark, fact_path(root, fact))
    with staged_copy(incoming.withColumn("day", day_of(F.col(fact.event_date)))) as batch:
        profile = batch.groupBy("day").agg(
            F.count(F.lit(1)).alias("_n"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in dates]
        ).collect()  # bounded by the calendar
        read, nulls = sum(p["_n"] for p in profile), {c: sum(p[c] for p in profile) for c in dates}
        if not read:
            return Loaded(0, 0, 0, nulls)
        days = [p.day for p in profile]
        held = _of_days(spark, root, fact, days).select(*fact.stored_columns)
        before = held.count()
        contested = with_batch(held, 0).unionByName(with_batch(batch.drop("day"), 1), allowMissingColumns=True)
        settled = dedupe_fact(contested, fact).select(*fact.stored_columns).withColumn("day", day_of(F.col(fact.event_date)))
        path = fact_path(root, fact)
        keys = partition_columns(spark, location(spark, path)) if opened(spark, path) else list(FACT_PARTITIONS)
        carried = 0
        if "day" not in keys:  # a table by month: its touched months are rewritten, with the rows of their other days
            rows = _by_day(spark, root, fact)
            month = F.col("year_month").eqNullSafe(F.lit(None)) | F.col("year_month").isin(sorted({d[:7] for d in days if d}))
            others = rows.where(month & ~F.coalesce(F.col("day").isin([d for d in days if d]), F.lit(None in days)))
            carried, settled = others.count(), settled.unionByName(others).drop("day")
        stored = write_partitioned(settled, path, keys, lookups=lookups) - carried
    return Loaded(before, read, stored, nulls, days=tuple(days))


def load_counters(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """The counter table, empty with its schema where there is none yet; ``months`` prunes partitions."""
    rows = read_current(spark, path)
    if rows is None:
        return spark.createDataFrame([], COUNTERS_SCHEMA)
    return (rows if months is None else rows.where(F.col("year_month").isin(list(months)))).drop("year_month")


def save_counters(counters: DataFrame, path: str, months: Sequence[str] | None = None) -> int:
    """Counters by month of their date; only ``months`` are replaced where they are given."""
    rows = counters.withColumn("year_month", month_of(F.col("date")))
    stored = read_current(counters.sparkSession, path)
    if months is not None and stored is not None and set(stored.columns) != set(rows.columns):
        # An older schema: the whole table is written in the current one.
        others = fill_counters(stored.where(~F.col("year_month").isin(list(months))))
        rows, months = others.unionByName(counters).withColumn("year_month", month_of(F.col("date"))), None
    return write_partitioned(rows, path, replace_all=months is None, owned=months or ())


def write_csv(rows: DataFrame, path: str, separator: str = ",", sort_by: Sequence[str] = ()) -> None:
    """CSV with header and quoting where needed; list columns become text. Readers see whole files only."""
    flat = [
        F.array_join(F.transform(f.name, lambda x: x.cast("string")), ",").alias(f.name)
        if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in rows.schema.fields
    ]
    out = rows.orderBy(*sort_by) if sort_by else rows
    (
        out.select(*flat).write.mode("overwrite")
        .option("header", True).option("sep", separator).option("escape", '"').csv(path)
    )


def partition_inventory(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number, first and last of the month partitions."""
    months = rows.where("year_month is not null").select(*by, "year_month").distinct()
    return months.groupBy(*by).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.min("year_month").alias("first_month"),
        F.max("year_month").alias("last_month"),
    )


def schema_diff(rows: DataFrame, expected: Sequence[str]) -> dict[str, list[str]]:
    """Expected columns that are missing, and columns that were not expected."""
    have, want = set(rows.columns), set(expected)
    return {"missing": sorted(want - have), "extra": sorted(have - want)}
