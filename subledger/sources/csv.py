"""Typed scans of the CSV extracts.

Cells are read as text and cast with ``try_cast``, because the extracts use several null tokens and
two date formats. Files stay splittable; the reading position is carried for the ordered dedupe.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.functions import blank_to_null, month_of, parse_event_time
from subledger.operators.dedupe import dedupe_fact
from subledger.schemas import Fact

_RAGGED = "_ragged"


class AmbiguousFiles(ValueError):
    """More than one file could be the day's extract."""


def list_children(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern, sorted."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath()) for f in found) if found else []


def list_files(spark: SparkSession, folder: str, fact: Fact) -> list[str]:
    """All CSV files of a type, sorted by name."""
    return list_children(spark, f"{folder}/{fact.file_prefix}*.csv")


def daily_file(spark: SparkSession, folder: str, fact: Fact, day: str) -> str | None:
    """The day's file: one marked ``day``, else one holding ``yyyymmdd``, else the only one there is."""
    for mark in ("*day*", f"*{day.replace('-', '')}*"):
        found = list_children(spark, f"{folder}/{fact.file_prefix}{mark}.csv")
        if found:
            return found[0]
    found = list_files(spark, folder, fact)
    if len(found) > 1:
        raise AmbiguousFiles(f"{fact.name}: {len(found)} files fit {day}")
    return found[0] if found else None


def text_schema(fact: Fact) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in fact.columns])


def _scan(spark: SparkSession, fact: Fact, paths: str | Sequence[str]) -> DataFrame:
    """Text columns named by position, whatever the header says, plus the reading position."""
    raw_schema = text_schema(fact).add(_RAGGED, T.StringType())
    raw = (
        spark.read.schema(raw_schema)
        .option("header", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", _RAGGED)
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    return with_position(raw)


def with_place(raw: DataFrame) -> DataFrame:
    """File and block of each row of a file scan."""
    return raw.select(
        *raw.columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )


def with_position(raw: DataFrame) -> DataFrame:
    """File, block and row number, which together order the rows as they stand in the files."""
    return with_place(raw).withColumn("_row", F.monotonically_increasing_id())


def typed_cell(name: str, kind: T.DataType) -> Column:
    text = blank_to_null(F.col(name))
    if isinstance(kind, T.TimestampNTZType):
        return parse_event_time(text)
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def typed(raw: DataFrame, fact: Fact, *extra: str) -> DataFrame:
    """Cast every text cell to its registered type (a bad cell becomes null) and derive the month."""
    cells = [typed_cell(f.name, f.dataType).alias(f.name) for f in fact.schema.fields]
    return raw.select(*cells, *extra).withColumn("year_month", month_of(F.col(fact.event_date)))


def check_arity(spark: SparkSession, fact: Fact, path: str) -> None:
    """The header must have as many fields as the schema, since columns are matched by position."""
    header = spark.read.option("header", True).csv(path).columns
    if len(header) != len(fact.columns):
        raise ValueError(f"{fact.name}: {len(header)} columns in {path}, expected {len(fact.columns)}")


def read_lenient(spark: SparkSession, fact: Fact, paths: str | Sequence[str]) -> DataFrame:
    """Every row is kept; cells that do not fit their type are null."""
    return typed(_scan(spark, fact, paths), fact, "_file", "_block", "_row")


def _unfit(fact: Fact) -> Column:
    """Does a row break the strict rules: a number that does not parse, or the wrong number of fields?"""
    bad = F.col(_RAGGED).isNotNull()
    for field in fact.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.TimestampNTZType)):
            continue
        text = blank_to_null(F.col(field.name))
        bad = bad | (text.isNotNull() & text.try_cast(field.dataType).isNull())
    return bad


def rejected_files(spark: SparkSession, fact: Fact, paths: str | Sequence[str]) -> DataFrame:
    """Files the strict load leaves out, with the number of rows at fault."""
    raw = _scan(spark, fact, paths)
    return raw.where(_unfit(fact)).groupBy(F.col("_file").alias("file_path")).agg(
        F.count(F.lit(1)).alias("bad_rows")
    )


def plain_path(uri: str) -> str:
    """A file URI as a plain path: Spark reports local files with one slash or three, and percent-encoded."""
    return unquote(re.sub(r"^file:/+", "file:/", uri))


def rejections(spark: SparkSession, fact: Fact, paths: str | Sequence[str]) -> dict[str, int]:
    """Rejected files and their faulty rows on the driver; no more entries than the scan's own file listing."""
    return {plain_path(row.file_path): row.bad_rows for row in rejected_files(spark, fact, paths).collect()}


def read_strict(
    spark: SparkSession, fact: Fact, paths: str | Sequence[str], rejected: dict[str, int] | None = None
) -> DataFrame:
    """Only files without a faulty row, so that rejected ones are not opened again.

    ``rejected`` is the result of ``rejections``, found here where it is not given.
    """
    rejected = rejections(spark, fact, paths) if rejected is None else rejected
    raw = _scan(spark, fact, paths)
    if rejected:
        good = [f for f in map(plain_path, raw.inputFiles()) if f not in rejected]
        raw = _scan(spark, fact, good) if good else raw.where(F.lit(False))
    return typed(raw, fact, "_file", "_block", "_row")


def read_flagged(spark: SparkSession, fact: Fact, paths: str | Sequence[str]) -> DataFrame:
    """Every row, typed, with ``_unfit``: whether it breaks the strict rules. For loads that parse their files once."""
    return typed(_scan(spark, fact, paths).withColumn("_unfit", _unfit(fact)), fact, "_file", "_block", "_row", "_unfit")


def file_counts(flagged: DataFrame) -> list:
    """(file, rows, faulty rows) of each file with rows; no more entries than the scan's own file listing."""
    return flagged.groupBy("_file").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_unfit"), 1)).alias("bad")).collect()


def accepted(flagged: DataFrame) -> DataFrame:
    """Rows of the files without a faulty row."""
    bad = flagged.where("_unfit").select("_file").distinct()
    return flagged.join(bad, "_file", "left_anti").drop("_unfit")


def load_historical(spark: SparkSession, fact: Fact, paths: str | Sequence[str]) -> DataFrame:
    """The full load of a type: strict scan of all files, keep-last dedupe across them."""
    return dedupe_fact(read_strict(spark, fact, paths), fact).select(*fact.stored_columns)


def null_dates(rows: DataFrame, fact: Fact) -> DataFrame:
    """Null count of each date column after parsing; rows without event date go to the default partition."""
    dates = [f.name for f in fact.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return rows.agg(*[F.count(F.when(F.col(d).isNull(), 1)).alias(d) for d in dates])
