"""User-base snapshots: one CSV per day, dated by its file name."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.functions import whole_number
from subledger.sources.csv import list_children


def name_date(file_name: Column) -> Column:
    """``yyyymmdd…`` -> date; null where the name does not start with one."""
    digits = F.substring(file_name, 1, 8)
    dashed = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    return F.when(digits.rlike(r"^\d{8}$"), dashed.try_cast("date"))


def snapshot_files(spark: SparkSession, folder: str) -> list[tuple[str, str | None]]:
    """CSV files of a folder with the date in their name, sorted by name; no file is opened."""
    found = []
    for path in list_children(spark, f"{folder.rstrip('/')}/*.csv"):
        try:
            day = datetime.strptime(path.rpartition("/")[2][:8], "%Y%m%d").date().isoformat()
        except ValueError:
            day = None
        found.append((path, day))
    return found


def read_snapshots(spark: SparkSession, paths: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """date, service_name, tme_category, cpc, count of every usable snapshot row."""
    return clean_snapshot(_dated(spark, paths, encoding))


def rejected_rows(spark: SparkSession, paths: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """Snapshot rows that cannot be used, per date."""
    return rejected(_dated(spark, paths, encoding))


def _dated(spark: SparkSession, paths: str | list[str], encoding: str) -> DataFrame:
    raw = spark.read.option("header", True).option("escape", '"').option("encoding", encoding).csv(paths)
    return raw.select(*raw.columns, name_date(F.col("_metadata.file_name")).alias("date"))


def clean_snapshot(raw: DataFrame) -> DataFrame:
    """Trimmed names and numeric counts; rows without a usable code or count are dropped (see ``rejected``)."""
    return _numeric(raw).where("cpc is not null and count is not null")


def rejected(raw: DataFrame) -> DataFrame:
    """Rows dropped for an unusable code or count, per date."""
    bad = _numeric(raw).where("cpc is null or count is null")
    return bad.groupBy("date").agg(F.count(F.lit(1)).alias("rejected_rows"))


def _numeric(raw: DataFrame) -> DataFrame:
    return raw.select(
        "date", F.trim("service_name").alias("service_name"), F.trim("tme_category").alias("tme_category"),
        F.trim(F.col("cpc").cast("string")).try_cast("bigint").alias("cpc"),
        whole_number(F.trim(F.col("count").cast("string"))).alias("count"),
    )


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """A rollup written by ``build_user_base``: pipe-separated, with typed date, code and count."""
    raw = spark.read.option("header", True).option("sep", "|").option("escape", '"').csv(path)
    kinds = {"date": "date", "cpc": "bigint", "User_Base": "bigint"}
    return raw.select(*[F.col(c).try_cast(kinds.get(c, "string")).alias(c) for c in raw.columns])
