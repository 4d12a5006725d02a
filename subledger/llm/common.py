"""Helpers the operators share: input tables, stored intermediate tables, counts of words."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.session import scratch_path

SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
KEY_BITS = 63
# Files of a stored table that holds one row per group.
FEW = 8


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A whole input table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(rows: DataFrame, label: str, files: int | None = None, numeric: bool = False, codec: str | None = None) -> DataFrame:
    """The rows, written to the shared folder and read again: their lineage ends there.

    What a lost executor held is read again from these files, never drawn or numbered anew. ``files`` bounds the
    number of files of a table that has been aggregated to little; ``numeric`` leaves out the compression, which
    gains nothing on hashes and floating point numbers and holds memory outside the heap for every column read;
    ``codec`` names another compression than the session's.
    """
    path = scratch_path(rows.sparkSession, label)
    if files:
        rows = rows.coalesce(files)
    rows.write.parquet(path, compression="uncompressed" if numeric or files else codec)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets the driver forget finished work: shuffle files and memory of the plans stay until it collects its garbage."""
    for _ in range(2):  # Python's objects first hold those of the JVM
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def key63(*parts: Column | int) -> Column:
    """A seeded hash of the parts, as a non-negative long."""
    return F.shiftrightunsigned(F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), 1)


def uniform(*parts: Column | int) -> Column:
    """A seeded uniform double in (0, 1)."""
    return (F.shiftright(key63(*parts), 10).cast("double") + 0.5) * (2.0 ** -53)


def count_words(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def keeping(rows: DataFrame, *replaced: str) -> list[Column]:
    """All columns except those with one of the names, whatever their case."""
    names = {name.lower() for name in replaced}
    return [F.col(f"`{c}`") for c in rows.columns if c.lower() not in names]
