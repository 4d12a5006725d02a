"""Ordered deduplication: of the rows sharing a key, the newest one stays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.schemas import Fact

# Reading position of a row, carried from the scan to the dedupe.
POSITION = ("_batch", "_file", "_block", "_row")


def keep_last(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the greatest in ``order``; a null counts as a key value like any other.

    Filtering on row number 1 lets Spark prune each task to one row per key before the shuffle, so a
    key holding a large share of the rows costs its shuffle partition one row per map task.
    """
    newest = Window.partitionBy(*key).orderBy(*[c.desc_nulls_last() for c in order])
    return rows.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def dedupe_fact(rows: DataFrame, fact: Fact) -> DataFrame:
    """Keep-last on the type's key in reading order (batch, file name, place in the file)."""
    order = [F.col(c) for c in POSITION if c in rows.columns]
    return keep_last(rows, fact.key, order).drop(*POSITION)


def with_batch(rows: DataFrame, batch: int) -> DataFrame:
    """Stamp the batch rank and give rows without a reading position a neutral one."""
    out = rows.withColumn("_batch", F.lit(batch))
    for name, kind in (("_file", "string"), ("_block", "bigint"), ("_row", "bigint")):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(kind))
    return out


def duplicate_counts(rows: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys and surplus rows; counted through per-key partial sums, not a distinct set."""
    per_key = rows.groupBy(*by, *[c for c in key if c not in by]).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    return per_key.groupBy(*by).agg(
        total.alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
        (total - F.count(F.lit(1))).alias("duplicates"),
    )
