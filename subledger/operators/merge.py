"""Idempotent merges: append with dedupe, and replace by date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger import fixed_values as fixed
from subledger.functions import round_half_up
from subledger.operators.dedupe import dedupe_fact, with_batch
from subledger.operators.gaps import date_set
from subledger.schemas import COUNTERS_SCHEMA, Fact


def split_append(existing: DataFrame, incoming: DataFrame, fact: Fact) -> tuple[DataFrame, DataFrame]:
    """Stored rows the batch cannot touch, and the deduplicated rows of the days it touches.

    The key holds the event time, so a stored row can only collide with an incoming row of its own day.
    Rows of other days need no shuffle; only the touched days are shuffled for the dedupe.
    """
    day = F.to_date(F.col(fact.event_date))
    touched = date_set(incoming.select(day.alias("date"))).withColumnRenamed("date", "_day")
    same_day = day.eqNullSafe(F.col("_day"))
    aside = existing.join(touched, same_day, "left_anti").select(*fact.stored_columns)
    rivals = existing.join(touched, same_day, "left_semi").select(*fact.stored_columns)
    contested = with_batch(rivals, 0).unionByName(with_batch(incoming, 1), allowMissingColumns=True)
    return aside, dedupe_fact(contested, fact).select(*fact.stored_columns)


def append_rows(existing: DataFrame, incoming: DataFrame, fact: Fact) -> DataFrame:
    """``existing`` plus ``incoming``, one row per key, incoming rows winning."""
    aside, settled = split_append(existing, incoming, fact)
    return aside.unionByName(settled)


def fill_counters(rows: DataFrame) -> DataFrame:
    """Counter rows of an older or narrower schema, widened to the current one with zeros."""
    picked = []
    for field in COUNTERS_SCHEMA.fields:
        value = F.col(field.name) if field.name in rows.columns else F.lit(None)
        value = value.cast(field.dataType)
        if field.name in fixed.AMOUNT_COLUMNS:
            value = F.coalesce(round_half_up(value, 2), F.lit(0.0))
        elif field.name in fixed.COUNT_COLUMNS:
            value = F.coalesce(value, F.lit(0).cast("bigint"))
        picked.append(value.alias(field.name))
    return rows.select(*picked)


def merge_counters(existing: DataFrame, new: DataFrame, dates: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Replace every processed date by its new rows; other dates stay as they are.

    A processed date that has no rows any more loses its old ones. Merging the same rows twice gives
    the same table. ``dates`` has one ``date`` column; ``stamp`` goes into ``last_updated``.
    """
    stamp = stamp if stamp is not None else F.current_timestamp().cast("timestamp_ntz")
    kept = fill_counters(existing).join(date_set(dates), "date", "left_anti")
    kept = kept.withColumn("last_updated", F.coalesce("last_updated", stamp))
    fresh = fill_counters(new.drop("last_updated")).withColumn("last_updated", stamp)
    return kept.select(*COUNTERS_SCHEMA.fieldNames()).unionByName(fresh)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
