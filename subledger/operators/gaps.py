"""Calendar work: which dates are present, which are missing, and in what runs.

Everything after the first distinct is bounded by the calendar (one row per day and type).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

def date_set(dates: DataFrame) -> DataFrame:
    """Distinct dates as the small side of a join.

    The hint is safe by the domain and not by the data: there is at most one row per calendar day, however
    many rows the dates come from. Without it, size estimates would shuffle the fact side by day.
    """
    return F.broadcast(dates.select("date").distinct())


def distinct_dates(rows: DataFrame, moment: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """Distinct event dates, undated rows left out."""
    day = F.to_date(F.col(moment) if isinstance(moment, str) else moment)
    return rows.select(*by, day.alias("date")).where(F.col("date").isNotNull()).distinct()


def date_range(rows: DataFrame, moment: str, by: Sequence[str] = ()) -> DataFrame:
    """First and last event date."""
    day = F.to_date(F.col(moment))
    return rows.groupBy(*by).agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every date from start to end, both included."""
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(span).alias("date"))


def missing_dates(
    dates: DataFrame,
    by: Sequence[str] = (),
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Dates between the first present date (or ``start``) and the last one (or ``end``) that are absent.

    ``start`` and ``end`` may refer to the columns ``min_date`` and ``max_date`` of each group. A group's
    present dates, at most one per calendar day, are kept as a set, so one scan gives bounds and gaps.
    """
    present = dates.groupBy(*by).agg(F.collect_set("date").alias("have")).withColumns(
        {"min_date": F.array_min("have"), "max_date": F.array_max("have")}
    )
    low = start if start is not None else F.col("min_date")
    high = end if end is not None else F.col("max_date")
    span = F.sequence("lo", "hi", F.expr("interval 1 day"))
    return (
        present.select(*by, "have", low.alias("lo"), high.alias("hi")).where("lo <= hi")
        .select(*by, F.explode(F.array_except(span, F.col("have"))).alias("date"))
    )


def gap_ranges(missing: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Runs of consecutive dates: within a run, date minus its row number is constant."""
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy("date")
    island = F.date_sub(F.col("date"), F.row_number().over(order))
    return (
        missing.select(*by, "date", island.alias("_island"))
        .groupBy(*by, "_island")
        .agg(
            F.min("date").alias("gap_start"),
            F.max("date").alias("gap_end"),
            F.count(F.lit(1)).alias("days"),
        )
        .drop("_island")
    )


def backfill_rows(existing_dates: DataFrame, source: DataFrame, moment: str) -> DataFrame:
    """Source rows of the dates missing between the first stored date and the last stored or source date."""
    last_source = source.select(F.max(F.to_date(moment)).alias("m")).scalar()
    gaps = missing_dates(existing_dates, end=F.greatest(F.col("max_date"), last_source))
    gaps = date_set(gaps)
    return source.join(gaps, F.to_date(source[moment]) == gaps["date"], "left_semi")
