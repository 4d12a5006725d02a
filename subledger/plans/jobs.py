"""Whole jobs over a folder of tables: load, append, backfill, lifecycle table, counters, user base.

Folder layout under ``root``::

    transactions/<type>/…/year_month=yyyy-MM/day=yyyy-MM-dd/   the six fact tables
    aggregated/subscriptions/…/               the lifecycle table, by activation month
    counters/by_cpc/…/year_month=yyyy-MM/     counters per date and product code
    counters/by_service/                      the same with service names, CSV
    user_base/rollups/…/snapshot_day=…/       user-base rollups of all levels
    user_base/by_service|by_category|by_cpc/  the same by level, pipe-separated CSV
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger import fixed_values as fixed
from subledger.functions import days_between
from subledger.operators.dedupe import dedupe_fact
from subledger.operators.gaps import backfill_rows, calendar, date_set, gap_ranges, missing_dates
from subledger.operators.merge import merge_counters
from subledger.operators.normalise import normalise
from subledger.operators.users import exclude_users
from subledger.plans.counters import counters_service, daily_counters
from subledger.plans.lifecycle import subscription_view
from subledger.plans.userbase import LEVELS, user_base_all_levels
from subledger.schemas import FACTS
from subledger.sources import csv, tables
from subledger.sources.snapshots import read_snapshots, snapshot_files
from subledger.sources.tables import Loaded


def transactions(root: str) -> str:
    return f"{root.rstrip('/')}/transactions"


def view_path(root: str) -> str:
    return f"{root.rstrip('/')}/aggregated/subscriptions"


def counters_path(root: str) -> str:
    return f"{root.rstrip('/')}/counters/by_cpc"


def tx_of(
    spark: SparkSession, root: str, months: Sequence[str] | None = None, days: Sequence[str] | None = None,
) -> DataFrame:
    """The normalised transactions of a folder."""
    return normalise(tables.read_facts(spark, transactions(root), months, days))


def load_historical(spark: SparkSession, folder: str, root: str, types: Sequence[str] = fixed.TX_TYPES) -> dict[str, Loaded]:
    """Full load: every file of a type, strictly typed, deduplicated, replacing the type's table.

    The files are parsed once, to a staging table. A load without a usable row leaves the table as it is.
    """
    done = {}
    for name in types:
        fact = FACTS[name]
        paths = csv.list_files(spark, folder, fact)
        if not paths:
            continue
        with tables.staged_copy(csv.read_flagged(spark, fact, paths)) as parsed:
            files = csv.file_counts(parsed)
            stored = tables.save_fact(dedupe_fact(csv.accepted(parsed), fact), transactions(root), fact, True, tables.fact_lookups(fact))
        rejected = {csv.plain_path(f["_file"]): f.bad for f in files if f.bad}
        done[name] = Loaded(0, sum(f.n for f in files if not f.bad), stored, rejected=rejected)
    return done


def append_daily(spark: SparkSession, folder: str, root: str, day: str, types: Sequence[str] = fixed.TX_TYPES) -> dict[str, Loaded]:
    """Append the day's file of every type that has one."""
    done, found = {}, {}
    for name in types:  # a file that cannot be taken stops the load before anything is stored
        path = csv.daily_file(spark, folder, FACTS[name], day)
        if path is not None:
            csv.check_arity(spark, FACTS[name], path)
            found[name] = path
    for name, path in found.items():
        fact = FACTS[name]
        done[name] = tables.append_batch(spark, transactions(root), fact, csv.read_lenient(spark, fact, path), tables.fact_lookups(fact))
    return done


def backfill(spark: SparkSession, folder: str, root: str, types: Sequence[str] = fixed.TX_TYPES, dry_run: bool = False) -> DataFrame | None:
    """Find the dates missing from each table up to its last stored or source date, and append them from the source.

    The source is parsed once, to a staging table; the stored dates are those of the partitions. Returns the missing runs
    per type (computed before anything is written), None where nothing could be compared.
    """
    runs = []
    for name in types:
        fact = FACTS[name]
        paths = csv.list_files(spark, folder, fact)
        held = tables.stored_days(spark, transactions(root), fact).select("date").where("date is not null")
        if not paths or held.isEmpty():
            continue
        with tables.staged_copy(csv.read_lenient(spark, fact, paths)) as source:
            last = source.select(F.max(F.to_date(fact.event_date))).first()[0]
            end = F.greatest(F.col("max_date"), F.lit(last))
            gaps = gap_ranges(missing_dates(held, end=end)).collect()  # bounded by the calendar
            runs += [(name, g.gap_start, g.gap_end, g.days) for g in gaps]
            if gaps and not dry_run:
                tables.append_batch(
                    spark, transactions(root), fact, backfill_rows(held, source, fact.event_date), tables.fact_lookups(fact))
    schema = "tx_type string, gap_start date, gap_end date, days bigint"
    return spark.createDataFrame(runs, schema) if runs else None


# The lifecycle table lies in buckets of subscriptions, so that a refresh rewrites the buckets of those it recomputes.
VIEW_BUCKETS = 64
VIEW_LOOKUPS = (*tables.LOOKUPS, "subscription_id")


def _bucketed(subs: DataFrame, as_of: str) -> DataFrame:
    bucket = F.format_string("%04d", F.pmod(F.xxhash64("subscription_id"), F.lit(VIEW_BUCKETS)))
    return subs.withColumn("as_of", F.lit(as_of).cast("date")).withColumn("bucket", bucket)


def build_view(spark: SparkSession, root: str, as_of: str, upgrade_rule: str = "code") -> int:
    """Rebuild the lifecycle table; returns its row count."""
    subs = subscription_view(tx_of(spark, root), as_of, upgrade_rule)
    return tables.write_partitioned(_bucketed(subs, as_of), view_path(root), partition="bucket", replace_all=True, lookups=VIEW_LOOKUPS)


def refresh_view(spark: SparkSession, root: str, as_of: str, days: Sequence[str | None], upgrade_rule: str = "code") -> int:
    """Recompute the subscriptions that have rows on the given days (of the appends since the last build; None: undated rows).

    Only those days are read to find them, only their transactions are aggregated, and only their buckets are rewritten.
    Returns the number of subscriptions recomputed. The result equals a rebuild: other subscriptions have no new rows, and
    ``load_view`` takes the lifetime of open ones at the newest ``as_of``.
    """
    if tables.opened(spark, view_path(root)) is None:
        return build_view(spark, root, as_of, upgrade_rule)
    tables.recover(spark, view_path(root))
    tx = tx_of(spark, root)
    new = normalise(tables.read_facts(spark, transactions(root), days=[d for d in days if d is not None]))
    if any(d is None for d in days):
        new = new.unionByName(tx.where(F.col("year_month").isNull()))
    touched = new.where("tx_type <> 'PPD'").select(F.col("subscription_id").alias("_id")).distinct()
    with tables.staged_copy(touched, "touched") as ids:
        mine = F.col("subscription_id").eqNullSafe(F.col("_id"))
        again = _bucketed(subscription_view(tx.join(ids, mine, "left_semi"), as_of, upgrade_rule), as_of)
        with tables.staged_copy(again, "recomputed") as fresh:
            # Buckets of the touched ids, also of those that have no row in the table (yet).
            buckets = [r.bucket for r in _bucketed(ids.withColumnRenamed("_id", "subscription_id"), as_of).select("bucket").distinct().collect()]
            stored = tables.read_current(spark, view_path(root)).where(F.col("bucket").isin(buckets))
            rows = stored.join(ids, mine, "left_anti").unionByName(fresh)
            tables.write_partitioned(rows, view_path(root), partition="bucket", owned=buckets, lookups=VIEW_LOOKUPS)
            return fresh.count()


def load_view(spark: SparkSession, root: str) -> DataFrame:
    """The lifecycle table; open subscriptions last until the newest ``as_of`` of a build or refresh."""
    rows = tables.read_current(spark, view_path(root))
    if rows is None:
        raise FileNotFoundError(f"no lifecycle table in {view_path(root)}: build-view makes it")
    newest = rows.agg(F.max("as_of")).scalar()
    lifetime = F.when(F.col("end_date").isNull(), days_between(F.col("activation_date"), newest)).otherwise(F.col("lifetime_days"))
    return rows.withColumn("lifetime_days", lifetime).select(*fixed.LIFECYCLE_COLUMNS)


def dates_to_process(spark: SparkSession, root: str, start: str | None = None, end: str | None = None, force: bool = False) -> DataFrame:
    """Dates whose counters are to be computed.

    With ``start`` (and ``end``): that day or range. Without: every date with transactions. Dates that have
    counters are left out unless ``force``.
    """
    existing = tables.load_counters(spark, counters_path(root))
    if start is None:
        # The days of the partitions; no transaction is read.
        found = tables.all_days(spark, transactions(root)).where("date is not null").select("date").distinct()
        return found if force else found.join(date_set(existing), "date", "left_anti")
    dates = calendar(spark, start, end or start)
    return dates if force else dates.join(existing.select("date").distinct(), "date", "left_anti")


def build_counters(
    spark: SparkSession,
    root: str,
    start: str | None = None,
    end: str | None = None,
    force: bool = False,
    phones: DataFrame | None = None,
    users: DataFrame | None = None,
    stamp: Column | None = None,
) -> int:
    """Compute and merge the counters of all requested dates in one job; returns the number of dates.

    Only those days are read from the facts, and only their months are rewritten in the counter table.
    """
    todo = [row.date for row in dates_to_process(spark, root, start, end, force).collect()]  # bounded by the calendar
    if not todo:
        return 0
    months = sorted({day.strftime("%Y-%m") for day in todo})
    dates = spark.createDataFrame([(day,) for day in todo], "date date")
    tx = exclude_users(tx_of(spark, root, days=[day.isoformat() for day in todo]), phones, users)
    existing = tables.load_counters(spark, counters_path(root), months)
    merged = merge_counters(existing, daily_counters(tx), dates, stamp)
    tables.save_counters(merged, counters_path(root), months)
    return len(todo)


def publish_services(
    spark: SparkSession, root: str, dim: DataFrame, excluded: Sequence[str] = fixed.EXCLUDED_SERVICE_KEYWORDS
) -> str:
    """Write the counters with their services as CSV, sorted; returns the path."""
    path = f"{root.rstrip('/')}/counters/by_service"
    rows = counters_service(tables.load_counters(spark, counters_path(root)), dim, excluded)
    tables.write_csv(rows, path, sort_by=["date", "service_name", "cpc"])
    return path


def rollups_path(root: str) -> str:
    return f"{root.rstrip('/')}/user_base/rollups"


def update_user_base(
    spark: SparkSession, folder: str, root: str, excluded: Sequence[str] = fixed.EXCLUDED_SERVICE_KEYWORDS,
    groups: Mapping[str, str] = fixed.CATEGORY_GROUPS, encoding: str = "UTF-8", force: bool = False,
) -> list[str]:
    """Roll up the snapshots whose dates have no rollups yet; returns the files that were read.

    The rollups of all levels are kept in a table by date. A file is known by the date in its name, so stored dates cost no
    read of their files; a date without a usable row is looked at again, and ``force`` reads all.
    """
    path = rollups_path(root)
    tables.recover(spark, path)
    current = tables.location(spark, path)
    held = set(tables.partition_names(spark, current)) if current and not force else set()
    new = [file for file, day in snapshot_files(spark, folder) if f"snapshot_day={day or tables.UNNAMED}" not in held]
    if new:
        levels = user_base_all_levels(read_snapshots(spark, new, encoding), groups, excluded)
        tables.write_partitioned(levels.withColumn("snapshot_day", F.col("date").cast("string")), path, "snapshot_day")
    return new


def load_user_base(spark: SparkSession, root: str, level: str) -> DataFrame:
    """One level of the stored rollups."""
    rows = tables.read_current(spark, rollups_path(root))
    if rows is None:
        raise FileNotFoundError(f"no rollups in {rollups_path(root)}: user-base makes them")
    return rows.where(F.col("level") == level).select(*LEVELS[level], "User_Base")


def build_user_base(
    spark: SparkSession, folder: str, root: str,
    excluded: Sequence[str] = fixed.EXCLUDED_SERVICE_KEYWORDS, encoding: str = "UTF-8", force: bool = False,
) -> dict[str, str]:
    """Bring the rollups up to date and write the three levels as pipe-separated CSV."""
    update_user_base(spark, folder, root, excluded, encoding=encoding, force=force)
    out = {}
    for level, keys in LEVELS.items():
        out[level] = f"{root.rstrip('/')}/user_base/by_{level}"
        tables.write_csv(load_user_base(spark, root, level), out[level], separator="|", sort_by=keys)
    return out
