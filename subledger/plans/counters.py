"""Daily counters per product code, their merge into the history, and the join to services."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger import fixed_values as fixed
from subledger.functions import count_where, keyword_hit, month_of, round_half_up
from subledger.operators.gaps import date_set, distinct_dates
from subledger.operators.merge import fill_counters, merge_counters
from subledger.operators.normalise import of_types


def _is(kind: str) -> Column:
    return F.col("tx_type") == kind


def count_by_cpc(tx: DataFrame, *types: str) -> DataFrame:
    """Transactions per product code, optionally of some types only."""
    rows = of_types(tx, *types) if types else tx
    return rows.groupBy("cpc").agg(F.count(F.lit(1)).alias("tx_count"))


def non_upgrade(tx: DataFrame) -> DataFrame:
    """Rows whose channel is known and is not the upgrade channel."""
    return tx.where(F.col("channel") != fixed.UPGRADE_CHANNEL)


def on_dates(tx: DataFrame, dates: DataFrame) -> DataFrame:
    """Transactions of the given dates; the month rides along so that partitions can be pruned."""
    wanted = date_set(dates).select(F.col("date").alias("_date"), month_of(F.col("date")).alias("_month"))
    match = (F.col("year_month") == F.col("_month")) & (F.to_date("trans_date") == F.col("_date"))
    return tx.join(wanted, match, "left_semi")


def daily_counters(tx: DataFrame, keep_all_codes: bool = False) -> DataFrame:
    """One row per date and product code: counts per type, revenue and refunded amount.

    A code is listed for a date only if a row of it was counted there: an activation with a known
    channel, a non-upgrade deactivation, or any renewal, cancellation, purchase or refund. Revenue of all
    rows of a listed code is summed, upgrades included. ``keep_all_codes`` lists the other codes too.
    One aggregation over one scan; the partial sums are made before the shuffle, so a hot code is no
    hot partition.
    """
    upgrade = F.col("channel") == fixed.UPGRADE_CHANNEL
    regular = F.col("channel") != fixed.UPGRADE_CHANNEL
    act, dct = _is("ACT"), _is("DCT")
    counted = (act & (regular | upgrade)) | (dct & regular) | F.col("tx_type").isin("RENO", "CNR", "PPD", "RFND")
    refunds = F.sum(F.when(_is("RFND"), F.col("rfnd_cnt")))
    rows = tx.where("trans_date is not null and cpc is not null")
    out = rows.groupBy(F.to_date("trans_date").alias("date"), "cpc").agg(
        count_where(act & regular).alias("act_count"),
        count_where(act & regular & (F.col("rev") == 0)).alias("act_free"),
        count_where(act & regular & (F.col("rev") > 0)).alias("act_pay"),
        count_where(act & upgrade).alias("upg_count"),
        count_where(_is("RENO")).alias("reno_count"),
        count_where(dct & regular).alias("dct_count"),
        count_where(dct & upgrade).alias("upg_dct_count"),
        count_where(_is("CNR")).alias("cnr_count"),
        count_where(_is("PPD")).alias("ppd_count"),
        F.coalesce(refunds, F.lit(0)).cast("bigint").alias("rfnd_count"),
        round_half_up(F.coalesce(F.sum("rfnd_amount"), F.lit(0.0)), 2).alias("rfnd_amount"),
        round_half_up(F.coalesce(F.sum("rev"), F.lit(0.0)), 2).alias("rev"),
        count_where(counted).alias("_counted"),
    )
    if not keep_all_codes:
        out = out.where("_counted > 0")
    return out.select(*fixed.COUNTER_COLUMNS)


def missing_counter_dates(tx: DataFrame, counters: DataFrame) -> DataFrame:
    """Transaction dates that have no counters yet."""
    return distinct_dates(tx, "trans_date").join(date_set(counters), "date", "left_anti")


def counters_incremental(
    tx: DataFrame,
    existing: DataFrame,
    dates: DataFrame | None = None,
    force: bool = False,
    stamp: Column | None = None,
    discover_in: DataFrame | None = None,
) -> DataFrame:
    """The counter history after processing ``dates``, in one job for all of them.

    Without ``dates``, the transaction dates are discovered. Dates already present are skipped unless
    ``force``. ``discover_in`` is the transaction view before user exclusion, where discovery looks.
    """
    if dates is None:
        dates = distinct_dates(discover_in if discover_in is not None else tx, "trans_date")
    todo = dates if force else dates.join(date_set(existing), "date", "left_anti")
    return merge_counters(existing, daily_counters(on_dates(tx, todo)), todo, stamp)


def with_service(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Left join to the product dimension; an unmapped code belongs to the service UNKNOWN."""
    return rows.join(dim, "cpc", "left").withColumns({
        "service_name": F.coalesce("service_name", F.lit("UNKNOWN")),
        "tme_category": F.coalesce("tme_category", F.lit("")),
        "cpc_period": F.coalesce("cpc_period", F.lit(0).cast("bigint")),
        "cpc_price": F.coalesce("cpc_price", F.lit(0.0)),
    })


def counters_service(
    counters: DataFrame, dim: DataFrame, excluded: Sequence[str] = fixed.EXCLUDED_SERVICE_KEYWORDS
) -> DataFrame:
    """Counters with their service, services named by an excluded keyword left out."""
    joined = with_service(fill_counters(counters), dim)
    return joined.where(~keyword_hit(F.col("service_name"), excluded)).select(*fixed.SERVICE_COLUMNS)


def unmapped_cpcs(counters: DataFrame, dim: DataFrame) -> DataFrame:
    """Codes with counters but without a dimension row, over all dates at once."""
    codes = counters.where("cpc is not null").select("cpc").distinct()
    return codes.join(dim.select("cpc"), "cpc", "left_anti")


def service_rollup(
    counters: DataFrame, dim: DataFrame, excluded: Sequence[str] = fixed.EXCLUDED_SERVICE_KEYWORDS
) -> DataFrame:
    """Counters summed per date, service and category, with the codes that went in as sorted text."""
    rows = counters_service(counters, dim, excluded)
    sums = [F.sum(c).cast("bigint").alias(c) for c in fixed.COUNT_COLUMNS]
    amounts = [round_half_up(F.sum(c), 2).alias(c) for c in fixed.AMOUNT_COLUMNS]
    lowest = F.min(F.struct("cpc", "cpc_period", "cpc_price"))
    # Per date and code there is one row, so the list of a service is as long as its codes.
    out = rows.groupBy("date", "service_name", "tme_category").agg(
        F.array_sort(F.collect_set("cpc")).alias("cpcs"), *sums, *amounts, lowest.alias("first")
    )
    return out.select(
        "date", "service_name", "tme_category",
        F.array_join(F.transform("cpcs", lambda x: x.cast("string")), ", ").alias("cpcs"),
        F.col("first.cpc_period").alias("cpc_period"),
        F.col("first.cpc_price").alias("cpc_price"),
        *fixed.COUNT_COLUMNS, *fixed.AMOUNT_COLUMNS,
    )


def counter_totals(counters: DataFrame) -> DataFrame:
    """Per date: codes processed and the sum of each type's counter."""
    kinds = [f"{t}_count" for t in fixed.TX_TYPES]
    return counters.groupBy("date").agg(
        F.count(F.lit(1)).alias("cpcs_processed"), *[F.sum(k).cast("bigint").alias(k) for k in kinds]
    )
