"""Data-quality checks of the transactions and of the lifecycle table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.functions import count_where, month_of, round_half_up
from subledger.operators.dedupe import duplicate_counts
from subledger.operators.gaps import distinct_dates, gap_ranges, missing_dates
from subledger.operators.normalise import of_types, tag_fact
from subledger.schemas import FACTS
from subledger.sources.tables import all_days, partition_counts, partition_inventory, read_fact

TX_KEY = ("subscription_id", "trans_date", "trans_type_id")


def _before(as_of: str) -> Column:
    return F.date_sub(F.lit(as_of).cast("date"), 1)


# ---- transactions ----------------------------------------------------------------------------------

def completeness_tx(tx: DataFrame, as_of: str, *types: str) -> DataFrame:
    """Days without a row, per type, from the type's first day to the day before ``as_of``."""
    dates = distinct_dates(of_types(tx, *(types or ("ACT", "RENO", "DCT"))), "trans_date", ["tx_type"])
    return missing_dates(dates, ["tx_type"], end=_before(as_of))


def completeness_ranges(tx: DataFrame, as_of: str, *types: str) -> DataFrame:
    return gap_ranges(completeness_tx(tx, as_of, *types), ["tx_type"])


def row_counts(tx: DataFrame) -> DataFrame:
    """Rows per type and in all."""
    return tx.rollup("tx_type").agg(F.count(F.lit(1)).alias("row_count"), F.grouping("tx_type").alias("g")).select(
        F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("tx_type")).alias("tx_type"), "row_count"
    )


def date_ranges(tx: DataFrame) -> DataFrame:
    return tx.groupBy("tx_type").agg(F.min("trans_date").alias("min_date"), F.max("trans_date").alias("max_date"))


def tx_partition_inventory(tx: DataFrame) -> DataFrame:
    return partition_inventory(tx, ["tx_type"])


def stored_row_counts(spark: SparkSession, root: str) -> DataFrame:
    """``row_counts`` of stored facts, from the files' footers: no transaction is read."""
    return _totals(partition_counts(spark, root))


def _totals(counts: DataFrame) -> DataFrame:
    return counts.rollup("tx_type").agg(F.sum("row_count").cast("bigint").alias("row_count"), F.grouping("tx_type").alias("g")).select(
        F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("tx_type")).alias("tx_type"), F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count")
    )


def stored_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``tx_partition_inventory`` of stored facts, from the files' footers."""
    return partition_inventory(partition_counts(spark, root), ["tx_type"])


def stored_date_ranges(spark: SparkSession, root: str) -> DataFrame:
    """``date_ranges`` of stored facts: the first and last day come from the footers, and only those two are read."""
    bounds = all_days(spark, root).groupBy("tx_type").agg(
        F.min("date").cast("string").alias("low"), F.max("date").cast("string").alias("high")).collect()  # six rows at most
    parts = [
        date_ranges(tag_fact(FACTS[b.tx_type.lower()], read_fact(spark, root, FACTS[b.tx_type.lower()], days=sorted({b.low, b.high}))))
        for b in bounds if b.low is not None
    ]
    undated = spark.createDataFrame([(b.tx_type,) for b in bounds if b.low is None], "tx_type string")
    empty = undated.select("tx_type", *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("min_date", "max_date")])
    return reduce(DataFrame.unionByName, parts, empty)


def tx_duplicates(tx: DataFrame) -> DataFrame:
    """Surplus rows per type on the dedupe key; cancellations and refunds have no type code, so theirs is shorter."""
    code = F.when(~F.col("tx_type").isin("CNR", "RFND"), F.col("trans_type_id"))
    return duplicate_counts(tx.withColumn("trans_type_id", code), TX_KEY, ["tx_type"])


def act_count_total(tx: DataFrame) -> DataFrame:
    return of_types(tx, "ACT").agg(F.count(F.lit(1)).alias("total_acts"))


def act_revenue_by_month(tx: DataFrame, k: int = 5) -> DataFrame:
    rows = of_types(tx, "ACT").groupBy("year_month").agg(
        F.count(F.lit(1)).alias("transactions"), round_half_up(F.sum("rev"), 2).alias("total_revenue")
    )
    return rows.orderBy(F.desc_nulls_last("year_month")).limit(k)


def latest_renewals(tx: DataFrame, k: int = 10) -> DataFrame:
    rows = of_types(tx, "RENO").orderBy(F.desc_nulls_last("trans_date"), F.desc("tie")).limit(k)
    return rows.select("tmuserid", "trans_date", "rev", "camp_name")


def cancellations_by_month(tx: DataFrame, k: int = 5) -> DataFrame:
    rows = of_types(tx, "CNR").groupBy("year_month").agg(F.count(F.lit(1)).alias("cancellations"))
    return rows.orderBy(F.desc_nulls_last("year_month")).limit(k)


def refund_totals(tx: DataFrame) -> DataFrame:
    return of_types(tx, "RFND").agg(
        F.count(F.lit(1)).alias("refund_count"), round_half_up(F.sum("rfnd_amount"), 2).alias("total_refunded")
    )


# ---- lifecycle table -------------------------------------------------------------------------------

LIFECYCLE_DATES = {
    "Activation": "activation_date", "Last Renewal": "last_renewal_date",
    "Deactivation": "deactivation_date", "Cancellation": "cancellation_date",
}


def _lifecycle_dates(subs: DataFrame) -> DataFrame:
    """The four dates as rows of (date_type, moment); one pass over the table."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("date_type"), F.col(column).alias("moment"))
        for name, column in LIFECYCLE_DATES.items()
    ])
    return subs.select(F.inline(pairs)).where("moment is not null")


def completeness_lifecycle(subs: DataFrame, as_of: str) -> DataFrame:
    """Days without an activation, last renewal, deactivation or cancellation, to the day before ``as_of``.

    Activations may lie before the recorded transactions, so they are checked from the first last-renewal date on.
    """
    dates = distinct_dates(_lifecycle_dates(subs), "moment", ["date_type"])
    since = dates.where("date_type = 'Last Renewal'").select(F.min("date")).scalar()
    start = F.when(F.col("date_type") == "Activation", F.greatest("min_date", since)).otherwise(F.col("min_date"))
    return missing_dates(dates, ["date_type"], start=start, end=_before(as_of))


def lifecycle_date_ranges(subs: DataFrame) -> DataFrame:
    return _lifecycle_dates(subs).groupBy("date_type").agg(
        F.min("moment").alias("min_date"), F.max("moment").alias("max_date"), F.count(F.lit(1)).alias("records")
    )


def quality_checks(subs: DataFrame) -> DataFrame:
    """Counts of duplicates, missing dates, upgrades, renewals and refunds."""
    ids = subs.groupBy("subscription_id").agg(
        F.count(F.lit(1)).alias("n"),
        count_where(F.col("missing_act_record")).alias("missing_act"),
        count_where(F.col("activation_date").isNull()).alias("undated"),
        count_where(F.col("has_upgraded")).alias("upgraded"),
        count_where(F.col("renewal_count") > 0).alias("renewed"),
        count_where(F.col("refund_count") > 0).alias("refunded"),
    )
    total, unique = F.sum("n"), F.count("subscription_id")
    return ids.agg(
        total.alias("total_subscriptions"), unique.alias("unique_subscription_ids"),
        (total - unique).alias("duplicate_subscription_ids"),
        F.sum("missing_act").alias("missing_act_records"), F.sum("undated").alias("null_activation_dates"),
        F.sum("upgraded").alias("upgraded_subscriptions"), F.sum("renewed").alias("subscriptions_with_renewals"),
        F.sum("refunded").alias("subscriptions_with_refunds"),
    )


def revenue_statistics(subs: DataFrame) -> DataFrame:
    def total(c: str) -> Column:
        return round_half_up(F.sum(c), 2)

    def mean(c: str) -> Column:
        return round_half_up(F.avg(c), 4)

    return subs.agg(
        F.count(F.lit(1)).alias("total_subscriptions"),
        total("activation_revenue").alias("total_activation_revenue"),
        total("renewal_revenue").alias("total_renewal_revenue"),
        total("total_revenue").alias("total_revenue"),
        total("total_refunded").alias("total_refunded"),
        mean("activation_revenue").alias("avg_activation_revenue"),
        mean("renewal_revenue").alias("avg_renewal_revenue"),
        mean("total_revenue").alias("avg_total_revenue"),
    )


def _recent_months(subs: DataFrame, column: str, as_of: str, months: int) -> DataFrame:
    """Rows from ``months`` before ``as_of`` on, with their month."""
    since = F.add_months(F.lit(as_of).cast("date"), -months).cast("timestamp_ntz")
    return subs.where(F.col(column) >= since).withColumn("month", month_of(F.col(column)))


def monthly_activations(subs: DataFrame, as_of: str, months: int = 12) -> DataFrame:
    """Users and codes are each counted through a distinct set per month, spread by their own values."""
    return _recent_months(subs, "activation_date", as_of, months).withColumn(
        "_code", F.try_element_at("cpc_list", F.lit(1))
    ).groupBy("month").agg(
        F.count(F.lit(1)).alias("activations"),
        round_half_up(F.sum("activation_revenue"), 2).alias("activation_revenue"),
        F.count_distinct("tmuserid").alias("unique_users"),
        F.count_distinct("_code").alias("unique_cpcs"),
    )


def monthly_renewals(subs: DataFrame, as_of: str, months: int = 12) -> DataFrame:
    return _recent_months(subs, "last_renewal_date", as_of, months).groupBy("month").agg(
        F.count(F.lit(1)).alias("subscriptions_with_renewals"),
        F.sum("renewal_count").alias("total_renewals"),
        round_half_up(F.sum("renewal_revenue"), 2).alias("renewal_revenue"),
        round_half_up(F.avg("renewal_count"), 4).alias("avg_renewals_per_subscription"),
    )


def _monthly_ends(subs: DataFrame, date: str, mode: str, name: str, as_of: str, months: int) -> DataFrame:
    return _recent_months(subs, date, as_of, months).groupBy("month").agg(
        F.count(F.lit(1)).alias(name),
        F.count_distinct(mode).alias("unique_modes"),
        round_half_up(F.avg("lifetime_days"), 4).alias("avg_lifetime_days"),
    )


def monthly_deactivations(subs: DataFrame, as_of: str, months: int = 12) -> DataFrame:
    return _monthly_ends(subs, "deactivation_date", "deactivation_mode", "deactivations", as_of, months)


def monthly_cancellations(subs: DataFrame, as_of: str, months: int = 12) -> DataFrame:
    return _monthly_ends(subs, "cancellation_date", "cancellation_mode", "cancellations", as_of, months)


def monthly_refunds(subs: DataFrame, as_of: str, months: int = 12) -> DataFrame:
    return _recent_months(subs, "last_refund_date", as_of, months).groupBy("month").agg(
        F.count(F.lit(1)).alias("subscriptions_with_refunds"),
        F.sum("refund_count").alias("total_refunds"),
        round_half_up(F.sum("total_refunded"), 2).alias("total_refunded_amount"),
        round_half_up(F.avg("total_refunded"), 4).alias("avg_refund_per_subscription"),
    )


def active_count(subs: DataFrame) -> DataFrame:
    return subs.where("subscription_status = 'Active'").agg(F.count(F.lit(1)).alias("active_subscriptions"))


def top_cpcs(subs: DataFrame, k: int = 10) -> DataFrame:
    rows = subs.groupBy("first_cpc").agg(
        F.count(F.lit(1)).alias("subscription_count"), round_half_up(F.sum("total_revenue"), 2).alias("total_revenue")
    )
    return rows.orderBy(F.desc("subscription_count"), F.asc_nulls_last("first_cpc")).limit(k)


def lifetime_by_status(subs: DataFrame) -> DataFrame:
    return subs.groupBy("subscription_status").agg(
        F.count(F.lit(1)).alias("count"),
        round_half_up(F.avg("lifetime_days"), 4).alias("avg_lifetime_days"),
        round_half_up(F.avg("total_revenue"), 4).alias("avg_revenue"),
    )


def recent_activations(subs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")
    rows = subs.where(F.col("activation_date") >= since)
    return rows.groupBy(F.to_date("activation_date").alias("date")).agg(
        F.count(F.lit(1)).alias("activations"), round_half_up(F.sum("activation_revenue"), 2).alias("revenue")
    )


def most_renewals(subs: DataFrame, k: int = 10) -> DataFrame:
    rows = subs.where("renewal_count > 0").orderBy(F.desc("renewal_count"), "subscription_id").limit(k)
    return rows.select("subscription_id", "tmuserid", "first_cpc", "renewal_count", "renewal_revenue",
                       "lifetime_days", "subscription_status")
