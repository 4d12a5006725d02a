"""Per-user reports, for one key or for all keys at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger import fixed_values as fixed
from subledger.functions import count_where, round_half_up
from subledger.operators.normalise import of_types
from subledger.operators.users import semi_keys

KEYS = ("subscription_id", "tmuserid", "msisdn")


def _of_key(rows: DataFrame, key: str, value) -> DataFrame:
    """Rows of one key value, or of all non-null keys where no value is given."""
    if key not in KEYS:
        raise ValueError(f"unknown key: {key}")
    return rows.where(F.col(key).isNotNull() if value is None else F.col(key) == F.lit(value))


def _by(key: str, value) -> list[str]:
    return [key] if value is None else []


# ---- over the lifecycle table --------------------------------------------------------------------

def user_subscriptions(subs: DataFrame, key: str, value) -> DataFrame:
    """All columns of a key's subscriptions, newest activation first."""
    return _of_key(subs, key, value).orderBy(F.desc_nulls_last("activation_date"), "subscription_id")


def user_summary(subs: DataFrame, key: str = "tmuserid", value=None) -> DataFrame:
    """Overall statistics of a key's subscriptions; one row per key where no value is given."""
    def status(name: str) -> Column:
        return count_where(F.col("subscription_status") == name)

    revenue = F.col("total_revenue")
    distinct = {"tmuserid": "unique_users", "msisdn": "unique_msisdns", "first_cpc": "unique_cpcs"}
    uniques = {
        # A subscription has one row, and the grouping key one value per group.
        "unique_subscriptions": F.count("subscription_id"),
        # Sets of one user's phones and codes: one pass, without a copy of each row per distinct count.
        **{name: F.size(F.collect_set(c)).cast("bigint") for c, name in distinct.items()},
    }
    if value is None and key in distinct:
        uniques[distinct[key]] = F.lit(1).cast("bigint")
    rows = _of_key(subs, key, value)
    return rows.groupBy(*_by(key, value)).agg(
        F.count(F.lit(1)).alias("total_subscriptions"),
        *[count.alias(name) for name, count in uniques.items()],
        F.sum("renewal_count").alias("total_renewals"),
        round_half_up(F.sum(revenue), 2).alias("total_revenue"),
        round_half_up(F.avg(revenue), 2).alias("avg_revenue_per_sub"),
        round_half_up(F.min(revenue), 2).alias("min_revenue"),
        round_half_up(F.max(revenue), 2).alias("max_revenue"),
        round_half_up(F.sum("total_refunded"), 2).alias("total_refunded"),
        F.sum("refund_count").alias("total_refunds"),
        F.min("activation_date").alias("first_subscription"),
        F.max("activation_date").alias("last_subscription"),
        status("Active").alias("active_subs"),
        status("Deactivated").alias("deactivated_subs"),
        status("Cancelled").alias("cancelled_subs"),
        count_where(F.col("has_upgraded")).alias("upgraded_subs"),
        count_where(F.col("missing_act_record")).alias("missing_act_records"),
        round_half_up(F.avg("lifetime_days"), 0).alias("avg_lifetime_days"),
    )


def user_cpc_breakdown(subs: DataFrame, key: str = "tmuserid", value=None) -> DataFrame:
    return _of_key(subs, key, value).groupBy(*_by(key, value), "first_cpc").agg(
        F.count(F.lit(1)).alias("subscription_count"),
        F.sum("renewal_count").alias("total_renewals"),
        round_half_up(F.sum("total_revenue"), 2).alias("total_revenue"),
        round_half_up(F.avg("total_revenue"), 2).alias("avg_revenue"),
        F.min("activation_date").alias("first_activation"),
        F.max("activation_date").alias("last_activation"),
    )


def user_status_breakdown(subs: DataFrame, key: str = "tmuserid", value=None) -> DataFrame:
    return _of_key(subs, key, value).groupBy(*_by(key, value), "subscription_status").agg(
        F.count(F.lit(1)).alias("count"),
        round_half_up(F.avg("lifetime_days"), 0).alias("avg_lifetime_days"),
        round_half_up(F.sum("total_revenue"), 2).alias("total_revenue"),
        round_half_up(F.avg("total_revenue"), 2).alias("avg_revenue"),
    )


def user_subscription_timeline(subs: DataFrame, key: str = "tmuserid", value=None) -> DataFrame:
    """The short form of a key's subscriptions, in order of activation; of all keys, unordered."""
    lines = _of_key(subs, key, value).select(
        "subscription_id", "tmuserid", "msisdn", "first_cpc", "activation_date", "last_activity_date", "end_date",
        "subscription_status", "lifetime_days", "renewal_count",
        round_half_up(F.col("total_revenue"), 2).alias("total_revenue"),
    )
    return lines if value is None else lines.orderBy(F.asc_nulls_last("activation_date"), "subscription_id")


# ---- over the transactions -----------------------------------------------------------------------

def user_id_mapping(tx: DataFrame, key: str = "msisdn", value=None) -> DataFrame:
    """Phone <-> user pairs, with the number of subscriptions they share.

    Pairs are first made distinct per subscription, so a phone shared by many is spread over them.
    """
    other = "tmuserid" if key == "msisdn" else "msisdn"
    held = _of_key(of_types(tx, "ACT", "RENO", "DCT"), key, value).select(key, other, "subscription_id").distinct()
    return held.groupBy(key, other).agg(F.count("subscription_id").alias("subscriptions"))


def subscription_keys(tx: DataFrame, key: str, value=None) -> DataFrame:
    """First hop: the subscriptions on which a key was activated, renewed or deactivated."""
    rows = _of_key(of_types(tx, "ACT", "RENO", "DCT"), key, value)
    return rows.where("subscription_id is not null").select("subscription_id").distinct()


def _reach(rows: DataFrame, tx: DataFrame, key: str, value) -> DataFrame:
    """Second hop: rows of those subscriptions."""
    return semi_keys(rows, "subscription_id", subscription_keys(tx, key, value))


def user_timeline(tx: DataFrame, key: str = "msisdn", value=None) -> DataFrame:
    """All transactions, purchases aside, of the subscriptions a key touches.

    Cancellations sort after the transaction types of a moment, refunds after those.
    """
    cnr, rfnd = F.col("tx_type") == "CNR", F.col("tx_type") == "RFND"
    code = F.when(cnr, fixed.CNR_SORT_CODE).when(rfnd, fixed.RFND_SORT_CODE).otherwise(F.col("trans_type_id"))
    lines = _reach(of_types(tx, "ACT", "RENO", "DCT", "CNR", "RFND"), tx, key, value).select(
        F.col("tx_type").alias("transaction_type"), code.cast("bigint").alias("trans_type_id"), "subscription_id",
        "trans_date", *[F.when(~(cnr | rfnd), F.col(c)).alias(c) for c in ("act_date", "reno_date")], "cpc",
        F.when(~rfnd, F.col("channel")).alias("channel"),
        F.when(~(cnr | rfnd), F.col("camp_name")).alias("camp_name"), "rev",
        F.when(cnr, F.col("channel")).alias("mode"), "rfnd_amount", "rfnd_cnt", "instant_rfnd",
    )
    if value is None:
        return lines
    return lines.orderBy("subscription_id", F.asc_nulls_last("trans_date"), "trans_type_id")


def timeline_summary(tx: DataFrame, key: str = "msisdn", value=None) -> DataFrame:
    """Per subscription: transactions of each type, revenue and refunded amount.

    For all keys the sums are made first, so the join sees one row per subscription.
    """
    lines = of_types(tx, "ACT", "RENO", "DCT", "CNR", "RFND")
    if value is not None:
        lines = _reach(lines, tx, key, value)
    kinds = ("ACT", "RENO", "DCT", "CNR", "RFND")
    sums = lines.where("subscription_id is not null").groupBy("subscription_id").agg(
        *[count_where(F.col("tx_type") == k).alias(f"{k.lower()}_count") for k in kinds],
        # Purchases are no part of the timeline, so this is activation and renewal revenue.
        round_half_up(F.coalesce(F.sum("rev"), F.lit(0.0)), 2).alias("total_rev"),
        round_half_up(F.coalesce(F.sum("rfnd_amount"), F.lit(0.0)), 2).alias("total_refunded"),
    )
    return _reach(sums, tx, key, None) if value is None else sums


def user_ppd(tx: DataFrame, key: str = "msisdn", value=None) -> DataFrame:
    """One-time purchases of a key, newest first."""
    rows = _of_key(of_types(tx, "PPD"), key, value).select(
        key, F.col("tx_type").alias("transaction_type"), "trans_type_id", "subscription_id", "trans_date", "cpc",
        "channel_id", "rev",
    )
    return rows if value is None else rows.orderBy(F.desc_nulls_last("trans_date"))


def user_ppd_total(tx: DataFrame, key: str = "msisdn", value=None) -> DataFrame:
    """Number of one-time purchases and their revenue per key."""
    return _of_key(of_types(tx, "PPD"), key, value).groupBy(key).agg(
        F.count(F.lit(1)).alias("purchases"),
        round_half_up(F.coalesce(F.sum("rev"), F.lit(0.0)), 2).alias("total_ppd_rev"),
    )
