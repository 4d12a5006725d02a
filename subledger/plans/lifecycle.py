"""The subscription lifecycle table and the single steps it consists of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger import fixed_values as fixed
from subledger.functions import count_where, days_between, earliest, latest
from subledger.operators.normalise import of_types

# ---- single steps ----------------------------------------------------------------------------

def all_transactions(tx: DataFrame) -> DataFrame:
    """Activations and renewals under one set of columns."""
    return of_types(tx, "ACT", "RENO").select(
        "subscription_id", "tmuserid", "msisdn", "cpc", "trans_type_id", "trans_date", "act_date", "reno_date",
        "camp_name", "channel", "rev", "year_month", F.col("tx_type").alias("transaction_type"), "tie",
    )


def _pick(rows: DataFrame, first: bool) -> DataFrame:
    """First or last row per subscription; row number 1 is pruned per task before the shuffle."""
    at = F.asc_nulls_last("trans_date") if first else F.desc_nulls_last("trans_date")
    tie = F.asc("tie") if first else F.desc("tie")
    rank = F.row_number().over(Window.partitionBy("subscription_id").orderBy(at, tie))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_transaction(tx: DataFrame) -> DataFrame:
    return _pick(of_types(tx, "ACT", "RENO"), True).select(
        "subscription_id", "tmuserid", "msisdn", F.col("cpc").alias("first_cpc"),
        F.col("act_date").alias("activation_date"), F.col("trans_date").alias("first_trans_date"),
        F.col("camp_name").alias("activation_campaign"), F.col("channel").alias("activation_channel"),
        F.col("year_month").alias("activation_month"),
    )


def actual_activation(tx: DataFrame) -> DataFrame:
    return _pick(of_types(tx, "ACT"), True).select(
        "subscription_id", F.col("trans_date").alias("actual_act_trans_date"),
        F.col("rev").alias("activation_revenue"), F.col("cpc").alias("act_cpc"),
    )


def upgrade_condition(rule: str) -> Column:
    """Which activations count as upgrades: by type code (``code``) or by channel (``channel``)."""
    if rule == "code":
        return F.col("trans_type_id") == fixed.SOURCE_TYPE_CODES["act"]
    if rule == "channel":
        return F.col("channel") == fixed.UPGRADE_CHANNEL
    raise ValueError(f"unknown upgrade rule: {rule}")


def last_upgrade(tx: DataFrame, upgrade_rule: str = "code") -> DataFrame:
    return _pick(of_types(tx, "ACT").where(upgrade_condition(upgrade_rule)), False).select(
        "subscription_id", F.col("cpc").alias("new_cpc"), F.col("trans_date").alias("upgrade_date"),
        F.col("rev").alias("upgrade_revenue"),
    )


def current_cpc(tx: DataFrame) -> DataFrame:
    return _pick(of_types(tx, "ACT", "RENO"), False).select("subscription_id", F.col("cpc").alias("current_cpc"))


def last_deactivation(tx: DataFrame) -> DataFrame:
    rows = of_types(tx, "DCT").where(F.col("channel") != fixed.UPGRADE_CHANNEL)
    return _pick(rows, False).select(
        "subscription_id", F.col("trans_date").alias("deactivation_date"),
        F.col("channel").alias("deactivation_mode"),
    )


def last_cancellation(tx: DataFrame) -> DataFrame:
    return _pick(of_types(tx, "CNR"), False).select(
        "subscription_id", F.col("trans_date").alias("cancellation_date"),
        F.col("channel").alias("cancellation_mode"),
    )


def renewal_agg(tx: DataFrame) -> DataFrame:
    return of_types(tx, "RENO").groupBy("subscription_id").agg(
        F.count(F.lit(1)).alias("total_renewals"), F.sum("rev").alias("total_renewal_revenue"),
        F.max("trans_date").alias("last_renewal_date"), F.min("trans_date").alias("first_renewal_date"),
    )


def refund_agg(tx: DataFrame) -> DataFrame:
    return of_types(tx, "RFND").groupBy("subscription_id").agg(
        F.count(F.lit(1)).alias("refund_count"), F.sum("rfnd_amount").alias("total_refunded"),
        F.max("trans_date").alias("last_refund_date"),
    )


def _seen_entry(seen: Column, cpc: Column) -> Column:
    """List entry that sorts by first sight, undated last, and keeps a null code."""
    return F.struct(seen.isNull().alias("undated"), seen.alias("seen"), cpc.isNull().alias("uncoded"), cpc.alias("cpc"))


def _codes(entries: Column) -> Column:
    return F.transform(F.array_sort(entries), lambda e: e["cpc"])


def cpc_list(tx: DataFrame) -> DataFrame:
    """Product codes of each subscription in order of first sight; equal dates order by code.

    The codes are made distinct before they are gathered, so a list is as long as the codes a
    subscription ever had.
    """
    seen = of_types(tx, "ACT", "RENO").groupBy("subscription_id", "cpc").agg(F.min("trans_date").alias("seen"))
    return seen.groupBy("subscription_id").agg(
        _codes(F.collect_list(_seen_entry(F.col("seen"), F.col("cpc")))).alias("cpc_list"),
        F.count("cpc").alias("cpc_count"),
    )


# ---- the lifecycle table ---------------------------------------------------------------------

def subscription_view(tx: DataFrame, as_of: str, upgrade_rule: str = "code") -> DataFrame:
    """One row per subscription that has an activation or a renewal; 34 columns.

    One aggregation by subscription for all measures, and one for the list of codes; both are keyed and
    partitioned by subscription, so their join adds no shuffle. Every measure is a minimum, maximum, sum
    or count and combines before the shuffle: a subscription holding a large share of the rows sends one
    row per task. ``as_of`` ends the lifetime of open subscriptions.

    Status and end date look at the existence of a cancellation or deactivation, not at its order
    relative to renewals, so a lifetime can be negative.
    """
    at, tie = F.col("trans_date"), F.col("tie")
    act, reno, dct = F.col("tx_type") == "ACT", F.col("tx_type") == "RENO", F.col("tx_type") == "DCT"
    cnr, rfnd = F.col("tx_type") == "CNR", F.col("tx_type") == "RFND"
    paid = act | reno
    # Only activations and renewals open a subscription; facts without an id attach to none.
    rows = tx.where(paid | ((dct | cnr | rfnd) & F.col("subscription_id").isNotNull()))
    opening = earliest(at, tie, "tmuserid", "msisdn", "cpc", "act_date", "camp_name", "channel", "year_month")
    measures = rows.groupBy("subscription_id").agg(
        F.min(F.when(paid, opening)).alias("opening"),
        F.min(F.when(act, earliest(at, tie, "rev"))).alias("first_act"),
        F.max(F.when(act & upgrade_condition(upgrade_rule), latest(at, tie, "cpc", "rev"))).alias("upgrade"),
        F.max(F.when(paid, latest(at, tie, "cpc"))).alias("newest"),
        F.max(F.when(dct & (F.col("channel") != fixed.UPGRADE_CHANNEL), latest(at, tie, "channel"))).alias("dct"),
        F.max(F.when(cnr, latest(at, tie, "channel"))).alias("cnr"),
        count_where(reno).alias("renewals"),
        F.sum(F.when(reno, F.col("rev"))).alias("renewal_rev"),
        F.max(F.when(reno, at)).alias("last_reno"),
        F.min(F.when(reno, at)).alias("first_reno"),
        count_where(rfnd).alias("refunds"),
        F.sum(F.when(rfnd, F.col("rfnd_amount"))).alias("refunded"),
        F.max(F.when(rfnd, at)).alias("last_rfnd"),
    ).where("opening is not null")
    per_sub = measures.join(cpc_list(tx), "subscription_id", "left")

    # Rows without a subscription id share one output row that nothing is attached to.
    known = F.col("subscription_id").isNotNull()

    def attached(value: Column) -> Column:
        return F.when(known, value)

    def or_zero(value: Column) -> Column:
        return F.coalesce(attached(value), F.lit(0.0))

    o = F.col("opening")
    cancelled, deactivated = attached(F.col("cnr.at")), attached(F.col("dct.at"))
    act_rev, reno_rev = or_zero(F.col("first_act.rev")), or_zero(F.col("renewal_rev"))
    columns = {
        "subscription_id": F.col("subscription_id"),
        "tmuserid": o["tmuserid"],
        "msisdn": o["msisdn"],
        "cpc_list": F.col("cpc_list"),
        "cpc_count": F.col("cpc_count"),
        "first_cpc": o["cpc"],
        "current_cpc": attached(F.col("newest.cpc")),
        "has_upgraded": F.coalesce(F.col("cpc_count") > 1, F.lit(False)),
        "upgrade_date": attached(F.col("upgrade.at")),
        "upgraded_to_cpc": attached(F.col("upgrade.cpc")),
        "activation_date": o["act_date"],
        "activation_trans_date": F.coalesce(attached(F.col("first_act.at")), o["at"]),
        "missing_act_record": ~known | F.col("first_act").isNull(),
        "activation_campaign": o["camp_name"],
        "activation_channel": o["channel"],
        "activation_revenue": act_rev,
        "activation_month": o["year_month"],
        "renewal_count": F.coalesce(attached(F.col("renewals")), F.lit(0).cast("bigint")),
        "renewal_revenue": reno_rev,
        "last_renewal_date": attached(F.col("last_reno")),
        "first_renewal_date": attached(F.col("first_reno")),
        "last_activity_date": F.coalesce(attached(F.col("last_reno")), o["act_date"]),
        "deactivation_date": deactivated,
        "deactivation_mode": attached(F.col("dct.channel")),
        "cancellation_date": cancelled,
        "cancellation_mode": attached(F.col("cnr.channel")),
        "refund_count": F.coalesce(attached(F.col("refunds")), F.lit(0).cast("bigint")),
        "total_refunded": or_zero(F.col("refunded")),
        "last_refund_date": attached(F.col("last_rfnd")),
        "total_revenue": act_rev + reno_rev,
        "total_revenue_with_upgrade": act_rev + reno_rev + or_zero(F.col("upgrade.rev")),
        "subscription_status": F.when(cancelled.isNotNull(), "Cancelled")
        .when(deactivated.isNotNull(), "Deactivated").otherwise("Active"),
        "lifetime_days": days_between(
            o["act_date"], F.coalesce(cancelled, deactivated, F.lit(as_of).cast("timestamp_ntz"))),
        "end_date": F.coalesce(cancelled, deactivated),
    }
    return per_sub.select(*[columns[name].alias(name) for name in fixed.LIFECYCLE_COLUMNS])
