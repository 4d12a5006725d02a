"""Statistics of the lifecycle table, refunds, revenue, cohorts and category extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subledger.functions import (
    count_where, list_has_any, month_of, parse_day, percent_of, round_half_up,
)


# ---- statistics of the lifecycle table ---------------------------------------------------------

def share_by(subs: DataFrame, column: str, count_name: str = "count") -> DataFrame:
    """Groups of a column with their count and percentage of all rows; the window runs over the groups only."""
    counts = subs.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))
    total = F.sum(count_name).over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("percentage", percent_of(F.col(count_name), total))


def status_distribution(subs: DataFrame) -> DataFrame:
    return share_by(subs, "subscription_status")


def missing_act_distribution(subs: DataFrame) -> DataFrame:
    return share_by(subs, "missing_act_record")


def cpc_count_distribution(subs: DataFrame) -> DataFrame:
    return share_by(subs, "cpc_count", "subscriptions")


def upgrade_statistics(subs: DataFrame) -> DataFrame:
    return subs.groupBy("has_upgraded").agg(
        F.count(F.lit(1)).alias("count"),
        round_half_up(F.avg("total_revenue_with_upgrade"), 2).alias("avg_revenue"),
    )


def revenue_summary(subs: DataFrame) -> DataFrame:
    return subs.agg(
        F.count(F.lit(1)).alias("total_subscriptions"),
        round_half_up(F.sum("total_revenue"), 2).alias("total_revenue"),
        round_half_up(F.avg("total_revenue"), 2).alias("avg_revenue_per_sub"),
        round_half_up(F.avg("renewal_count"), 2).alias("avg_renewals"),
        round_half_up(F.avg("lifetime_days"), 1).alias("avg_lifetime_days"),
    )


def top_campaigns(subs: DataFrame, k: int = 5) -> DataFrame:
    """Campaigns by revenue."""
    rows = subs.where("activation_campaign is not null").groupBy("activation_campaign").agg(
        F.count(F.lit(1)).alias("subscriptions"),
        round_half_up(F.sum("total_revenue"), 2).alias("revenue"),
        round_half_up(F.avg("lifetime_days"), 1).alias("avg_lifetime"),
    )
    return rows.orderBy(F.desc("revenue"), "activation_campaign").limit(k)


def monthly_activation_stats(subs: DataFrame, k: int = 6) -> DataFrame:
    """The latest activation months."""
    rows = subs.groupBy("activation_month").agg(
        F.count(F.lit(1)).alias("new_subscriptions"),
        round_half_up(F.sum("activation_revenue"), 2).alias("revenue"),
        count_where(F.col("has_upgraded")).alias("upgrades"),
    )
    return rows.orderBy(F.desc_nulls_last("activation_month")).limit(k)


def sample_upgraded(subs: DataFrame, k: int = 3) -> DataFrame:
    return subs.where("has_upgraded").orderBy("subscription_id").limit(k).select(
        "subscription_id", "cpc_list", "cpc_count", "first_cpc", "current_cpc", "upgrade_date", "activation_date",
        "renewal_count", "total_revenue_with_upgrade", "subscription_status",
    )


def sample_missing_act(subs: DataFrame, k: int = 3) -> DataFrame:
    return subs.where("missing_act_record").orderBy("subscription_id").limit(k).select(
        "subscription_id", "cpc_list", "activation_date", "activation_trans_date", "missing_act_record",
        "renewal_count", "total_revenue", "subscription_status",
    )


# ---- refunds and revenue -----------------------------------------------------------------------

def refund_analysis(rfnd: DataFrame, dim: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Refunds per month and code: amount, count and distinct users, in all and by regular/automatic.

    Users are counted by first grouping per user, which spreads a hot code over its users and makes
    every distinct count a plain sum. A null user counts as one user.
    """
    rows = rfnd if months is None else rfnd.where(F.col("year_month").isin(list(months)))
    per_user = rows.groupBy("year_month", "cpc", "tmuserid").agg(
        F.sum("rfnd_amount").alias("amount"), F.sum("rfnd_cnt").alias("cnt"),
        F.max(F.when(F.col("instant_rfnd") == "f", 1)).alias("regular"),
        F.max(F.when(F.col("instant_rfnd") == "t", 1)).alias("automatic"),
    )
    out = per_user.groupBy("year_month", "cpc").agg(
        round_half_up(F.coalesce(F.sum("amount"), F.lit(0.0)), 2).alias("cpcTotalRfdsAmount"),
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("cpcTotalRfdsCount"),
        F.count(F.lit(1)).alias("cpcTotalRfdsCountUU"),
        F.count("regular").alias("RegularRfdsUU"),
        F.count("automatic").alias("AutomaticRfdsUU"),
    )
    named = out.join(dim.select("cpc", "service_name", "tme_category"), "cpc", "left")
    return named.select(
        "year_month", "cpc", "service_name", "tme_category", "cpcTotalRfdsAmount", "cpcTotalRfdsCount",
        "cpcTotalRfdsCountUU", "RegularRfdsUU", "AutomaticRfdsUU",
    ).orderBy("year_month", F.desc("cpcTotalRfdsCount"))


def revenue_pivot(counters: DataFrame, services: DataFrame | Sequence[str], months: Sequence[str]) -> DataFrame:
    """Revenue by service and month with a row total; a requested pair without data shows 0.

    ``counters`` is the service counter table; its date may be text, and unparseable dates are skipped.
    """
    if not isinstance(services, DataFrame):
        spark = counters.sparkSession
        services = spark.range(1).select(F.explode(F.array(*map(F.lit, services))).alias("service_name"))
    wanted = services.select(F.trim("service_name").alias("service_name")).distinct()
    day = F.col("date") if dict(counters.dtypes)["date"] == "date" else parse_day(F.trim("date"))
    months = sorted(months)
    revenue = (
        counters.select(F.trim("service_name").alias("service_name"), month_of(day).alias("month"), "rev")
        .where(F.col("month").isin(months))
        .groupBy("service_name").pivot("month", months).agg(F.sum("rev"))
    )
    filled = [F.coalesce(F.col(m), F.lit(0.0)) for m in months]
    total = sum(filled[1:], filled[0])
    return wanted.join(revenue, "service_name", "left").select(
        "service_name", *[round_half_up(c, 2).alias(m) for c, m in zip(filled, months)],
        round_half_up(total, 2).alias("TOTAL"),
    )


# ---- cohorts and categories ----------------------------------------------------------------------

def cohort_lt_ltv(subs: DataFrame, dim: DataFrame, service: str | None = None, month: str | None = None) -> DataFrame:
    """Subscriptions, mean lifetime and mean value per service and activation month.

    A subscription belongs to a service if any code it ever had is one of the service's, whatever the
    case of the name. All services and months unless one is given.
    """
    codes = dim.select("cpc", F.lower("service_name").alias("service"))
    if service is not None:
        codes = codes.where(F.col("service") == service.lower())
    if month is not None:
        subs = subs.where(F.col("activation_month") == month)
    worth = ["activation_month", "lifetime_days", "total_revenue_with_upgrade"]
    held = (
        subs.select("subscription_id", *worth, F.explode("cpc_list").alias("cpc"))
        .join(codes.distinct(), "cpc")
        # Two codes of one service make one member.
        .groupBy("service", "subscription_id", *worth).agg(F.count(F.lit(1)).alias("codes"))
    )
    return held.groupBy("service", "activation_month").agg(
        F.count(F.lit(1)).alias("total_subscriptions"),
        round_half_up(F.avg("lifetime_days"), 2).alias("avg_lifetime"),
        round_half_up(F.avg("total_revenue_with_upgrade"), 2).alias("avg_ltv"),
    )


def category_extract(subs: DataFrame, codes: DataFrame | Sequence[int]) -> DataFrame:
    """Subscriptions that ever had one of the codes: a test of each row alone, so the table is read once and not shuffled.

    A table of codes becomes one array, found at run time; it holds rows of the product dimension.
    """
    if not isinstance(codes, DataFrame):
        return subs.where(list_has_any(F.col("cpc_list"), list(codes)))
    wanted = codes.where("cpc is not null").agg(F.collect_set("cpc")).scalar()
    return subs.where(F.arrays_overlap("cpc_list", wanted))


def category_overview(extract: DataFrame) -> DataFrame:
    """Totals of a category extract. A null user or phone counts as one value."""
    def distinct(column: str):
        return F.count_distinct(column) + F.max(F.when(F.col(column).isNull(), 1).otherwise(0))

    return extract.agg(
        F.count(F.lit(1)).alias("total_subscriptions"),
        F.coalesce(distinct("tmuserid"), F.lit(0)).cast("bigint").alias("unique_users"),
        F.coalesce(distinct("msisdn"), F.lit(0)).cast("bigint").alias("unique_msisdns"),
        count_where(F.col("subscription_status") == "Active").alias("active"),
        count_where(F.col("deactivation_date").isNotNull()).alias("deactivated"),
        count_where(F.col("cancellation_date").isNotNull()).alias("cancelled"),
        round_half_up(F.sum("total_revenue"), 2).alias("total_revenue"),
        round_half_up(F.avg("total_revenue"), 2).alias("avg_revenue"),
        F.sum("renewal_count").alias("total_renewals"),
        round_half_up(F.avg("renewal_count"), 2).alias("avg_renewals"),
        F.min("activation_date").alias("first_activation"),
        F.max("activation_date").alias("last_activation"),
    )


def top_list_codes(extract: DataFrame, codes: DataFrame | Sequence[int] | None = None, k: int = 10) -> DataFrame:
    """Most frequent codes over the lists of an extract, optionally only the category's own codes."""
    items = extract.select(F.explode("cpc_list").alias("cpc")).groupBy("cpc").agg(F.count(F.lit(1)).alias("count"))
    if isinstance(codes, DataFrame):
        items = items.join(codes.select("cpc").distinct(), "cpc", "left_semi")
    elif codes is not None:
        items = items.where(F.col("cpc").isin(list(codes)))
    return items.where("cpc is not null").orderBy(F.desc("count"), "cpc").limit(k)
