"""All queries: name -> (Spark query over the driver tables, SQL counterpart).

Lists are shown as comma-separated text. Every query reads its whole tables; a limit appears only where
it is the report's own top-k.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger import fixed_values as fixed
from subledger.functions import grouped_category, list_text, month_of, parse_day, round_half_up, with_country_code
from subledger.operators.dedupe import dedupe_fact, duplicate_counts
from subledger.operators.gaps import backfill_rows, date_range, distinct_dates, gap_ranges, missing_dates
from subledger.operators.merge import merge_counters
from subledger.operators.normalise import normalise, of_types
from subledger.operators.users import exclude_users, map_phones, mapping_coverage, semi_keys
from subledger.plans import counters as pc
from subledger.plans import jobs
from subledger.plans import lifecycle as pl
from subledger.plans import lookup as pk
from subledger.plans import quality as pq
from subledger.plans import reports as pr
from subledger.plans import userbase as pu
from subledger.schemas import FACTS
from subledger.session import scratch_path
from subledger.sources import csv as sc
from subledger.sources import extract as se
from subledger.sources import snapshots as sn
from subledger.sources import tables as st
from subledger.sources.dims import build_dim, distinct_dim, expand_code_sets, load_codes, load_dim, load_excluded
from workload import fixtures as fx
from workload.fixtures import AS_OF, LONG_AS_OF, Data
from workload.sql import COUNTERS, n, r, sql

QUERIES: dict[str, Callable[[Data], DataFrame]] = {}
ORACLES: dict[str, str] = {}

COUNT_SUMS = ", ".join(f"{n(f'SUM({c})')} AS {c}" for c in fixed.COUNT_COLUMNS)


def flat(rows: DataFrame) -> DataFrame:
    """Lists as text, for comparison across engines."""
    out = []
    for f in rows.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = list_text(c)
        out.append(c.alias(f.name))
    return rows.select(*out)


def add(name: str, query: Callable[[Data], DataFrame], oracle: str | None = None) -> None:
    QUERIES[name] = lambda d: flat(query(d))
    if oracle:
        ORACLES[name] = oracle


def money(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: round_half_up(F.col(c), 2) for c in columns})


# ---- counters ------------------------------------------------------------------------------------

add("daily_counters", lambda d: pc.daily_counters(d.tx()), sql("counters", f"SELECT {COUNTERS} FROM counters"))
add("daily_counters_long", lambda d: pc.daily_counters(d.tx_long()),
    sql("counters_long", f"SELECT {COUNTERS} FROM counters_long"))
add("count_by_cpc", lambda d: pc.count_by_cpc(d.tx()),
    sql("tx", "SELECT cpc, COUNT(*) AS tx_count FROM tx GROUP BY cpc"))
add("filter_non_upgrade",
    lambda d: pc.non_upgrade(d.tx()).groupBy("tx_type", "channel").agg(F.count(F.lit(1)).alias("kept")),
    sql("tx", "SELECT tx_type, channel, COUNT(*) AS kept FROM tx WHERE channel <> 'UPGRADE' GROUP BY 1, 2"))
add("counters_service", lambda d: pc.counters_service(pc.daily_counters(d.tx()), d.dim(), fx.DIM_EXCLUDED),
    sql("svc", f"SELECT {', '.join(fixed.SERVICE_COLUMNS)} FROM svc"))
add("exclude_services",
    lambda d: pc.counters_service(pc.daily_counters(d.tx()), d.dim(), fx.DIM_EXCLUDED).groupBy("service_name")
    .agg(F.count(F.lit(1)).alias("counter_rows")),
    sql("svc", "SELECT service_name, COUNT(*) AS counter_rows FROM svc GROUP BY 1"))
add("unmapped_cpcs", lambda d: pc.unmapped_cpcs(pc.daily_counters(d.tx()), d.dim()),
    sql("counters dim", "SELECT DISTINCT cpc FROM counters WHERE cpc NOT IN (SELECT cpc FROM dim)"))
add("service_rollup", lambda d: pc.service_rollup(pc.daily_counters(d.tx()), d.dim(), fx.DIM_EXCLUDED),
    sql("svc", f"""SELECT date, service_name, tme_category, string_agg(CAST(cpc AS VARCHAR), ', ' ORDER BY cpc) AS cpcs,
        arg_min(cpc_period, cpc) AS cpc_period, arg_min(cpc_price, cpc) AS cpc_price, {COUNT_SUMS},
        {r('SUM(rfnd_amount)')} AS rfnd_amount, {r('SUM(rev)')} AS rev FROM svc GROUP BY 1, 2, 3"""))
add("counter_totals", lambda d: pc.counter_totals(pc.daily_counters(d.tx())),
    sql("counters", "SELECT date, COUNT(*) AS cpcs_processed, "
        + ", ".join(f"{n(f'SUM({t}_count)')} AS {t}_count" for t in fixed.TX_TYPES) + " FROM counters GROUP BY date"))
add("exclude_users",
    lambda d: exclude_users(d.tx(), d.listed(fx.EXCLUDED_PHONES), d.listed(fx.EXCLUDED_USERS)).select(
        "tx_type", "tmuserid", "msisdn", F.col("tie").alias("event_id")),
    sql("txx", "SELECT tx_type, tmuserid, msisdn, tie AS event_id FROM txx"))
add("daily_counters_excluded",
    lambda d: pc.daily_counters(exclude_users(d.tx(), d.listed(fx.EXCLUDED_PHONES), d.listed(fx.EXCLUDED_USERS))),
    sql("counters_x", f"SELECT {COUNTERS} FROM counters_x"))

# A history that lacks the second half of the month and has one stale day.
HALF = "2024-01-15"
STALE = "2024-01-03"


def _history(d: Data) -> DataFrame:
    past = pc.daily_counters(d.tx()).where(F.col("date") <= F.lit(HALF).cast("date"))
    stale = F.col("date") == F.lit(STALE).cast("date")
    return past.withColumn("act_count", F.when(stale, F.col("act_count") + 1000).otherwise(F.col("act_count")))


HISTORY_SQL = f"""hist AS (SELECT date, cpc, act_count + CASE WHEN date = DATE '{STALE}' THEN 1000 ELSE 0 END AS act_count,
    {COUNTERS.replace('date, cpc, act_count, ', '')} FROM counters WHERE date <= DATE '{HALF}')"""
# Dates from STALE on are processed, except that one of them has lost all its rows; earlier ones are kept.
GONE = "2024-01-07"
add("merge_counters",
    lambda d: merge_counters(
        _history(d), pc.daily_counters(d.tx()).where(F.col("date") >= F.lit(STALE).cast("date")).where(F.col("date") != F.lit(GONE).cast("date")),
        distinct_dates(d.tx(), "trans_date").where(F.col("date") >= F.lit(STALE).cast("date"))).drop("last_updated"),
    sql("counters", f"SELECT {COUNTERS} FROM hist WHERE date < DATE '{STALE}' "
        f"UNION ALL SELECT {COUNTERS} FROM counters WHERE date >= DATE '{STALE}' AND date <> DATE '{GONE}'", HISTORY_SQL))
add("counters_incremental",
    lambda d: pc.counters_incremental(d.tx(), _history(d)).drop("last_updated"),
    sql("counters", f"SELECT {COUNTERS} FROM hist UNION ALL SELECT {COUNTERS} FROM counters "
        "WHERE date NOT IN (SELECT date FROM hist)", HISTORY_SQL))
add("counters_forced",
    lambda d: pc.counters_incremental(d.tx(), _history(d), force=True).drop("last_updated"),
    sql("counters", f"SELECT {COUNTERS} FROM counters"))
add("missing_counter_dates", lambda d: pc.missing_counter_dates(d.tx(), _history(d)),
    sql("counters tx", "SELECT DISTINCT CAST(trans_date AS DATE) AS date FROM tx WHERE trans_date IS NOT NULL "
        "AND CAST(trans_date AS DATE) NOT IN (SELECT date FROM hist)", HISTORY_SQL))
add("transaction_dates", lambda d: distinct_dates(d.tx_long(), "trans_date"),
    sql("txl", "SELECT DISTINCT CAST(trans_date AS DATE) AS date FROM txl"))

# ---- lifecycle -----------------------------------------------------------------------------------

_FIRST_COLUMNS = ("cpc AS first_cpc, act_date AS activation_date, trans_date AS first_trans_date, "
                  "camp_name AS activation_campaign, channel AS activation_channel, year_month AS activation_month")
LIFE = [c for c in fixed.LIFECYCLE_COLUMNS if c != "cpc_list"]
REVENUE = ("renewal_revenue", "total_refunded", "total_revenue", "total_revenue_with_upgrade")


# A list's codes without the null ones; a list of null codes only is an empty text, as in ``list_text``, and not a null.
_LISTED_CODES = "CASE WHEN cpc_list IS NOT NULL THEN COALESCE(array_to_string(list_transform(cpc_list, lambda x: CAST(x AS VARCHAR)), ','), '') END"


def _life_sql(view: str, codes: str = "array_to_string(list_transform(cpc_list, lambda x: CAST(x AS VARCHAR)), ',')") -> str:
    """The lifecycle table; views whose codes may be null give ``_LISTED_CODES``."""
    cols = ", ".join(f"{r(c)} AS {c}" if c in REVENUE else c for c in LIFE)
    return f"SELECT {codes} AS cpc_list, {cols} FROM {view}"


add("all_transactions", lambda d: pl.all_transactions(d.tx()),
    sql("tx", "SELECT subscription_id, tmuserid, msisdn, cpc, trans_type_id, trans_date, act_date, reno_date, camp_name, "
        "channel, rev, year_month, tx_type AS transaction_type, tie FROM tx WHERE tx_type IN ('ACT', 'RENO')"))
add("first_transaction", lambda d: pl.first_transaction(d.tx()),
    sql("tx subs_opening", f"SELECT subscription_id, tmuserid, msisdn, {_FIRST_COLUMNS} FROM subs_opening"))
add("actual_activation", lambda d: pl.actual_activation(d.tx()),
    sql("tx subs_act", "SELECT subscription_id, trans_date AS actual_act_trans_date, rev AS activation_revenue, cpc AS act_cpc FROM subs_act"))
add("current_cpc", lambda d: pl.current_cpc(d.tx()),
    sql("tx subs_newest", "SELECT subscription_id, cpc AS current_cpc FROM subs_newest"))
add("last_upgrade", lambda d: pl.last_upgrade(d.tx()),
    sql("tx subs_upg", "SELECT subscription_id, cpc AS new_cpc, trans_date AS upgrade_date, rev AS upgrade_revenue FROM subs_upg"))
add("last_deactivation", lambda d: pl.last_deactivation(d.tx()),
    sql("tx subs_dct", "SELECT subscription_id, trans_date AS deactivation_date, channel AS deactivation_mode FROM subs_dct"))
add("last_cancellation", lambda d: pl.last_cancellation(d.tx()),
    sql("tx subs_cnr", "SELECT subscription_id, trans_date AS cancellation_date, channel AS cancellation_mode FROM subs_cnr"))
add("renewal_agg", lambda d: money(pl.renewal_agg(d.tx()), "total_renewal_revenue"),
    sql("tx subs_reno", f"SELECT subscription_id, cnt AS total_renewals, {r('rev')} AS total_renewal_revenue, "
        "hi AS last_renewal_date, lo AS first_renewal_date FROM subs_reno"))
add("refund_agg", lambda d: money(pl.refund_agg(d.tx()), "total_refunded"),
    sql("tx subs_rfnd", f"SELECT subscription_id, cnt AS refund_count, {r('amount')} AS total_refunded, hi AS last_refund_date FROM subs_rfnd"))
add("cpc_list", lambda d: pl.cpc_list(d.tx()),
    sql("tx subs_codes", f"SELECT subscription_id, {_LISTED_CODES} AS cpc_list, {n('cpc_count')} AS cpc_count FROM subs_codes"))
add("list_to_csv", lambda d: pl.cpc_list(d.tx()).select("subscription_id", list_text(F.col("cpc_list")).alias("cpc_text")),
    sql("tx subs_codes", f"SELECT subscription_id, {_LISTED_CODES} AS cpc_text FROM subs_codes"))
add("subscription_view", lambda d: money(d.subs(), *REVENUE), sql("subs", _life_sql("subs", _LISTED_CODES)))
add("subscription_view_channel_upgrades",
    lambda d: money(pl.subscription_view(d.tx(), AS_OF, "channel"), *REVENUE), sql("subsc", _life_sql("subsc", _LISTED_CODES)))
add("subscription_view_long", lambda d: money(d.subs_long(), *REVENUE), sql("subsl", _life_sql("subsl")))

# ---- statistics of the lifecycle table -------------------------------------------------------------


def _share(column: str, name: str = "count", view: str = "subs") -> str:
    return sql(view, f'SELECT {column}, COUNT(*) AS "{name}", '
               f"{r('CAST(COUNT(*) AS DOUBLE) * 100.0 / SUM(COUNT(*)) OVER ()')} AS percentage FROM {view} GROUP BY {column}")


add("status_distribution", lambda d: pr.status_distribution(d.subs()), _share("subscription_status"))
add("missing_act_distribution", lambda d: pr.missing_act_distribution(d.subs()), _share("missing_act_record"))
add("cpc_count_distribution", lambda d: pr.cpc_count_distribution(d.subs()), _share("cpc_count", "subscriptions"))
add("upgrade_statistics", lambda d: pr.upgrade_statistics(d.subs()),
    sql("subs", f'SELECT has_upgraded, COUNT(*) AS "count", {r("AVG(total_revenue_with_upgrade)")} AS avg_revenue FROM subs GROUP BY 1'))
add("revenue_summary", lambda d: pr.revenue_summary(d.subs()),
    sql("subs", f"SELECT COUNT(*) AS total_subscriptions, {r('SUM(total_revenue)')} AS total_revenue, {r('AVG(total_revenue)')} AS avg_revenue_per_sub, "
        f"{r('AVG(renewal_count)')} AS avg_renewals, {r('AVG(lifetime_days)', 1)} AS avg_lifetime_days FROM subs"))
add("top_campaigns", lambda d: pr.top_campaigns(d.subs()),
    sql("subs", f"SELECT activation_campaign, COUNT(*) AS subscriptions, {r('SUM(total_revenue)')} AS revenue, "
        f"{r('AVG(lifetime_days)', 1)} AS avg_lifetime FROM subs WHERE activation_campaign IS NOT NULL GROUP BY 1 "
        "ORDER BY revenue DESC, activation_campaign LIMIT 5"))
add("monthly_activation_stats", lambda d: pr.monthly_activation_stats(d.subs_long()),
    sql("subsl", f"SELECT activation_month, COUNT(*) AS new_subscriptions, {r('SUM(activation_revenue)')} AS revenue, "
        "COUNT(*) FILTER (WHERE has_upgraded) AS upgrades FROM subsl GROUP BY 1 ORDER BY activation_month DESC NULLS LAST LIMIT 6"))
_CODES_TEXT = "array_to_string(list_transform(cpc_list, lambda x: CAST(x AS VARCHAR)), ',') AS cpc_list"
add("sample_upgraded", lambda d: money(pr.sample_upgraded(d.subs()), "total_revenue_with_upgrade"),
    sql("subs", f"SELECT subscription_id, {_CODES_TEXT}, cpc_count, first_cpc, current_cpc, upgrade_date, activation_date, renewal_count, "
        f"{r('total_revenue_with_upgrade')} AS total_revenue_with_upgrade, subscription_status FROM subs WHERE has_upgraded "
        "ORDER BY subscription_id NULLS FIRST LIMIT 3"))
add("sample_missing_act", lambda d: money(pr.sample_missing_act(d.subs()), "total_revenue"),
    sql("subs", f"SELECT subscription_id, {_CODES_TEXT}, activation_date, activation_trans_date, missing_act_record, renewal_count, "
        f"{r('total_revenue')} AS total_revenue, subscription_status FROM subs WHERE missing_act_record "
        "ORDER BY subscription_id NULLS FIRST LIMIT 3"))


def _monthly(date: str, columns: str, view: str, as_of: str) -> str:
    return sql(view, f"SELECT strftime({date}, '%Y-%m') AS month, {columns} FROM {view} "
               f"WHERE {date} >= DATE '{as_of}' - INTERVAL '12 months' GROUP BY 1")


add("monthly_activations", lambda d: pq.monthly_activations(d.subs_long(), LONG_AS_OF),
    _monthly("activation_date", f"COUNT(*) AS activations, {r('SUM(activation_revenue)')} AS activation_revenue, "
             "COUNT(DISTINCT tmuserid) AS unique_users, COUNT(DISTINCT cpc_list[1]) AS unique_cpcs", "subsl", LONG_AS_OF))
add("monthly_renewals", lambda d: pq.monthly_renewals(d.subs_long(), LONG_AS_OF),
    _monthly("last_renewal_date", f"COUNT(*) AS subscriptions_with_renewals, {n('SUM(renewal_count)')} AS total_renewals, "
             f"{r('SUM(renewal_revenue)')} AS renewal_revenue, {r('AVG(renewal_count)', 4)} AS avg_renewals_per_subscription", "subsl", LONG_AS_OF))
for _name, _date, _mode, _count in (
    ("monthly_deactivations", "deactivation_date", "deactivation_mode", "deactivations"),
    ("monthly_cancellations", "cancellation_date", "cancellation_mode", "cancellations"),
):
    add(_name, lambda d, q=getattr(pq, _name): q(d.subs_long(), LONG_AS_OF),
        _monthly(_date, f"COUNT(*) AS {_count}, COUNT(DISTINCT {_mode}) AS unique_modes, "
                 f"{r('AVG(lifetime_days)', 4)} AS avg_lifetime_days", "subsl", LONG_AS_OF))
add("monthly_refunds", lambda d: pq.monthly_refunds(d.subs_long(), LONG_AS_OF),
    _monthly("last_refund_date", f"COUNT(*) AS subscriptions_with_refunds, {n('SUM(refund_count)')} AS total_refunds, "
             f"{r('SUM(total_refunded)')} AS total_refunded_amount, {r('AVG(total_refunded)', 4)} AS avg_refund_per_subscription", "subsl", LONG_AS_OF))

# ---- quality of the lifecycle table ---------------------------------------------------------------

_RANGE_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS date_type, MIN({c}) AS min_date, MAX({c}) AS max_date, COUNT(*) AS records FROM subs WHERE {c} IS NOT NULL"
    for name, c in pq.LIFECYCLE_DATES.items())
add("lifecycle_date_ranges", lambda d: pq.lifecycle_date_ranges(d.subs()), sql("subs", _RANGE_SQL))
add("quality_checks", lambda d: pq.quality_checks(d.subs()),
    sql("subs", "SELECT COUNT(*) AS total_subscriptions, COUNT(DISTINCT subscription_id) AS unique_subscription_ids, "
        "COUNT(*) - COUNT(DISTINCT subscription_id) AS duplicate_subscription_ids, COUNT(*) FILTER (WHERE missing_act_record) AS missing_act_records, "
        "COUNT(*) FILTER (WHERE activation_date IS NULL) AS null_activation_dates, COUNT(*) FILTER (WHERE has_upgraded) AS upgraded_subscriptions, "
        "COUNT(*) FILTER (WHERE renewal_count > 0) AS subscriptions_with_renewals, COUNT(*) FILTER (WHERE refund_count > 0) AS subscriptions_with_refunds FROM subs"))
add("revenue_statistics", lambda d: pq.revenue_statistics(d.subs()),
    sql("subs", f"SELECT COUNT(*) AS total_subscriptions, {r('SUM(activation_revenue)')} AS total_activation_revenue, {r('SUM(renewal_revenue)')} AS total_renewal_revenue, "
        f"{r('SUM(total_revenue)')} AS total_revenue, {r('SUM(total_refunded)')} AS total_refunded, {r('AVG(activation_revenue)', 4)} AS avg_activation_revenue, "
        f"{r('AVG(renewal_revenue)', 4)} AS avg_renewal_revenue, {r('AVG(total_revenue)', 4)} AS avg_total_revenue FROM subs"))
add("active_count", lambda d: pq.active_count(d.subs()),
    sql("subs", "SELECT COUNT(*) AS active_subscriptions FROM subs WHERE subscription_status = 'Active'"))
add("top_cpcs", lambda d: pq.top_cpcs(d.subs()),
    sql("subs", f"SELECT first_cpc, COUNT(*) AS subscription_count, {r('SUM(total_revenue)')} AS total_revenue FROM subs GROUP BY 1 "
        "ORDER BY subscription_count DESC, first_cpc NULLS LAST LIMIT 10"))
add("lifetime_by_status", lambda d: pq.lifetime_by_status(d.subs()),
    sql("subs", f'SELECT subscription_status, COUNT(*) AS "count", {r("AVG(lifetime_days)", 4)} AS avg_lifetime_days, '
        f"{r('AVG(total_revenue)', 4)} AS avg_revenue FROM subs GROUP BY 1"))
add("recent_activations", lambda d: pq.recent_activations(d.subs(), "2024-01-10"),
    sql("subs", f"SELECT CAST(activation_date AS DATE) AS date, COUNT(*) AS activations, {r('SUM(activation_revenue)')} AS revenue FROM subs "
        "WHERE activation_date >= DATE '2024-01-10' - INTERVAL '7 days' GROUP BY 1"))
add("most_renewals", lambda d: money(pq.most_renewals(d.subs()), "renewal_revenue"),
    sql("subs", f"SELECT subscription_id, tmuserid, first_cpc, renewal_count, {r('renewal_revenue')} AS renewal_revenue, lifetime_days, subscription_status "
        "FROM subs WHERE renewal_count > 0 ORDER BY renewal_count DESC, subscription_id NULLS FIRST LIMIT 10"))


def _gaps_sql(dates: str, keys: str, end: str, start: str = "lo") -> str:
    """Missing dates per key between bounds, from a relation with the keys and ``date``."""
    return (
        f"bounds AS (SELECT {keys}, MIN(date) AS lo, MAX(date) AS hi FROM {dates} GROUP BY {keys}), "
        f"days AS (SELECT {keys}, CAST(UNNEST(generate_series({start}, CAST({end} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM bounds), "
        f"gaps AS (SELECT {keys}, date FROM days WHERE ({keys}, date) NOT IN (SELECT ({keys}, date) FROM {dates}))"
    )


_LIFE_DATES = "dates AS (" + " UNION ".join(
    f"SELECT '{name}' AS date_type, CAST({c} AS DATE) AS date FROM subsl WHERE {c} IS NOT NULL"
    for name, c in pq.LIFECYCLE_DATES.items()) + ")"
add("completeness_lifecycle", lambda d: pq.completeness_lifecycle(d.subs_long(), LONG_AS_OF),
    sql("subsl", "SELECT date_type, date FROM gaps", _LIFE_DATES + ", " + _gaps_sql(
        "dates", "date_type", f"DATE '{LONG_AS_OF}' - 1",
        "CASE WHEN date_type = 'Activation' THEN greatest(lo, (SELECT MIN(date) FROM dates WHERE date_type = 'Last Renewal')) ELSE lo END")))

# ---- gaps, completeness and backfill --------------------------------------------------------------

_TYPE_DATES = "dates AS (SELECT DISTINCT tx_type, CAST(trans_date AS DATE) AS date FROM txl WHERE trans_date IS NOT NULL)"
_OLD_TYPES = "dates AS (SELECT DISTINCT tx_type, CAST(trans_date AS DATE) AS date FROM txl WHERE tx_type IN ('ACT', 'RENO', 'DCT'))"
_ISLANDS = ("SELECT tx_type, MIN(date) AS gap_start, MAX(date) AS gap_end, COUNT(*) AS days FROM (SELECT tx_type, date, "
            "date - CAST(ROW_NUMBER() OVER (PARTITION BY tx_type ORDER BY date) AS INTEGER) AS island FROM gaps) GROUP BY tx_type, island")
add("missing_dates", lambda d: missing_dates(distinct_dates(d.tx_long(), "trans_date", ["tx_type"]), ["tx_type"]),
    sql("txl", "SELECT tx_type, date FROM gaps", _TYPE_DATES + ", " + _gaps_sql("dates", "tx_type", "hi")))
add("gap_ranges",
    lambda d: gap_ranges(missing_dates(distinct_dates(d.tx_long(), "trans_date", ["tx_type"]), ["tx_type"]), ["tx_type"]),
    sql("txl", _ISLANDS, _TYPE_DATES + ", " + _gaps_sql("dates", "tx_type", "hi")))
add("completeness_tx", lambda d: pq.completeness_tx(d.tx_long(), LONG_AS_OF),
    sql("txl", "SELECT tx_type, date FROM gaps", _OLD_TYPES + ", " + _gaps_sql("dates", "tx_type", f"DATE '{LONG_AS_OF}' - 1")))
add("completeness_ranges", lambda d: pq.completeness_ranges(d.tx_long(), LONG_AS_OF),
    sql("txl", _ISLANDS, _OLD_TYPES + ", " + _gaps_sql("dates", "tx_type", f"DATE '{LONG_AS_OF}' - 1")))
add("date_ranges", lambda d: pq.date_ranges(d.tx_long()),
    sql("txl", "SELECT tx_type, MIN(trans_date) AS min_date, MAX(trans_date) AS max_date FROM txl GROUP BY 1"))
add("date_range_days", lambda d: date_range(d.tx_long(), "trans_date", ["tx_type"]),
    sql("txl", "SELECT tx_type, CAST(MIN(trans_date) AS DATE) AS min_date, CAST(MAX(trans_date) AS DATE) AS max_date FROM txl GROUP BY 1"))


# Renewals without the days that begin with 1 in their month, and without the last months.
HELD_TO = "2001-03-31"
_HELD = f"day(trans_date) NOT BETWEEN 10 AND 19 AND trans_date < DATE '{HELD_TO}'"


def _held_days(d: Data) -> DataFrame:
    return distinct_dates(of_types(d.tx_long(), "RENO").where(_HELD.replace("trans_date <", "CAST(trans_date AS DATE) <")), "trans_date")


add("backfill_rows",
    lambda d: backfill_rows(_held_days(d), of_types(d.tx_long(), "RENO"), "trans_date").select(
        "subscription_id", "trans_date", "cpc", "rev", "tie"),
    sql("txl", "SELECT subscription_id, trans_date, cpc, rev, tie FROM txl WHERE tx_type = 'RENO' AND CAST(trans_date AS DATE) >= (SELECT MIN(date) FROM held) "
        "AND CAST(trans_date AS DATE) NOT IN (SELECT date FROM held)",
        f"held AS (SELECT DISTINCT CAST(trans_date AS DATE) AS date FROM txl WHERE tx_type = 'RENO' AND {_HELD.replace('trans_date <', 'CAST(trans_date AS DATE) <')})"))

# ---- quality of the transactions --------------------------------------------------------------------

add("row_counts", lambda d: pq.row_counts(d.tx_long()),
    sql("txl", "SELECT tx_type, COUNT(*) AS row_count FROM txl GROUP BY 1 UNION ALL SELECT 'TOTAL', COUNT(*) FROM txl"))
add("partition_inventory", lambda d: pq.tx_partition_inventory(d.tx_long()),
    sql("txl", "SELECT tx_type, COUNT(DISTINCT year_month) AS partitions, MIN(year_month) AS first_month, MAX(year_month) AS last_month FROM txl GROUP BY 1"))
add("row_counts_stored", lambda d: pq.stored_row_counts(d.spark, d.store_root()), ORACLES["row_counts"])
add("partition_inventory_stored", lambda d: pq.stored_inventory(d.spark, d.store_root()), ORACLES["partition_inventory"])
add("date_ranges_stored", lambda d: pq.stored_date_ranges(d.spark, d.store_root()),
    sql("txl", "SELECT tx_type, MIN(trans_date) AS min_date, MAX(trans_date) AS max_date FROM txl GROUP BY 1"))
_KEY = "subscription_id, trans_date, CASE WHEN tx_type NOT IN ('CNR', 'RFND') THEN trans_type_id END"
_KEYS_SQL = f"keys AS (SELECT tx_type, COUNT(*) AS n FROM txl GROUP BY tx_type, {_KEY})"
_DUP = "{} AS row_count, COUNT(*) AS key_count, {} - COUNT(*) AS duplicates".format(n("SUM(n)"), n("SUM(n)"))
add("duplicate_counts", lambda d: pq.tx_duplicates(d.tx_long()), sql("txl", f"SELECT tx_type, {_DUP} FROM keys GROUP BY 1", _KEYS_SQL))
add("act_count_total", lambda d: pq.act_count_total(d.tx_long()), sql("txl", "SELECT COUNT(*) AS total_acts FROM txl WHERE tx_type = 'ACT'"))
add("act_revenue_by_month", lambda d: pq.act_revenue_by_month(d.tx_long()),
    sql("txl", f"SELECT year_month, COUNT(*) AS transactions, {r('SUM(rev)')} AS total_revenue FROM txl WHERE tx_type = 'ACT' GROUP BY 1 ORDER BY 1 DESC LIMIT 5"))
add("latest_renewals", lambda d: pq.latest_renewals(d.tx_long()),
    sql("txl", "SELECT tmuserid, trans_date, rev, camp_name FROM txl WHERE tx_type = 'RENO' ORDER BY trans_date DESC NULLS LAST, tie DESC LIMIT 10"))
add("cancellations_by_month", lambda d: pq.cancellations_by_month(d.tx_long()),
    sql("txl", "SELECT year_month, COUNT(*) AS cancellations FROM txl WHERE tx_type = 'CNR' GROUP BY 1 ORDER BY 1 DESC LIMIT 5"))
add("refund_totals", lambda d: pq.refund_totals(d.tx_long()),
    sql("txl", f"SELECT COUNT(*) AS refund_count, {r('SUM(rfnd_amount)')} AS total_refunded FROM txl WHERE tx_type = 'RFND'"))

# ---- user base -----------------------------------------------------------------------------------


def _base(level: str) -> Callable[[Data], DataFrame]:
    return lambda d: pu.user_base_rollup(sn.clean_snapshot(d.snapshots()), level, fx.CATEGORY_GROUPS, fx.DIM_EXCLUDED)


for _level, _keys in pu.LEVELS.items():
    add(f"user_base_by_{_level}", _base(_level),
        sql("base", f'SELECT {", ".join(_keys)}, {n("SUM(cnt)")} AS "User_Base" FROM base GROUP BY {", ".join(_keys)}'))
add("user_base_all_levels",
    lambda d: pu.user_base_all_levels(sn.clean_snapshot(d.snapshots()), fx.CATEGORY_GROUPS, fx.DIM_EXCLUDED),
    sql("base", " UNION ALL ".join(
        f'SELECT \'{level}\' AS level, date, {"service_name" if "service_name" in keys else "NULL"} AS service_name, '
        f'{"tme_category" if "tme_category" in keys else "NULL"} AS tme_category, {"cpc" if "cpc" in keys else "NULL"} AS cpc, '
        f'{n("SUM(cnt)")} AS "User_Base" FROM base GROUP BY {", ".join(keys)}' for level, keys in pu.LEVELS.items())))
add("map_category",
    lambda d: d.table("part").groupBy(grouped_category(F.col("p_type"), fx.CATEGORY_GROUPS).alias("category"))
    .agg(F.count(F.lit(1)).alias("parts")),
    "SELECT CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'Eco_Promo' WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'Small_Med' ELSE p_type END AS category, "
    "COUNT(*) AS parts FROM part GROUP BY 1")
# One rollup counts a fifth of its rows ten times over, so differences show.
_SKEWED = "CASE WHEN cpc % 5 = 0 THEN User_Base * 10 ELSE User_Base END"
add("reconcile_user_base",
    lambda d: pu.reconcile_user_base(_base("service")(d), _base("cpc")(d).withColumn("User_Base", F.expr(_SKEWED)), d.dim()),
    sql("base dim", """SELECT s.service_name, s.date, s.service_total, COALESCE(c.cpc_sum, 0) AS cpc_sum, s.service_total - COALESCE(c.cpc_sum, 0) AS difference
        FROM (SELECT service_name, date, CAST(SUM(cnt) AS BIGINT) AS service_total FROM base GROUP BY 1, 2) s LEFT JOIN
        (SELECT m.service_name, b.date, CAST(SUM(CASE WHEN b.cpc % 5 = 0 THEN b.cnt * 10 ELSE b.cnt END) AS BIGINT) AS cpc_sum FROM base b JOIN dim m ON b.cpc = m.cpc GROUP BY 1, 2) c
        ON s.service_name = c.service_name AND s.date = c.date"""))


def _snapshot_folder(d: Data) -> str:
    """Snapshots as files under dated names, one date per month."""
    rows = d.snapshots().select("date", "service_name", "tme_category", "cpc", "count")
    name = F.concat(F.date_format(F.trunc("date", "month"), "yyyyMMdd"), F.lit("_base"))
    return d.named_files("snapshots", rows.withColumn("month", name).drop("date"), F.col("month"))


add("snapshot_date_from_name",
    lambda d: sn.read_snapshots(d.spark, _snapshot_folder(d)).groupBy("date").agg(F.count(F.lit(1)).alias("snapshot_rows"), F.sum("count").alias("users")),
    sql("snap", f'SELECT CAST(date_trunc(\'month\', date) AS DATE) AS date, COUNT(*) AS snapshot_rows, {n("SUM(trunc(CAST(count AS DOUBLE)))")} AS users FROM snap GROUP BY 1'))



def _rolled_up(d: Data) -> DataFrame:
    """The rollups after an update with half of the files and one with all, which reads the other half only."""
    folder, root = _snapshot_folder(d), scratch_path(d.spark, "user_base")
    files = sn.snapshot_files(d.spark, folder)
    early = sorted({day for _, day in files})[: len({day for _, day in files}) // 2]
    some = d.written("early_snapshots", lambda path: d.copy_files([f for f, day in files if day in early], path))
    for source in (some, folder):
        jobs.update_user_base(d.spark, source, root, fx.DIM_EXCLUDED, fx.CATEGORY_GROUPS)
    return jobs.load_user_base(d.spark, root, "service")


_BY_MONTH = sql("base", "SELECT CAST(date_trunc('month', date) AS DATE) AS date, service_name, tme_category, " + n("SUM(cnt)") + ' AS "User_Base" FROM base GROUP BY 1, 2, 3')
add("user_base_incremental", _rolled_up, _BY_MONTH)


def _piped(d: Data) -> DataFrame:
    """A rollup written as sorted pipe-separated CSV and read back."""
    path = d.written("piped", lambda p: st.write_csv(_base("service")(d), p, separator="|", sort_by=pu.LEVELS["service"]))
    return sn.read_rollup(d.spark, path)


add("pipe_csv_round_trip", _piped, sql("base", f'SELECT date, service_name, tme_category, {n("SUM(cnt)")} AS "User_Base" FROM base GROUP BY 1, 2, 3'))

# ---- refunds, revenue, cohorts, categories ----------------------------------------------------------

_REFUNDS = f"""SELECT year_month, t.cpc, d.service_name, d.tme_category, {r('COALESCE(SUM(rfnd_amount), 0)')} AS "cpcTotalRfdsAmount",
    {n('COALESCE(SUM(rfnd_cnt), 0)')} AS "cpcTotalRfdsCount",
    COUNT(DISTINCT tmuserid) + MAX(CASE WHEN tmuserid IS NULL THEN 1 ELSE 0 END) AS "cpcTotalRfdsCountUU",
    COUNT(DISTINCT tmuserid) FILTER (WHERE instant_rfnd = 'f') + MAX(CASE WHEN tmuserid IS NULL AND instant_rfnd = 'f' THEN 1 ELSE 0 END) AS "RegularRfdsUU",
    COUNT(DISTINCT tmuserid) FILTER (WHERE instant_rfnd = 't') + MAX(CASE WHEN tmuserid IS NULL AND instant_rfnd = 't' THEN 1 ELSE 0 END) AS "AutomaticRfdsUU"
    FROM {{}} t LEFT JOIN rawdim d ON t.cpc = d.cpc WHERE tx_type = 'RFND' GROUP BY year_month, t.cpc, d.service_name, d.tme_category"""
add("refund_analysis", lambda d: pr.refund_analysis(of_types(d.tx(), "RFND"), distinct_dim(d.raw_dim())), sql("tx rawdim", _REFUNDS.format("tx")))
add("refund_analysis_long", lambda d: pr.refund_analysis(of_types(d.tx_long(), "RFND"), distinct_dim(d.raw_dim())), sql("txl rawdim", _REFUNDS.format("txl")))
MONTHS = ["1999-01", "1999-02", "1999-03", "2010-01"]
_CELL = "COALESCE(SUM(rev) FILTER (WHERE month = '{0}'), 0)"
add("revenue_pivot",
    lambda d: pr.revenue_pivot(pc.counters_service(pc.daily_counters(d.tx_long()), d.dim(), ()), d.dim(), MONTHS),
    sql("counters_long dim", "SELECT service_name, " + ", ".join(f'{r(_CELL.format(m))} AS "{m}"' for m in MONTHS) + ", "
        + r(" + ".join(_CELL.format(m) for m in MONTHS)) + ' AS "TOTAL" FROM (SELECT DISTINCT service_name FROM dim) LEFT JOIN '
        "(SELECT service_name, strftime(date, '%Y-%m') AS month, rev FROM counters_long JOIN dim USING (cpc)) USING (service_name) GROUP BY 1"))
_COHORT = f"""SELECT service, activation_month, COUNT(*) AS total_subscriptions, {r('AVG(lifetime_days)')} AS avg_lifetime,
    {r('AVG(total_revenue_with_upgrade)')} AS avg_ltv FROM (SELECT DISTINCT lower(d.service_name) AS service, s.subscription_id, s.activation_month,
    s.lifetime_days, s.total_revenue_with_upgrade FROM (SELECT *, UNNEST(cpc_list) AS code FROM {{0}}) s JOIN dim d ON s.code = d.cpc) GROUP BY 1, 2"""
add("cohort_lt_ltv", lambda d: pr.cohort_lt_ltv(d.subs_long(), d.dim()), sql("subsl dim", _COHORT.format("subsl")))
CATEGORY = "tme_category = 'ECONOMY'"


def _category(d: Data) -> tuple[DataFrame, DataFrame]:
    codes = d.dim().where(CATEGORY).select("cpc")
    return pr.category_extract(d.subs(), codes), codes


_EXTRACT = f"hit AS (SELECT * FROM subs WHERE subscription_id IN (SELECT subscription_id FROM (SELECT subscription_id, UNNEST(cpc_list) AS code FROM subs) WHERE code IN (SELECT cpc FROM dim WHERE {CATEGORY})))"
add("list_any_in", lambda d: _category(d)[0].select("subscription_id", "cpc_list"),
    sql("subs dim", f"SELECT subscription_id, {_CODES_TEXT} FROM hit", _EXTRACT))
_SOME_CODES = [11, 12, 40, 41, 77]
add("list_any_in_literal", lambda d: pr.category_extract(d.subs(), _SOME_CODES).select("subscription_id", "cpc_list"),
    sql("subs", f"SELECT subscription_id, {_CODES_TEXT} FROM subs WHERE list_has_any(cpc_list, {_SOME_CODES})"))
add("category_overview", lambda d: pr.category_overview(_category(d)[0]),
    sql("subs dim", "SELECT COUNT(*) AS total_subscriptions, COUNT(DISTINCT tmuserid) + MAX(CASE WHEN tmuserid IS NULL THEN 1 ELSE 0 END) AS unique_users, "
        "COUNT(DISTINCT msisdn) + MAX(CASE WHEN msisdn IS NULL THEN 1 ELSE 0 END) AS unique_msisdns, COUNT(*) FILTER (WHERE subscription_status = 'Active') AS active, "
        "COUNT(deactivation_date) AS deactivated, COUNT(cancellation_date) AS cancelled, "
        f"{r('SUM(total_revenue)')} AS total_revenue, {r('AVG(total_revenue)')} AS avg_revenue, {n('SUM(renewal_count)')} AS total_renewals, "
        f"{r('AVG(renewal_count)')} AS avg_renewals, MIN(activation_date) AS first_activation, MAX(activation_date) AS last_activation FROM hit", _EXTRACT))
add("top_list_codes", lambda d: pr.top_list_codes(*_category(d)),
    sql("subs dim", f'SELECT code AS cpc, COUNT(*) AS "count" FROM (SELECT UNNEST(cpc_list) AS code FROM hit) WHERE code IN (SELECT cpc FROM dim WHERE {CATEGORY}) '
        'GROUP BY 1 ORDER BY "count" DESC, cpc LIMIT 10', _EXTRACT))

# ---- per-user reports ------------------------------------------------------------------------------


def _user_sums(key: str, view: str) -> str:
    def status(s: str) -> str:
        return f"COUNT(*) FILTER (WHERE subscription_status = '{s}')"

    return (
        f"SELECT {key}, COUNT(*) AS total_subscriptions, COUNT(DISTINCT subscription_id) AS unique_subscriptions, COUNT(DISTINCT tmuserid) AS unique_users, "
        f"COUNT(DISTINCT msisdn) AS unique_msisdns, COUNT(DISTINCT first_cpc) AS unique_cpcs, {n('SUM(renewal_count)')} AS total_renewals, "
        f"{r('SUM(total_revenue)')} AS total_revenue, {r('AVG(total_revenue)')} AS avg_revenue_per_sub, {r('MIN(total_revenue)')} AS min_revenue, "
        f"{r('MAX(total_revenue)')} AS max_revenue, {r('SUM(total_refunded)')} AS total_refunded, {n('SUM(refund_count)')} AS total_refunds, "
        f"MIN(activation_date) AS first_subscription, MAX(activation_date) AS last_subscription, {status('Active')} AS active_subs, "
        f"{status('Deactivated')} AS deactivated_subs, {status('Cancelled')} AS cancelled_subs, COUNT(*) FILTER (WHERE has_upgraded) AS upgraded_subs, "
        f"COUNT(*) FILTER (WHERE missing_act_record) AS missing_act_records, {r('AVG(lifetime_days)', 0)} AS avg_lifetime_days "
        f"FROM {view} WHERE {key} IS NOT NULL GROUP BY {key}"
    )


add("user_summary", lambda d: pk.user_summary(d.subs(), "tmuserid"), sql("subs", _user_sums("tmuserid", "subs")))
add("user_summary_by_phone", lambda d: pk.user_summary(d.subs(), "msisdn"), sql("subs", _user_sums("msisdn", "subs")))
add("user_cpc_breakdown", lambda d: pk.user_cpc_breakdown(d.subs()),
    sql("subs", f"SELECT tmuserid, first_cpc, COUNT(*) AS subscription_count, {n('SUM(renewal_count)')} AS total_renewals, {r('SUM(total_revenue)')} AS total_revenue, "
        f"{r('AVG(total_revenue)')} AS avg_revenue, MIN(activation_date) AS first_activation, MAX(activation_date) AS last_activation FROM subs "
        "WHERE tmuserid IS NOT NULL GROUP BY 1, 2"))
add("user_status_breakdown", lambda d: pk.user_status_breakdown(d.subs()),
    sql("subs", f'SELECT tmuserid, subscription_status, COUNT(*) AS "count", {r("AVG(lifetime_days)", 0)} AS avg_lifetime_days, {r("SUM(total_revenue)")} AS total_revenue, '
        f"{r('AVG(total_revenue)')} AS avg_revenue FROM subs WHERE tmuserid IS NOT NULL GROUP BY 1, 2"))
add("user_subscription_timeline", lambda d: pk.user_subscription_timeline(d.subs()),
    sql("subs", "SELECT subscription_id, tmuserid, msisdn, first_cpc, activation_date, last_activity_date, end_date, subscription_status, lifetime_days, "
        f"renewal_count, {r('total_revenue')} AS total_revenue FROM subs WHERE tmuserid IS NOT NULL"))
add("user_subscriptions", lambda d: money(pk.user_subscriptions(d.subs(), "msisdn", "M8"), *REVENUE),
    sql("subs", _life_sql("subs", _LISTED_CODES) + " WHERE msisdn = 'M8'"))

_LINES = """SELECT tx_type AS transaction_type, CAST(CASE tx_type WHEN 'CNR' THEN 99 WHEN 'RFND' THEN 100 ELSE trans_type_id END AS BIGINT) AS trans_type_id,
    subscription_id, trans_date, CASE WHEN tx_type NOT IN ('CNR', 'RFND') THEN act_date END AS act_date,
    CASE WHEN tx_type NOT IN ('CNR', 'RFND') THEN reno_date END AS reno_date, cpc, CASE WHEN tx_type <> 'RFND' THEN channel END AS channel,
    CASE WHEN tx_type NOT IN ('CNR', 'RFND') THEN camp_name END AS camp_name, rev, CASE WHEN tx_type = 'CNR' THEN channel END AS mode,
    rfnd_amount, rfnd_cnt, instant_rfnd FROM tx WHERE tx_type <> 'PPD' AND subscription_id IN
    (SELECT subscription_id FROM tx WHERE tx_type IN ('ACT', 'RENO', 'DCT') AND {})"""
add("user_timeline", lambda d: pk.user_timeline(d.tx(), "msisdn"), sql("tx", _LINES.format("msisdn IS NOT NULL")))
add("user_timeline_by_user", lambda d: pk.user_timeline(d.tx(), "tmuserid"), sql("tx", _LINES.format("tmuserid IS NOT NULL")))
add("user_timeline_one_phone", lambda d: pk.user_timeline(d.tx(), "msisdn", "M8"), sql("tx", _LINES.format("msisdn = 'M8'")))
add("timeline_summary", lambda d: pk.timeline_summary(d.tx(), "msisdn"),
    sql("tx", "SELECT subscription_id, " + ", ".join(f"COUNT(*) FILTER (WHERE tx_type = '{k}') AS {k.lower()}_count" for k in ("ACT", "RENO", "DCT", "CNR", "RFND"))
        + f", {r('COALESCE(SUM(rev), 0)')} AS total_rev, {r('COALESCE(SUM(rfnd_amount), 0)')} AS total_refunded FROM tx WHERE tx_type <> 'PPD' AND subscription_id IN "
        "(SELECT subscription_id FROM tx WHERE tx_type IN ('ACT', 'RENO', 'DCT') AND msisdn IS NOT NULL) GROUP BY 1"))
add("user_id_mapping", lambda d: pk.user_id_mapping(d.tx(), "msisdn"),
    sql("tx", "SELECT msisdn, tmuserid, COUNT(DISTINCT subscription_id) AS subscriptions FROM tx WHERE tx_type IN ('ACT', 'RENO', 'DCT') AND msisdn IS NOT NULL GROUP BY 1, 2"))
add("user_ppd", lambda d: pk.user_ppd(d.tx(), "msisdn"),
    sql("tx", "SELECT msisdn, tx_type AS transaction_type, trans_type_id, subscription_id, trans_date, cpc, channel_id, rev FROM tx WHERE tx_type = 'PPD' AND msisdn IS NOT NULL"))
add("user_ppd_total", lambda d: pk.user_ppd_total(d.tx(), "msisdn"),
    sql("tx", f"SELECT msisdn, COUNT(*) AS purchases, {r('COALESCE(SUM(rev), 0)')} AS total_ppd_rev FROM tx WHERE tx_type = 'PPD' AND msisdn IS NOT NULL GROUP BY 1"))
add("semi_keys",
    lambda d: semi_keys(d.tx(), "subscription_id", pk.subscription_keys(d.tx(), "tmuserid")).groupBy("tx_type")
    .agg(F.count(F.lit(1)).alias("reached")),
    sql("tx", "SELECT tx_type, COUNT(*) AS reached FROM tx WHERE subscription_id IN (SELECT subscription_id FROM tx WHERE tx_type IN ('ACT', 'RENO', 'DCT') AND tmuserid IS NOT NULL) GROUP BY 1"))
_MAPPED = """mapped AS (SELECT p.id AS msisdn, COALESCE(f.tmuserid, '') AS tmuserid FROM phones p LEFT JOIN (SELECT * FROM (SELECT msisdn, tmuserid,
    ROW_NUMBER() OVER (PARTITION BY msisdn ORDER BY list_position(['ACT', 'RENO', 'DCT', 'PPD'], tx_type), trans_date NULLS LAST, tie) AS place
    FROM tx WHERE tx_type IN ('ACT', 'RENO', 'DCT', 'PPD') AND tmuserid IS NOT NULL) WHERE place = 1) f ON p.id = f.msisdn)"""
add("enrich_users", lambda d: map_phones(d.listed(fx.EXCLUDED_PHONES), d.tx()), sql("tx phones", "SELECT msisdn, tmuserid FROM mapped", _MAPPED))
add("enrich_coverage", lambda d: mapping_coverage(map_phones(d.listed(fx.EXCLUDED_PHONES), d.tx_long())),
    sql("txl phones", "SELECT COUNT(*) AS listed, COUNT(*) FILTER (WHERE tmuserid <> '') AS mapped, COUNT(*) FILTER (WHERE tmuserid = '') AS unmapped FROM mapped",
        _MAPPED.replace("FROM tx ", "FROM txl ")))
add("normalise_msisdn", lambda d: d.table("customer").select("c_custkey", with_country_code(F.col("c_custkey").cast("string")).alias("phone")),
    "SELECT c_custkey, CASE WHEN CAST(c_custkey AS VARCHAR) LIKE '34%' THEN CAST(c_custkey AS VARCHAR) ELSE '34' || CAST(c_custkey AS VARCHAR) END AS phone FROM customer")

# ---- dimension -------------------------------------------------------------------------------------

def _dim_file(d: Data) -> DataFrame:
    """The dimension as CSV with empty cells, read back."""
    return load_dim(d.spark, d.written("dim", lambda p: d.raw_dim().write.option("header", True).option("escape", '"').csv(p)))


def _code_list(d: Data) -> DataFrame:
    """Codes one per line, with blank lines, spaces, repeats and text."""
    line = "CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 11 = 0 THEN 'x' ELSE ' ' || CAST(p_partkey % 500 AS STRING) END AS value"
    return load_codes(d.spark, d.written("codes", lambda p: d.table("part").selectExpr(line).write.text(p)))


add("dim_cpc_load", _dim_file, sql("dim", "SELECT * FROM dim"))
add("code_list_load", _code_list, "SELECT DISTINCT p_partkey % 500 AS cpc FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0")
_SHEET = {
    "`TME Category`": "p_type", "`Service Name`": "p_brand",
    "CPC": "CASE WHEN p_partkey % 19 = 0 THEN 'n/a' ELSE CAST(p_partkey - p_partkey % 2 AS STRING) END",
    "`Subscription Model`": "CASE p_size % 6 WHEN 0 THEN 'Monthly 9' WHEN 1 THEN 'Weekly' WHEN 2 THEN 'PPD x' WHEN 3 THEN '45 d' WHEN 4 THEN 'Fancy' END",
    "Price": "CAST(p_retailprice AS STRING)", "place": "p_partkey",
}
add("dim_cpc_build", lambda d: build_dim(fx.view(d.table("part"), _SHEET), order=F.col("place")).select(
        "cpc", "service_name", "tme_category", "cpc_period", "cpc_price"),
    """SELECT cpc, service_name, tme_category, cpc_period, cpc_price FROM (SELECT p_partkey - p_partkey % 2 AS cpc, p_brand AS service_name, p_type AS tme_category,
    CAST(CASE p_size % 6 WHEN 0 THEN 30 WHEN 1 THEN 7 WHEN 2 THEN 99999 WHEN 3 THEN 45 ELSE 0 END AS BIGINT) AS cpc_period, p_retailprice AS cpc_price,
    ROW_NUMBER() OVER (PARTITION BY p_partkey - p_partkey % 2 ORDER BY p_partkey) AS place FROM part WHERE p_partkey % 19 <> 0) WHERE place = 1""")
_SETS = {
    "`Service Name`": "CASE WHEN p_partkey % 7 <> 0 THEN p_brand END", "`TME Category`": "p_type", "Upgrade_CPC": "p_partkey + 5",
    "CHG_Period": "p_size", "CHG_Price": "p_retailprice",
    "CPCs": "CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '{' || CAST(p_partkey AS STRING) || ', ' || CAST(p_partkey + 1 AS STRING) || '}' END",
}
add("dim_cpc_expand", lambda d: expand_code_sets(fx.view(d.table("part"), _SETS)),
    """SELECT UNNEST(CASE WHEN p_partkey % 3 = 0 THEN [p_partkey + 5] ELSE [p_partkey, p_partkey + 1] END) AS cpc,
    CASE WHEN p_partkey % 7 <> 0 THEN p_brand ELSE 'UNKNOWN' END AS service_name, p_type AS tme_category, CAST(p_size AS BIGINT) AS cpc_period, p_retailprice AS cpc_price FROM part""")
_LIST_LINES = "CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'M' || CAST(s_suppkey AS STRING) END || ',' || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'U' || CAST(s_nationkey AS STRING) END"


def _excluded_file(d: Data) -> DataFrame:
    path = d.written("excluded", lambda p: d.table("supplier").selectExpr(f"{_LIST_LINES} AS value").write.text(p))
    phones, users = load_excluded(d.spark, path)
    return phones.selectExpr("'msisdn' AS kind", "msisdn AS id").unionByName(users.selectExpr("'tmuserid' AS kind", "tmuserid AS id"))


add("excluded_users_load", _excluded_file,
    "SELECT DISTINCT 'msisdn' AS kind, 'M' || CAST(s_suppkey AS VARCHAR) AS id FROM supplier WHERE s_suppkey % 5 <> 0 UNION ALL "
    "SELECT DISTINCT 'tmuserid', 'U' || CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_suppkey % 3 <> 0")

# ---- extraction from the operational tables ----------------------------------------------------------

FROM, TO = "2024-01-01", "2024-01-31"


def _part(key: str, sep: str = ";", text: str = "generic_act_info") -> str:
    return f"split_part(split_part({text}, '{key}=', 2), '{sep}', 1)"


def _extract_sql(kind: str, start: str, end: str) -> str:
    source = {
        "tmuserid": "msisdn", "msisdn": _part("chrg_refid"), "cpc": _part("cpc"), "channel_act": "channel_desc", "channel_dct": "channel_desc",
        "trans_date": "tlog_ts", "act_date": "request_ts", "reno_date": "next_charging_date", "camp_name": _part("campaign"),
        "tef_prov": _part("TEFProvider"), "campana_medium": _part("TEFmedium"), "campana_id": _part("TEFcampaign"), "rev": "charged_amount",
        "channel_id": "f.channel_id",
    }
    cols = ", ".join(f"{source.get(c, c)} AS {c}" for c in FACTS[kind].columns)
    return sql("srcf chn", f"SELECT {cols} FROM srcf f LEFT JOIN chn c ON f.channel_id = c.channel_id WHERE tlog_ts >= TIMESTAMP '{start}' "
               f"AND tlog_ts < DATE '{end}' + INTERVAL '1 day' AND trans_type_id = {fixed.SOURCE_TYPE_CODES[kind]}")


for _kind in fixed.SOURCE_TYPE_CODES:
    add(f"extract_{_kind}", lambda d, k=_kind: se.extract_fact(d.source_fact(), d.channels(), k, FROM, TO), _extract_sql(_kind, FROM, TO))
add("extract_range", lambda d: se.extract_fact(d.source_fact(), d.channels(), "act", "2024-01-05", "2024-01-20"), _extract_sql("act", "2024-01-05", "2024-01-20"))
add("extract_channel_join",
    lambda d: se.extract_fact(d.source_fact(), d.channels(), "reno", FROM, TO).groupBy("channel_act").agg(F.count(F.lit(1)).alias("renewals")),
    sql("srcf chn", "SELECT channel_desc AS channel_act, COUNT(*) AS renewals FROM srcf LEFT JOIN chn USING (channel_id) WHERE trans_type_id = 2 GROUP BY 1"))
add("extract_cnr", lambda d: se.extract_cancellations(d.source_cancellations()).withColumn("sbn_id", F.col("sbn_id").cast("bigint")),
    sql("srcc", "SELECT timestamp AS cancel_date, CAST(sbn_id AS BIGINT) AS sbn_id, msisdn AS tmuserid, cpc, mode FROM srcc"))
add("extract_refunds", lambda d: money(se.extract_refunds(d.source_refunds()), "rfnd_amount"),
    sql("srcr", f"SELECT msisdn AS tmuserid, cpc, CAST(timestamp AS DATE) AS refnd_date, {r('SUM(amount)')} AS rfnd_amount, COUNT(*) AS rfnd_cnt, "
        f"{_part('sbnId', ',', 'info')} AS sbnid, CASE WHEN info ILIKE '%automatic refund%' THEN 't' ELSE 'f' END AS instant_rfnd FROM srcr GROUP BY 1, 2, 3, 6, 7"))

# ---- ingest and storage ------------------------------------------------------------------------------

_CSV_TYPED = """typed AS (SELECT event_id, tmuserid, CASE WHEN msisdn NOT IN ('', 'NULL', 'null') THEN msisdn END AS msisdn, TRY_CAST(cpc AS BIGINT) AS cpc,
    CAST(trans_type_id AS BIGINT) AS trans_type_id, CAST(channel_id AS BIGINT) AS channel_id, channel_act,
    CASE WHEN length(trans_date) IN (10, 19) THEN CAST(trans_date AS TIMESTAMP) END AS trans_date, CAST(act_date AS TIMESTAMP) AS act_date,
    CAST(NULL AS TIMESTAMP) AS reno_date, camp_name, CAST(tef_prov AS BIGINT) AS tef_prov, CAST(NULL AS VARCHAR) AS campana_medium,
    CAST(NULL AS VARCHAR) AS campana_id, CAST(subscription_id AS BIGINT) AS subscription_id, TRY_CAST(rev AS DOUBLE) AS rev FROM csv)"""
_ACT = FACTS["act"]
_ACT_COLUMNS = ", ".join(_ACT.columns) + ", strftime(trans_date, '%Y-%m') AS year_month"
add("scan_csv_lenient", lambda d: sc.read_lenient(d.spark, _ACT, d.csv_folder()).select(*_ACT.stored_columns),
    sql("csv", f"SELECT {_ACT_COLUMNS} FROM typed", _CSV_TYPED))
add("null_dates", lambda d: sc.null_dates(sc.read_lenient(d.spark, _ACT, d.csv_folder()), _ACT),
    sql("csv", "SELECT COUNT(*) - COUNT(trans_date) AS trans_date, COUNT(*) - COUNT(act_date) AS act_date, COUNT(*) - COUNT(reno_date) AS reno_date FROM typed", _CSV_TYPED))


_STRICT_CELLS = {**fx.CSV_ACT, "cpc": f"CASE WHEN event_id % 8 = 1 THEN 'abc' ELSE CAST({fx._CODE} AS STRING) END",
                 "trans_date": "substr(CAST(ts AS STRING), 1, 19)", "rev": "CAST(value AS STRING)"}


def _write_strict(d: Data, path: str) -> None:
    """One file per provider, in order of the events; a bad cell condemns the whole file of its provider."""
    cells = {**_STRICT_CELLS, "file": fx.CSV_ACT["tef_prov"], "event_id": "event_id"}
    rows = fx.view(d.table("events").where("event_type = 'signup'"), cells)
    rows.repartition("file").sortWithinPartitions("file", "event_id").drop("event_id").write.partitionBy("file").option("header", True).option("escape", '"').csv(path)


add("scan_csv_strict",
    lambda d: sc.load_historical(d.spark, _ACT, d.written("strict", lambda p: _write_strict(d, p)))
    .groupBy("tef_prov", "cpc").agg(F.count(F.lit(1)).alias("loaded"), round_half_up(F.sum("rev"), 2).alias("rev")),
    # The load keeps the last row of a subscription and second (the files hold whole seconds).
    sql("", f"SELECT tef_prov, cpc, COUNT(*) AS loaded, {r('SUM(value)')} AS rev FROM (SELECT event_id % 4 AS tef_prov, {fx._CODE} AS cpc, value, "
        "ROW_NUMBER() OVER (PARTITION BY user_id * 10 + event_id % 4, date_trunc('second', ts) ORDER BY event_id DESC) AS place FROM events "
        "WHERE event_type = 'signup' AND event_id % 4 <> 1) WHERE place = 1 GROUP BY 1, 2"))

add("dedupe_last",
    lambda d: dedupe_fact(_numbered(d, "dct"), FACTS["dct"]).select("subscription_id", "trans_date", "trans_type_id", "cpc", "channel_dct"),
    sql("txl", "SELECT subscription_id, trans_date, trans_type_id, cpc, channel AS channel_dct FROM (SELECT *, ROW_NUMBER() OVER "
        "(PARTITION BY subscription_id, trans_date, trans_type_id ORDER BY tie DESC) AS place FROM txl WHERE tx_type = 'DCT') WHERE place = 1"))
add("dedupe_metrics", lambda d: duplicate_counts(d.raw_fact("dct", d.tx_long()), FACTS["dct"].key),
    sql("txl", f"SELECT {_DUP} FROM keys WHERE tx_type = 'DCT'", _KEYS_SQL))


def _numbered(d: Data, kind: str) -> DataFrame:
    """Raw rows of a type with their event id as reading position."""
    return d.raw_fact(kind, d.tx_long(), F.col("tie").cast("bigint").alias("_row"))


# The stored part is everything before a day; the incoming batch repeats one day before it with a new price.
CUT, AGAIN = "2001-06-01", "2001-05-30"
# The long view has few rows a day.
BY_MONTH = ("year_month",)


def _before(d: Data, kind: str, root: str) -> None:
    rows, fact = _numbered(d, kind), FACTS[kind]
    early = rows.where(F.to_date(fact.event_date) < F.lit(CUT).cast("date"))
    st.save_fact(dedupe_fact(early, fact), root, fact, partitions=BY_MONTH)


def _append(d: Data) -> DataFrame:
    """The batch appended to the table of the days before; a further run appends it again, which must change nothing."""
    fact = FACTS["reno"]
    root = d.written("reno_before", lambda path: _before(d, "reno", path))
    rows, day = _numbered(d, "reno"), F.to_date("trans_date")
    again = rows.where(day == F.lit(AGAIN).cast("date")).withColumn("rev", F.lit(1.0))
    batch = again.unionByName(rows.where(day >= F.lit(CUT).cast("date")))
    st.append_batch(d.spark, root, fact, batch)
    return st.read_fact(d.spark, root, fact).select("subscription_id", "trans_date", "trans_type_id", "cpc", "rev", "year_month")


add("append_dedupe", _append,
    sql("txl", f"SELECT subscription_id, trans_date, trans_type_id, cpc, CASE WHEN CAST(trans_date AS DATE) = DATE '{AGAIN}' THEN 1.0 ELSE rev END AS rev, year_month FROM "
        "(SELECT *, ROW_NUMBER() OVER (PARTITION BY subscription_id, trans_date, trans_type_id ORDER BY tie DESC) AS place FROM txl WHERE tx_type = 'RENO') WHERE place = 1"))


def _replaced(d: Data) -> DataFrame:
    """A table loaded with wrong rows, replaced by a full load, and appended to."""
    fact, root = FACTS["dct"], scratch_path(d.spark, "replaced")
    rows, day = _numbered(d, "dct"), F.to_date("trans_date")
    st.save_fact(rows.where(day >= F.lit(AGAIN).cast("date")).withColumn("cpc", F.lit(-1).cast("bigint")), root, fact, partitions=BY_MONTH)
    _before(d, "dct", root)
    st.append_batch(d.spark, root, fact, rows.where(day >= F.lit(CUT).cast("date")))
    return st.read_fact(d.spark, root, fact).select("subscription_id", "trans_date", "trans_type_id", "cpc", "channel_dct", "year_month")


add("table_replace_append", _replaced, sql("txd", "SELECT subscription_id, trans_date, trans_type_id, cpc, channel AS channel_dct, year_month FROM txd WHERE tx_type = 'DCT'"))


def _each_type(work: Callable) -> list:
    """One result per type. The tables are independent, so their jobs run side by side and share the executors."""
    with ThreadPoolExecutor(len(FACTS)) as pool:
        return list(pool.map(work, FACTS.values()))


def _refreshed(d: Data) -> DataFrame:
    """The lifecycle table built before the last days, which are then appended and taken in by a refresh."""
    def build(root: str) -> None:
        _each_type(lambda fact: _before(d, fact.name, jobs.transactions(root)))
        jobs.build_view(d.spark, root, CUT)

    def append(fact) -> tuple[str | None, ...]:
        rows = _numbered(d, fact.name).where(F.to_date(fact.event_date) >= F.lit(CUT).cast("date"))
        return st.append_batch(d.spark, jobs.transactions(root), fact, rows).days

    root = d.written("view_before", build)
    days = set().union(*_each_type(append))
    jobs.refresh_view(d.spark, root, LONG_AS_OF, sorted(days))
    return money(jobs.load_view(d.spark, root), *REVENUE)


add("subscription_view_incremental", _refreshed, sql("subsd", _life_sql("subsd")))


def _one_type_stored(d: Data) -> DataFrame:
    """Types without a table read as empty ones beside the one that is stored."""
    root = d.written("one_type", lambda path: st.save_fact(d.raw_fact("act", d.tx()), path, FACTS["act"]))
    tx = normalise(st.read_facts(d.spark, root))
    return tx.agg(*[F.count(F.when(F.col("tx_type") == fact.tag, 1)).alias(f"{kind}_rows") for kind, fact in FACTS.items()])


add("missing_tables_read_empty", _one_type_stored,
    sql("tx", "SELECT COUNT(*) FILTER (WHERE tx_type = 'ACT') AS act_rows, " + ", ".join(f"CAST(0 AS BIGINT) AS {k}_rows" for k in FACTS if k != "act") + " FROM tx"))


def _files_by_name(d: Data) -> DataFrame:
    """Extract files of one type among others, found by their names."""
    rows = fx.view(d.table("events").where("event_type = 'signup'"), fx.CSV_ACT)
    kind = F.when(F.col("tef_prov") == "3", "reno_atlas").otherwise("act_atlas")
    folder = d.named_files("named_extract", rows, F.concat_ws("_", kind, F.col("tef_prov")))
    found = sc.read_lenient(d.spark, _ACT, sc.list_files(d.spark, folder, _ACT))
    return found.groupBy("tef_prov").agg(F.count(F.lit(1)).alias("lines"), F.count("cpc").alias("coded"))


add("scan_files_by_name", _files_by_name,
    sql("csv", "SELECT tef_prov, COUNT(*) AS lines, COUNT(cpc) AS coded FROM typed WHERE tef_prov <> 3 GROUP BY 1", _CSV_TYPED))
add("parse_tolerant_day", lambda d: fx.view(d.table("events").where("event_type = 'signup'"), fx.CSV_ACT).select(parse_day(F.col("trans_date")).alias("day"))
    .groupBy("day").agg(F.count(F.lit(1)).alias("lines")),
    sql("csv", "SELECT CASE WHEN length(trans_date) = 10 THEN CAST(trans_date AS DATE) END AS day, COUNT(*) AS lines FROM csv GROUP BY 1"))
_SUMMARY = f"COUNT(*) AS row_count, {r('SUM(rev)')} AS rev, {r('SUM(rfnd_amount)')} AS rfnd_amount"


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), round_half_up(F.sum("rev"), 2).alias("rev"),
                                   round_half_up(F.sum("rfnd_amount"), 2).alias("rfnd_amount"))


add("scan_partitioned", lambda d: _summed(normalise(d.store()), "tx_type", "year_month"),
    sql("txl", f"SELECT tx_type, year_month, {_SUMMARY} FROM txl GROUP BY 1, 2"))
add("scan_month_pruned", lambda d: _summed(normalise(st.read_facts(d.spark, d.store_root(), MONTHS)), "tx_type", "year_month"),
    sql("txl", f"SELECT tx_type, year_month, {_SUMMARY} FROM txl WHERE year_month IN ({', '.join(repr(m) for m in MONTHS)}) GROUP BY 1, 2"))
DAY = "1999-02-10"
add("filter_day",
    lambda d: st.read_range(d.spark, d.store_root(), FACTS["reno"], DAY, DAY).select("subscription_id", "trans_date", "cpc", "rev"),
    sql("txl", f"SELECT subscription_id, trans_date, cpc, rev FROM txl WHERE tx_type = 'RENO' AND CAST(trans_date AS DATE) = DATE '{DAY}'"))
add("derive_year_month", lambda d: d.table("orders").select("o_orderkey", month_of(F.col("o_orderdate")).alias("year_month")),
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")


def _round_trip(d: Data) -> DataFrame:
    """Counters written as a table, extended by an unchanged rewrite, and read back."""
    path = scratch_path(d.spark, "counters")
    counters = pc.daily_counters(d.tx_long())
    st.save_counters(merge_counters(d.no_counters(), counters, counters.select("date")), path)
    st.save_counters(st.load_counters(d.spark, path, MONTHS), path, MONTHS)
    return st.load_counters(d.spark, path).select(*fixed.COUNTER_COLUMNS)


add("write_roundtrip", _round_trip, sql("counters_long", f"SELECT {COUNTERS} FROM counters_long"))
