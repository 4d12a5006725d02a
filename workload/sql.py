"""SQL counterparts of the views and of the lifecycle table, for DuckDB."""

from __future__ import annotations

from workload import fixtures as fx

NTZ_COLUMNS = {"trans_date", "act_date", "reno_date"}


def r(expr: str, places: int = 2) -> str:
    """Half-away rounding of the decimal value."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,6)), {places}) AS DOUBLE)"


def n(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _pick(name: str, source: str, where: str, first: bool) -> str:
    way = "ASC NULLS LAST, tie ASC" if first else "DESC NULLS LAST, tie DESC"
    return (
        f"{name} AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY subscription_id "
        f"ORDER BY trans_date {way}) AS place FROM {source} WHERE {where}) WHERE place = 1)"
    )


def _lifecycle(prefix: str, tx: str, as_of: str, upgrade: str = "trans_type_id = 1") -> dict[str, str]:
    """CTEs of the lifecycle table in its join form: one relation per part, left-joined by subscription."""
    p = prefix
    paid = "tx_type IN ('ACT', 'RENO')"
    return {
        f"{p}_opening": _pick(f"{p}_opening", tx, paid, True),
        f"{p}_act": _pick(f"{p}_act", tx, "tx_type = 'ACT'", True),
        f"{p}_upg": _pick(f"{p}_upg", tx, f"tx_type = 'ACT' AND {upgrade}", False),
        f"{p}_newest": _pick(f"{p}_newest", tx, paid, False),
        f"{p}_dct": _pick(f"{p}_dct", tx, "tx_type = 'DCT' AND channel <> 'UPGRADE'", False),
        f"{p}_cnr": _pick(f"{p}_cnr", tx, "tx_type = 'CNR'", False),
        f"{p}_codes": f"""{p}_codes AS (SELECT subscription_id, LIST(cpc ORDER BY seen NULLS LAST, cpc NULLS LAST) AS cpc_list,
            COUNT(cpc) AS cpc_count FROM (SELECT subscription_id, cpc, MIN(trans_date) AS seen FROM {tx} WHERE {paid}
            GROUP BY subscription_id, cpc) GROUP BY subscription_id)""",
        f"{p}_reno": f"""{p}_reno AS (SELECT subscription_id, COUNT(*) AS cnt, SUM(rev) AS rev, MAX(trans_date) AS hi,
            MIN(trans_date) AS lo FROM {tx} WHERE tx_type = 'RENO' GROUP BY subscription_id)""",
        f"{p}_rfnd": f"""{p}_rfnd AS (SELECT subscription_id, COUNT(*) AS cnt, SUM(rfnd_amount) AS amount,
            MAX(trans_date) AS hi FROM {tx} WHERE tx_type = 'RFND' GROUP BY subscription_id)""",
        p: f"""{p} AS (SELECT o.subscription_id, o.tmuserid, o.msisdn, k.cpc_list, {n('k.cpc_count')} AS cpc_count,
            o.cpc AS first_cpc, w.cpc AS current_cpc, COALESCE(k.cpc_count > 1, FALSE) AS has_upgraded,
            u.trans_date AS upgrade_date, u.cpc AS upgraded_to_cpc, o.act_date AS activation_date,
            COALESCE(a.trans_date, o.trans_date) AS activation_trans_date, a.subscription_id IS NULL AS missing_act_record,
            o.camp_name AS activation_campaign, o.channel AS activation_channel, COALESCE(a.rev, 0.0) AS activation_revenue,
            o.year_month AS activation_month, {n('COALESCE(e.cnt, 0)')} AS renewal_count, COALESCE(e.rev, 0.0) AS renewal_revenue,
            e.hi AS last_renewal_date, e.lo AS first_renewal_date, COALESCE(e.hi, o.act_date) AS last_activity_date,
            d.trans_date AS deactivation_date, d.channel AS deactivation_mode, c.trans_date AS cancellation_date,
            c.channel AS cancellation_mode, {n('COALESCE(f.cnt, 0)')} AS refund_count, COALESCE(f.amount, 0.0) AS total_refunded,
            f.hi AS last_refund_date, COALESCE(a.rev, 0.0) + COALESCE(e.rev, 0.0) AS total_revenue,
            COALESCE(a.rev, 0.0) + COALESCE(e.rev, 0.0) + COALESCE(u.rev, 0.0) AS total_revenue_with_upgrade,
            CASE WHEN c.trans_date IS NOT NULL THEN 'Cancelled' WHEN d.trans_date IS NOT NULL THEN 'Deactivated'
                ELSE 'Active' END AS subscription_status,
            {n(f"DATE_DIFF('day', o.act_date, COALESCE(c.trans_date, d.trans_date, TIMESTAMP '{as_of}'))")} AS lifetime_days,
            COALESCE(c.trans_date, d.trans_date) AS end_date
            FROM {p}_opening o LEFT JOIN {p}_codes k USING (subscription_id) LEFT JOIN {p}_act a ON a.subscription_id = o.subscription_id
            LEFT JOIN {p}_newest w ON w.subscription_id = o.subscription_id LEFT JOIN {p}_upg u ON u.subscription_id = o.subscription_id
            LEFT JOIN {p}_reno e ON e.subscription_id = o.subscription_id LEFT JOIN {p}_dct d ON d.subscription_id = o.subscription_id
            LEFT JOIN {p}_cnr c ON c.subscription_id = o.subscription_id LEFT JOIN {p}_rfnd f ON f.subscription_id = o.subscription_id)""",
    }


def counters_cte(name: str, tx: str, keep_all: bool = False) -> str:
    """The daily counters, one sub-select per measure group."""
    act, dct = "tx_type = 'ACT'", "tx_type = 'DCT'"
    up, not_up = "channel = 'UPGRADE'", "channel <> 'UPGRADE'"

    def cnt(where: str, alias: str) -> str:
        return f"{n(f'COUNT(*) FILTER (WHERE {where})')} AS {alias}"

    having = "" if keep_all else (
        f"HAVING COUNT(*) FILTER (WHERE ({act} AND channel IS NOT NULL) OR ({dct} AND {not_up}) "
        "OR tx_type IN ('RENO', 'CNR', 'PPD', 'RFND')) > 0"
    )
    return f"""{name} AS (SELECT CAST(trans_date AS DATE) AS date, cpc, {cnt(f'{act} AND {not_up}', 'act_count')},
        {cnt(f'{act} AND {not_up} AND rev = 0', 'act_free')}, {cnt(f'{act} AND {not_up} AND rev > 0', 'act_pay')},
        {cnt(f'{act} AND {up}', 'upg_count')}, {cnt("tx_type = 'RENO'", 'reno_count')},
        {cnt(f'{dct} AND {not_up}', 'dct_count')}, {cnt(f'{dct} AND {up}', 'upg_dct_count')},
        {cnt("tx_type = 'CNR'", 'cnr_count')}, {cnt("tx_type = 'PPD'", 'ppd_count')},
        {n("COALESCE(SUM(rfnd_cnt) FILTER (WHERE tx_type = 'RFND'), 0)")} AS rfnd_count,
        {r('COALESCE(SUM(rfnd_amount), 0)')} AS rfnd_amount, {r('COALESCE(SUM(rev), 0)')} AS rev
        FROM {tx} WHERE trans_date IS NOT NULL AND cpc IS NOT NULL GROUP BY 1, 2 {having})"""


COUNTERS = (
    "date, cpc, act_count, act_free, act_pay, upg_count, reno_count, dct_count, upg_dct_count, cnr_count, "
    "ppd_count, rfnd_count, rfnd_amount, rev"
)


def _listed(spec: tuple[str, str, str]) -> str:
    table, expr, condition = spec
    return f"SELECT DISTINCT {expr} AS id FROM {table} WHERE {condition}"


CTES: dict[str, str] = {
    "tx": f"tx AS (SELECT {fx.select_text(fx.TX)} FROM events)",
    "txl": f"txl AS (SELECT {fx.select_text(fx.TX_LONG_ORDERS)} FROM orders UNION ALL "
           f"SELECT {fx.select_text(fx.TX_LONG_LINES)} FROM lineitem)",
    # One row per dedupe key, the last one read; of a moment, the type code orders the types.
    "txd": "txd AS (SELECT * EXCLUDE (place) REPLACE (COALESCE(trans_type_id, 0) AS tie) FROM (SELECT *, ROW_NUMBER() OVER "
           "(PARTITION BY tx_type, subscription_id, trans_date, trans_type_id ORDER BY tie DESC) AS place FROM txl) WHERE place = 1)",
    "rawdim": f"rawdim AS (SELECT {fx.select_text(fx.DIM)} FROM part)",
    "dim": "dim AS (SELECT cpc, COALESCE(service_name, 'UNKNOWN') AS service_name, COALESCE(tme_category, '') AS tme_category, "
           f"{n('COALESCE(cpc_period, 0)')} AS cpc_period, COALESCE(cpc_price, 0.0) AS cpc_price FROM rawdim)",
    "phones": f"phones AS ({_listed(fx.EXCLUDED_PHONES)})",
    "users": f"users AS ({_listed(fx.EXCLUDED_USERS)})",
    # A listed id drops its rows; once anything is listed, rows without the id go too.
    "txx": "txx AS (SELECT * FROM tx WHERE (tx_type IN ('CNR', 'RFND') OR (SELECT COUNT(*) FROM phones) = 0 OR "
           "(msisdn IS NOT NULL AND msisdn NOT IN (SELECT id FROM phones))) AND ((SELECT COUNT(*) FROM users) = 0 OR "
           "(tmuserid IS NOT NULL AND tmuserid NOT IN (SELECT id FROM users))))",
    "counters": counters_cte("counters", "tx"),
    "counters_x": counters_cte("counters_x", "txx"),
    "counters_long": counters_cte("counters_long", "txl"),
    "svc": f"""svc AS (SELECT date, COALESCE(service_name, 'UNKNOWN') AS service_name, COALESCE(tme_category, '') AS tme_category,
        cpc, {n('COALESCE(cpc_period, 0)')} AS cpc_period, COALESCE(cpc_price, 0.0) AS cpc_price,
        {COUNTERS.replace('date, cpc, ', '')} FROM counters LEFT JOIN dim USING (cpc)
        WHERE lower(COALESCE(service_name, 'UNKNOWN')) NOT LIKE '%brand#1%')""",
    "snap": f"snap AS (SELECT {fx.select_text(fx.SNAPSHOT)} FROM orders JOIN part ON {fx.SNAPSHOT_JOIN})",
    "base": """base AS (SELECT date, trim(service_name) AS service_name, CASE WHEN lower(trim(tme_category)) IN ('economy', 'promo')
        THEN 'Eco_Promo' WHEN lower(trim(tme_category)) IN ('small', 'medium') THEN 'Small_Med' ELSE trim(tme_category) END
        AS tme_category, cpc, CAST(trunc(CAST("count" AS DOUBLE)) AS BIGINT) AS cnt FROM snap
        WHERE lower(trim(service_name)) NOT LIKE '%brand#1%')""",
    "srcf": f"srcf AS (SELECT {fx.select_text(fx.SOURCE_FACT)} FROM events)",
    "chn": f"chn AS (SELECT {fx.select_text(fx.SOURCE_CHANNELS)} FROM region)",
    "srcc": f"srcc AS (SELECT {fx.select_text(fx.SOURCE_CANCELLATIONS)} FROM events WHERE event_type = 'click')",
    "srcr": f"srcr AS (SELECT {fx.select_text(fx.SOURCE_REFUNDS)} FROM events WHERE event_type = 'error')",
    "csv": f"csv AS (SELECT event_id, {fx.select_text(fx.CSV_ACT)} FROM events WHERE event_type = 'signup')",
    **_lifecycle("subs", "tx", fx.AS_OF),
    **_lifecycle("subsc", "tx", fx.AS_OF, "channel = 'UPGRADE'"),
    **_lifecycle("subsl", "txl", fx.LONG_AS_OF),
    **_lifecycle("subsd", "txd", fx.LONG_AS_OF),
}

_NEEDS: dict[str, tuple[str, ...]] = {
    "dim": ("rawdim",), "txx": ("tx", "phones", "users"), "counters": ("tx",), "counters_x": ("txx",),
    "counters_long": ("txl",), "txd": ("txl",), "svc": ("counters", "dim"), "base": ("snap",),
    **{p: (tx, *[f"{p}_{part}" for part in
                 ("opening", "act", "upg", "newest", "dct", "cnr", "codes", "reno", "rfnd")])
       for p, tx in (("subs", "tx"), ("subsc", "tx"), ("subsl", "txl"), ("subsd", "txd"))},
}


def _ordered(name: str, seen: list[str]) -> None:
    for need in _NEEDS.get(name, ()):
        _ordered(need, seen)
    if name not in seen:
        seen.append(name)


def sql(needs: str, body: str, extra: str = "") -> str:
    """``body`` under the named views; ``extra`` holds further CTEs of its own."""
    names: list[str] = []
    for need in needs.split():
        _ordered(need, names)
    ctes = [CTES[name] for name in names] + ([extra] if extra else [])
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
