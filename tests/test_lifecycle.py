import random
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger import fixed_values as fixed
from subledger.plans import lifecycle as pl
from tests.conftest import at, tuples

AS_OF = "2025-03-01"


def view(tx, **options):
    return {r.subscription_id: r for r in pl.subscription_view(tx, AS_OF, **options).collect()}


def test_columns_and_types(make_tx):
    rows = pl.subscription_view(make_tx({"tx_type": "ACT", "subscription_id": 1, "trans_date": "2025-01-01"}), AS_OF)
    assert tuple(rows.columns) == fixed.LIFECYCLE_COLUMNS and len(rows.columns) == 34
    kinds = dict(rows.dtypes)
    assert kinds["cpc_list"] == "array<bigint>" and kinds["has_upgraded"] == "boolean"
    assert kinds["lifetime_days"] == "bigint" and kinds["renewal_count"] == "bigint" and kinds["end_date"] == "timestamp_ntz"


def test_a_whole_life(make_tx):
    tx = make_tx(
        {"tx_type": "ACT", "subscription_id": 1, "tmuserid": "u", "msisdn": "m", "cpc": 5, "trans_type_id": 1, "camp_name": "c",
         "channel": "WEB", "trans_date": "2025-01-01 08:00:00", "act_date": "2025-01-01", "rev": 1.0},
        {"tx_type": "RENO", "subscription_id": 1, "cpc": 6, "trans_type_id": 2, "trans_date": "2025-01-08", "rev": 2.0},
        {"tx_type": "RENO", "subscription_id": 1, "cpc": 6, "trans_type_id": 2, "trans_date": "2025-01-15", "rev": None},
        {"tx_type": "DCT", "subscription_id": 1, "cpc": 6, "channel": "UPGRADE", "trans_date": "2025-01-20"},
        {"tx_type": "DCT", "subscription_id": 1, "cpc": 6, "channel": "APP", "trans_date": "2025-01-18"},
        {"tx_type": "RFND", "subscription_id": 1, "cpc": 6, "trans_date": "2025-01-16", "rfnd_amount": 0.5, "rfnd_cnt": 3},
        {"tx_type": "PPD", "subscription_id": 1, "cpc": 9, "trans_date": "2025-01-17", "rev": 100.0},
    )
    s = view(tx)[1]
    assert (s.cpc_list, s.cpc_count, s.first_cpc, s.current_cpc, s.has_upgraded) == ([5, 6], 2, 5, 6, True)
    assert (s.activation_revenue, s.renewal_count, s.renewal_revenue, s.total_revenue) == (1.0, 2, 2.0, 3.0)
    assert (s.deactivation_date, s.deactivation_mode, s.subscription_status) == (at("2025-01-18"), "APP", "Deactivated")
    # The view counts refund rows; the counters sum their stated number.
    assert (s.refund_count, s.total_refunded) == (1, 0.5)
    assert (s.lifetime_days, s.end_date, s.activation_month) == (17, at("2025-01-18"), "2025-01")
    assert (s.first_renewal_date, s.last_activity_date) == (at("2025-01-08"), at("2025-01-15"))


def test_upgrade_rules(make_tx):
    tx = make_tx({"tx_type": "ACT", "subscription_id": 1, "trans_type_id": 1, "channel": "WEB", "trans_date": "2025-01-01", "rev": 5.0})
    by_code, by_channel = view(tx)[1], view(tx, upgrade_rule="channel")[1]
    assert (by_code.total_revenue, by_code.total_revenue_with_upgrade, by_code.upgrade_date) == (5.0, 10.0, at("2025-01-01"))
    assert (by_channel.total_revenue_with_upgrade, by_channel.upgrade_date) == (5.0, None)


def test_renewal_only_and_foreign_facts(make_tx):
    tx = make_tx(
        {"tx_type": "RENO", "subscription_id": 1, "trans_date": "2025-01-05", "act_date": "2024-12-01"},
        {"tx_type": "CNR", "subscription_id": 2, "channel": "M", "trans_date": "2025-01-05"},
    )
    got = view(tx)
    assert set(got) == {1}
    assert (got[1].missing_act_record, got[1].activation_trans_date, got[1].activation_revenue) == (True, at("2025-01-05"), 0.0)
    assert (got[1].subscription_status, got[1].lifetime_days) == ("Active", 90)


def test_null_subscription_attaches_to_nothing(make_tx):
    tx = make_tx(
        {"tx_type": "ACT", "subscription_id": None, "cpc": 1, "trans_type_id": 1, "trans_date": "2025-01-01", "rev": 3.0},
        {"tx_type": "RENO", "subscription_id": None, "cpc": 2, "trans_date": "2025-01-02", "rev": 3.0},
        {"tx_type": "RFND", "subscription_id": None, "trans_date": "2025-01-02", "rfnd_amount": 3.0},
    )
    s = view(tx)[None]
    assert (s.cpc_list, s.cpc_count, s.current_cpc, s.has_upgraded, s.missing_act_record) == (None, None, None, False, True)
    assert (s.first_cpc, s.total_revenue, s.renewal_count, s.refund_count, s.total_refunded) == (1, 0.0, 0, 0, 0.0)


def test_negative_lifetime_is_kept(make_tx):
    tx = make_tx(
        {"tx_type": "ACT", "subscription_id": 1, "trans_date": "2025-01-10", "act_date": "2025-01-10"},
        {"tx_type": "CNR", "subscription_id": 1, "channel": "M", "trans_date": "2025-01-05"},
    )
    assert view(tx)[1].lifetime_days == -5


def test_ties_and_undated_rows(make_tx):
    tx = make_tx(
        {"tx_type": "ACT", "subscription_id": 1, "cpc": 9, "trans_date": None, "tie": 0},
        {"tx_type": "ACT", "subscription_id": 1, "cpc": 1, "trans_date": "2025-01-01", "tie": 1},
        {"tx_type": "ACT", "subscription_id": 1, "cpc": 2, "trans_date": "2025-01-01", "tie": 2},
    )
    s = view(tx)[1]
    assert (s.first_cpc, s.current_cpc, s.cpc_list) == (1, 2, [1, 2, 9])


def test_code_list_keeps_nulls_and_orders_ties(make_tx):
    tx = make_tx(
        {"tx_type": "ACT", "subscription_id": 1, "cpc": None, "trans_date": "2025-01-02"},
        {"tx_type": "ACT", "subscription_id": 1, "cpc": 7, "trans_date": "2025-01-02"},
        {"tx_type": "ACT", "subscription_id": 1, "cpc": 9, "trans_date": "2025-01-01"},
        {"tx_type": "ACT", "subscription_id": 1, "cpc": 3, "trans_date": None},
    )
    row = pl.cpc_list(tx).first()
    assert (row.cpc_list, row.cpc_count) == ([9, 7, None, 3], 3)
    assert view(tx)[1].cpc_list == [9, 7, None, 3]


def random_tx(make_tx, n=400, seed=3):
    """Many rows on few subscriptions, one of them holding a third; nulls and equal dates included."""
    pick = random.Random(seed)
    start = datetime(2025, 1, 1)
    rows = []
    for i in range(n):
        rows.append({
            "tx_type": pick.choice(["ACT", "RENO", "DCT", "CNR", "RFND", "PPD"]),
            "subscription_id": 1 if i % 3 == 0 else pick.choice([None, 2, 3, 4, 5, 6, 7]),
            "tmuserid": f"u{i}", "msisdn": f"m{i % 5}", "cpc": pick.choice([None, 1, 2, 3]),
            "trans_type_id": pick.choice([1, 2]), "channel": pick.choice([None, "UPGRADE", "WEB"]),
            "trans_date": None if i % 17 == 0 else start + timedelta(days=pick.randrange(20)),
            "act_date": start + timedelta(days=pick.randrange(20)), "rev": float(pick.randrange(5)),
            "rfnd_amount": float(pick.randrange(5)), "rfnd_cnt": pick.randrange(3),
        })
    return make_tx(*rows)


def join_form(tx):
    """The same table by its definition: the single steps, left-joined."""
    parts = [pl.actual_activation, pl.last_upgrade, pl.current_cpc, pl.last_deactivation, pl.last_cancellation,
             pl.renewal_agg, pl.refund_agg, pl.cpc_list]
    steps = [p(tx).withColumn("has_" + p.__name__, F.lit(True)) for p in parts]
    return reduce(lambda a, b: a.join(b, "subscription_id", "left"), steps, pl.first_transaction(tx)) if steps else DataFrame


def test_one_pass_equals_join_form(make_tx):
    tx = random_tx(make_tx)
    zero = lambda c: F.coalesce(c, F.lit(0))
    want = join_form(tx).select(
        "subscription_id", "tmuserid", "msisdn", "cpc_list", "cpc_count", "first_cpc", "current_cpc", "upgrade_date",
        F.col("new_cpc").alias("upgraded_to_cpc"), "activation_date",
        F.coalesce("actual_act_trans_date", "first_trans_date").alias("activation_trans_date"),
        F.col("has_actual_activation").isNull().alias("missing_act_record"),
        zero("activation_revenue").alias("activation_revenue"), zero("total_renewals").alias("renewal_count"),
        zero("total_renewal_revenue").alias("renewal_revenue"), "last_renewal_date", "first_renewal_date",
        "deactivation_date", "deactivation_mode", "cancellation_date", "cancellation_mode",
        zero("refund_count").alias("refund_count"), zero("total_refunded").alias("total_refunded"), "last_refund_date",
        (zero("activation_revenue") + zero("total_renewal_revenue") + zero("upgrade_revenue")).alias("total_revenue_with_upgrade"),
    )
    got = pl.subscription_view(tx, AS_OF).select(*want.columns)
    assert tuples(got) == tuples(want)


def test_plan_combines_before_each_shuffle(make_tx):
    """The hot subscription never reaches one task row by row: a partial aggregate stands before each exchange."""
    rows = pl.subscription_view(random_tx(make_tx, 10), AS_OF)
    lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    # One for the measures, two for the code list; the join of the two needs none.
    assert len(exchanges) == 3
    assert all("partial_" in lines[i + 1] for i in exchanges)
    steps = pl.first_transaction(random_tx(make_tx, 10))
    plan = steps._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
