from datetime import date

import pytest
from pyspark.sql import functions as F

from subledger.plans import lookup as pk
from subledger.plans import reports as pr
from subledger.plans import userbase as pu
from subledger.plans.lifecycle import subscription_view
from subledger.schemas import DIM_SCHEMA
from subledger.sources.snapshots import clean_snapshot, name_date, read_snapshots, rejected
from tests.conftest import tuples


def dim(spark, *rows):
    return spark.createDataFrame([(c, s, t, 0, 0.0) for c, s, t in rows], DIM_SCHEMA)


def test_refund_users_count_null_as_one(spark, make_tx):
    row = {"tx_type": "RFND", "cpc": 1, "trans_date": "2025-01-01", "rfnd_amount": 1.0, "rfnd_cnt": 2}
    tx = make_tx({**row, "tmuserid": "u1", "instant_rfnd": "f"}, {**row, "tmuserid": "u1", "instant_rfnd": "t"},
                 {**row, "tmuserid": None, "instant_rfnd": "f"})
    got = pr.refund_analysis(tx, dim(spark, (1, "S", "C")), ["2025-01"])
    # One user is in both groups, so the parts may add up to more than the whole.
    assert tuples(got) == [("2025-01", 1, "S", "C", 3.0, 6, 2, 2, 1)]
    assert got.columns == ["year_month", "cpc", "service_name", "tme_category", "cpcTotalRfdsAmount", "cpcTotalRfdsCount",
                           "cpcTotalRfdsCountUU", "RegularRfdsUU", "AutomaticRfdsUU"]
    assert pr.refund_analysis(tx, dim(spark), ["2024-12"]).count() == 0
    assert pr.refund_analysis(tx, dim(spark)).first().service_name is None


def test_refund_order(spark, make_tx):
    row = {"tx_type": "RFND", "tmuserid": "u", "rfnd_amount": 1.0}
    tx = make_tx(*[{**row, "cpc": c, "rfnd_cnt": n, "trans_date": d} for c, n, d in
                   [(1, 1, "2025-02-01"), (2, 5, "2025-02-01"), (3, 2, "2025-01-01")]])
    assert [r.cpc for r in pr.refund_analysis(tx, dim(spark)).collect()] == [3, 2, 1]


def test_revenue_pivot_shows_zero_for_absent_pairs(spark):
    counters = spark.createDataFrame(
        [("2025-01-01", " Chess ", 1.5), ("2025-01-02", "Chess", 2.0), ("broken", "Chess", 9.0), ("2025-03-01", "Chess", 9.0), ("2025-01-01", "Other", 9.0)],
        "date string, service_name string, rev double")
    got = pr.revenue_pivot(counters, ["Chess", "Absent"], ["2025-02", "2025-01"])
    assert got.columns == ["service_name", "2025-01", "2025-02", "TOTAL"]
    assert tuples(got) == [("Absent", 0.0, 0.0, 0.0), ("Chess", 3.5, 0.0, 3.5)]


@pytest.fixture
def subs(make_tx):
    def act(sub, user, phone, cpc, day, rev):
        return {"tx_type": "ACT", "subscription_id": sub, "tmuserid": user, "msisdn": phone, "cpc": cpc, "trans_type_id": 2,
                "trans_date": day, "act_date": day, "rev": rev}

    tx = make_tx(act(1, "u1", "m1", 10, "2025-01-01", 1.0), act(1, "u1", "m1", 11, "2025-01-02", 1.0),
                 act(2, "u1", "m2", 20, "2025-01-05", 2.0), act(3, None, "m2", 10, "2025-02-01", 4.0))
    return subscription_view(tx, "2025-02-11")


def test_cohort(spark, subs):
    products = dim(spark, (10, "Chess", "Games"), (11, "CHESS", "Games"), (20, "Songs", "Music"))
    # Two codes of one service make one member.
    assert tuples(pr.cohort_lt_ltv(subs, products, "chess", "2025-01")) == [("chess", "2025-01", 1, 41.0, 1.0)]
    assert pr.cohort_lt_ltv(subs, products).count() == 3


def test_category(spark, subs):
    codes = spark.createDataFrame([(11,), (20,), (99,)], "cpc bigint")
    by_table, by_list = pr.category_extract(subs, codes), pr.category_extract(subs, [11, 20, 99])
    assert tuples(by_table) == tuples(by_list)
    over = pr.category_overview(by_list).first()
    assert (over.total_subscriptions, over.unique_users, over.unique_msisdns, over.active, over.total_revenue) == (2, 1, 2, 2, 3.0)
    assert tuples(pr.top_list_codes(by_list, codes)) == [(11, 1), (20, 1)]
    assert pr.category_overview(subs).first().unique_users == 2


def test_user_reports(subs):
    one = pk.user_summary(subs, "tmuserid", "u1").first()
    assert (one.total_subscriptions, one.unique_msisdns, one.total_revenue, one.upgraded_subs) == (2, 2, 3.0, 1)
    everyone = pk.user_summary(subs, "msisdn")
    assert tuples(everyone.select("msisdn", "total_subscriptions", "unique_users")) == [("m1", 1, 1), ("m2", 2, 1)]
    assert [r.subscription_id for r in pk.user_subscriptions(subs, "msisdn", "m2").collect()] == [3, 2]
    assert pk.user_cpc_breakdown(subs, "tmuserid", "u1").count() == 2
    assert tuples(pk.user_status_breakdown(subs, "tmuserid", "u1").select("subscription_status", "count")) == [("Active", 2)]
    assert [r.subscription_id for r in pk.user_subscription_timeline(subs, "tmuserid", "u1").collect()] == [1, 2]
    with pytest.raises(ValueError):
        pk.user_summary(subs, "cpc")


def test_timeline_takes_two_hops(make_tx):
    tx = make_tx(
        {"tx_type": "ACT", "subscription_id": 1, "msisdn": "m1", "tmuserid": "u1", "trans_type_id": 1, "trans_date": "2025-01-01", "rev": 1.0},
        {"tx_type": "RENO", "subscription_id": 1, "msisdn": "m9", "tmuserid": "u2", "trans_type_id": 2, "trans_date": "2025-01-02", "rev": 2.0},
        {"tx_type": "CNR", "subscription_id": 1, "channel": "APP", "trans_date": "2025-01-03"},
        {"tx_type": "RFND", "subscription_id": 1, "trans_date": "2025-01-03", "rfnd_amount": 0.5, "rfnd_cnt": 1, "instant_rfnd": "t"},
        {"tx_type": "PPD", "subscription_id": 1, "msisdn": "m1", "trans_date": "2025-01-03", "rev": 7.0},
        {"tx_type": "ACT", "subscription_id": 2, "msisdn": "m2", "trans_date": "2025-01-01"},
    )
    lines = pk.user_timeline(tx, "msisdn", "m1").collect()
    assert [(r.transaction_type, r.trans_type_id) for r in lines] == [("ACT", 1), ("RENO", 2), ("CNR", 99), ("RFND", 100)]
    assert (lines[2].channel, lines[2].mode, lines[3].channel) == ("APP", "APP", None)
    assert tuples(pk.timeline_summary(tx, "msisdn", "m1")) == [(1, 1, 1, 0, 1, 1, 3.0, 0.5)]
    assert tuples(pk.timeline_summary(tx)) == [(1, 1, 1, 0, 1, 1, 3.0, 0.5), (2, 1, 0, 0, 0, 0, 0.0, 0.0)]
    assert pk.user_timeline(tx, "msisdn").count() == 5
    assert pk.user_timeline(tx, "msisdn", "nobody").count() == 0
    assert tuples(pk.user_id_mapping(tx, "msisdn", "m1")) == [("m1", "u1", 1)]
    assert tuples(pk.user_ppd_total(tx)) == [("m1", 1, 7.0)]


def snapshots(spark):
    rows = [("2025-01-01", " Chess", "Education ", "1", "10.9"), ("2025-01-01", "Chess", "images", "2", "5"),
            ("2025-01-01", "Nubico", "News", "3", "100"), ("2025-01-01", "Songs", "Music", "4", "n/a")]
    return spark.createDataFrame(rows, "d string, service_name string, tme_category string, cpc string, count string").select(
        F.col("d").cast("date").alias("date"), "service_name", "tme_category", "cpc", "count")


def test_user_base_levels(spark):
    clean = clean_snapshot(snapshots(spark))
    day = date(2025, 1, 1)
    assert tuples(pu.user_base_rollup(clean, "service")) == [(day, "Chess", "Edu_Ima", 15)]
    assert tuples(pu.user_base_rollup(clean, "category")) == [(day, "Edu_Ima", 15)]
    assert tuples(pu.user_base_rollup(clean, "cpc")) == [(day, 1, 10), (day, 2, 5)]
    levels = pu.user_base_all_levels(clean)
    for level, keys in pu.LEVELS.items():
        one = levels.where(F.col("level") == level).select(*keys, "User_Base")
        assert tuples(one) == tuples(pu.user_base_rollup(clean, level))
    assert tuples(rejected(snapshots(spark))) == [(day, 1)]


def test_reconcile(spark):
    clean = clean_snapshot(snapshots(spark))
    by_service, by_cpc = pu.user_base_rollup(clean, "service"), pu.user_base_rollup(clean, "cpc")
    day = date(2025, 1, 1)
    whole = dim(spark, (1, "Chess ", ""), (2, "Chess", ""))
    assert tuples(pu.reconcile_user_base(by_service, by_cpc, whole)) == [("Chess", day, 15, 15, 0)]
    part = dim(spark, (1, "Chess", ""))
    assert tuples(pu.reconcile_user_base(by_service, by_cpc, part, "Chess", "2025-01-01")) == [("Chess", day, 15, 10, 5)]


def test_snapshot_files(spark, tmp_path):
    (tmp_path / "20250102_base.csv").write_text("service_name,tme_category,cpc,count\nChess,Games,1,3\n", encoding="utf-8")
    (tmp_path / "notes.csv").write_text("service_name,tme_category,cpc,count\nChess,Games,1,4\n", encoding="utf-8")
    assert tuples(read_snapshots(spark, str(tmp_path)).select("date", "count")) == sorted([(date(2025, 1, 2), 3), (None, 4)], key=repr)
    latin = tmp_path / "latin"
    latin.mkdir()
    (latin / "20250102_base.csv").write_text("service_name,tme_category,cpc,count\nMúsica,Games,1,3\n", encoding="latin-1")
    assert read_snapshots(spark, str(latin), "ISO-8859-1").first().service_name == "Música"
    assert spark.range(1).select(name_date(F.lit("20251345_x"))).first()[0] is None


def test_category_extract_is_a_test_of_each_row(spark, subs):
    codes = spark.createDataFrame([(11,), (20,), (None,)], "cpc bigint")
    got = pr.category_extract(subs, codes)
    assert sorted(r.subscription_id for r in got.collect()) == [1, 2]
    assert pr.category_extract(subs, codes.where("cpc > 99")).count() == 0
    stored = spark.createDataFrame([(1, [10])], "subscription_id bigint, cpc_list array<bigint>")
    main = pr.category_extract(stored, codes)._jdf.queryExecution().executedPlan().toString().split("Subqueries")[0]
    assert "Join" not in main and "Exchange" not in main.split("Subquery")[0]


def test_user_summary_copies_no_rows_for_its_distinct_counts(spark, subs):
    for key in ("tmuserid", "msisdn", "subscription_id"):
        plan = pk.user_summary(subs, key)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan
    got = {r.tmuserid: r for r in pk.user_summary(subs).collect()}
    assert got["u1"].unique_msisdns == 2 and got["u1"].unique_cpcs == 2 and got["u1"].unique_users == 1
    one = pk.user_summary(subs, "tmuserid", "nobody").first()
    assert one.total_subscriptions == one.unique_users == one.active_subs == 0 and one.total_revenue is None
