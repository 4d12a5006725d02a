from datetime import date, datetime

from pyspark.sql import functions as F

from subledger.operators.merge import merge_counters
from subledger.operators.users import exclude_users, map_phones, mapping_coverage, semi_keys
from subledger.plans import counters as pc
from subledger.schemas import COUNTERS_SCHEMA, DIM_SCHEMA
from tests.conftest import tuples

D1, D2, D3 = "2024-01-01", "2024-01-02", "2024-01-03"


def days(spark, *texts):
    return spark.createDataFrame([(date.fromisoformat(t),) for t in texts], "date date")


def history(spark, *rows):
    """Counter rows of the narrow, older schema."""
    data = [(date.fromisoformat(d), c, n, n, n, 0, 0, 0) for d, c, n in rows]
    return spark.createDataFrame(
        data, "date date, cpc bigint, act_count bigint, reno_count bigint, dct_count bigint, cnr_count bigint, ppd_count bigint, rfnd_count bigint")


def test_all_measures(make_tx):
    tx = make_tx(
        {"tx_type": "ACT", "channel": "WEB", "rev": 0.0, "cpc": 1, "trans_date": D1},
        {"tx_type": "ACT", "channel": "WEB", "rev": 2.5, "cpc": 1, "trans_date": D1},
        {"tx_type": "ACT", "channel": "UPGRADE", "rev": 1.0, "cpc": 1, "trans_date": D1},
        {"tx_type": "ACT", "channel": None, "rev": 4.0, "cpc": 1, "trans_date": D1},
        {"tx_type": "RENO", "rev": 3.0, "cpc": 1, "trans_date": D1 + " 23:59:59"},
        {"tx_type": "DCT", "channel": "UPGRADE", "cpc": 1, "trans_date": D1},
        {"tx_type": "DCT", "channel": "APP", "cpc": 1, "trans_date": D1},
        {"tx_type": "CNR", "channel": "APP", "cpc": 1, "trans_date": D1},
        {"tx_type": "PPD", "rev": 5.0, "cpc": 1, "trans_date": D1},
        {"tx_type": "RFND", "rfnd_amount": 1.25, "rfnd_cnt": 3, "cpc": 1, "trans_date": D1},
        {"tx_type": "RENO", "rev": 3.0, "cpc": None, "trans_date": D1},
        {"tx_type": "RENO", "rev": 3.0, "cpc": 1, "trans_date": None},
    )
    assert tuples(pc.daily_counters(tx)) == [(date(2024, 1, 1), 1, 2, 1, 1, 1, 1, 1, 1, 1, 1, 3, 1.25, 15.5)]


def test_codes_without_a_counted_row_are_not_listed(make_tx):
    tx = make_tx(
        {"tx_type": "DCT", "channel": "UPGRADE", "cpc": 1, "trans_date": D1},
        {"tx_type": "ACT", "channel": None, "rev": 9.0, "cpc": 2, "trans_date": D1},
        {"tx_type": "ACT", "channel": "UPGRADE", "rev": 9.0, "cpc": 3, "trans_date": D1},
    )
    assert [r.cpc for r in pc.daily_counters(tx).collect()] == [3]
    assert sorted(r.cpc for r in pc.daily_counters(tx, keep_all_codes=True).collect()) == [1, 2, 3]


def test_refund_without_counts_is_zero(make_tx):
    row = pc.daily_counters(make_tx({"tx_type": "RFND", "cpc": 1, "trans_date": D1})).first()
    assert (row.rfnd_count, row.rfnd_amount, row.rev) == (0, 0.0, 0.0)


def test_merge_replaces_the_date_and_keeps_others(spark):
    existing = history(spark, (D1, 100, 10), (D2, 100, 20), (D3, 100, 30))
    new = history(spark, (D2, 100, 99), (D2, 200, 1))
    stamp = F.lit("2024-02-01").cast("timestamp_ntz")
    once = merge_counters(existing, new, days(spark, D2), stamp)
    assert tuples(once.select("date", "cpc", "act_count")) == [
        (date(2024, 1, 1), 100, 10), (date(2024, 1, 2), 100, 99), (date(2024, 1, 2), 200, 1), (date(2024, 1, 3), 100, 30)]
    assert once.columns == COUNTERS_SCHEMA.fieldNames()
    assert {r.last_updated for r in once.collect()} == {datetime(2024, 2, 1)}
    assert {(r.rev, r.act_free, r.upg_count) for r in once.collect()} == {(0.0, 0, 0)}
    assert tuples(merge_counters(once, new, days(spark, D2), stamp)) == tuples(once)


def test_forced_date_without_rows_is_emptied(spark, make_tx):
    existing = history(spark, (D1, 1, 5), (D2, 1, 6))
    none = make_tx().where("false")
    got = pc.counters_incremental(none, existing, days(spark, D1), force=True)
    assert tuples(got.select("date", "act_count")) == [(date(2024, 1, 2), 6)]


def test_incremental_skips_present_dates_unless_forced(spark, make_tx):
    tx = make_tx({"tx_type": "RENO", "cpc": 1, "trans_date": D1}, {"tx_type": "RENO", "cpc": 1, "trans_date": D2})
    existing = history(spark, (D1, 1, 50))
    count = lambda rows: tuples(rows.select("date", "reno_count"))
    assert count(pc.counters_incremental(tx, existing)) == [(date(2024, 1, 1), 50), (date(2024, 1, 2), 1)]
    assert count(pc.counters_incremental(tx, existing, force=True)) == [(date(2024, 1, 1), 1), (date(2024, 1, 2), 1)]
    assert tuples(pc.missing_counter_dates(tx, existing)) == [(date(2024, 1, 2),)]


def test_one_job_equals_day_by_day(spark, make_tx):
    tx = make_tx(*[{"tx_type": t, "cpc": c, "channel": "WEB", "rev": 1.0, "trans_date": d}
                   for t in ("ACT", "RENO", "DCT") for c in (1, 2) for d in (D1, D2, D3)])
    stamp = F.lit(D1).cast("timestamp_ntz")
    at_once = pc.counters_incremental(tx, spark.createDataFrame([], COUNTERS_SCHEMA), stamp=stamp)
    step = spark.createDataFrame([], COUNTERS_SCHEMA)
    for d in (D1, D2, D3):
        step = pc.counters_incremental(tx, step, days(spark, d), stamp=stamp)
    assert tuples(step) == tuples(at_once)


def dim(spark, *rows):
    return spark.createDataFrame(list(rows), DIM_SCHEMA)


def test_unmapped_codes_become_unknown(spark):
    counters = history(spark, (D1, 100, 10), (D1, 999, 5))
    products = dim(spark, (100, "Mapped", "Games", 30, 2.0))
    rows = pc.counters_service(counters, products)
    assert tuples(pc.unmapped_cpcs(counters, products)) == [(999,)]
    unknown = rows.where("service_name = 'UNKNOWN'").collect()
    assert len(unknown) == 1
    assert (unknown[0].act_count, unknown[0].tme_category, unknown[0].cpc_period, unknown[0].cpc_price) == (5, "", 0, 0.0)


def test_excluded_services(spark):
    counters = history(spark, (D1, 1, 1), (D1, 2, 1))
    products = dim(spark, (1, "Nubico Plus", "", 0, 0.0), (2, "Chess", "", 0, 0.0))
    assert [r.service_name for r in pc.counters_service(counters, products).collect()] == ["Chess"]
    assert pc.counters_service(counters, products, ()).count() == 2


def test_service_rollup_sums_codes(spark):
    counters = history(spark, (D1, 2, 1), (D1, 10, 4))
    products = dim(spark, (2, "S", "C", 7, 1.0), (10, "S", "C", 30, 2.0))
    row = pc.service_rollup(counters, products).first()
    assert (row.cpcs, row.act_count, row.cpc_period, row.cpc_price) == ("2, 10", 5, 7, 1.0)


def _ids(rows):
    return sorted((r.tmuserid or "-") + "/" + (r.msisdn or "-") for r in rows.collect())


def test_exclusion_and_null_ids(spark, make_tx):
    tx = make_tx(
        {"tx_type": "ACT", "tmuserid": "u1", "msisdn": "a"}, {"tx_type": "ACT", "tmuserid": "u2", "msisdn": "b"},
        {"tx_type": "ACT", "tmuserid": "u3", "msisdn": None}, {"tx_type": "RFND", "tmuserid": "u4", "msisdn": None},
        {"tx_type": "RFND", "tmuserid": None, "msisdn": None},
    )
    some = spark.createDataFrame([("a",), ("",)], "id string")
    none = spark.createDataFrame([], "id string")
    assert _ids(exclude_users(tx, some)) == ["-/-", "u2/b", "u4/-"]
    assert len(_ids(exclude_users(tx, none, none))) == 5
    assert _ids(exclude_users(tx, some, keep_null_ids=True)) == ["-/-", "u2/b", "u3/-", "u4/-"]
    assert _ids(exclude_users(tx, None, spark.createDataFrame([("u4",)], "id string"))) == ["u1/a", "u2/b", "u3/-"]


def test_semi_keys(spark, make_tx):
    tx = make_tx(*[{"tx_type": "ACT", "subscription_id": i} for i in (1, 2, 3, None)])
    keys = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k bigint")
    assert sorted(r.subscription_id for r in semi_keys(tx, "subscription_id", keys).collect()) == [1, 3]
    assert semi_keys(tx, "subscription_id", keys.where("false")).count() == 0


def test_phone_mapping(spark, make_tx):
    tx = make_tx(
        {"tx_type": "PPD", "msisdn": "1", "tmuserid": "late type", "trans_date": D1},
        {"tx_type": "ACT", "msisdn": "1", "tmuserid": "second", "trans_date": D2},
        {"tx_type": "ACT", "msisdn": "1", "tmuserid": None, "trans_date": D1},
        {"tx_type": "ACT", "msisdn": "1", "tmuserid": "first", "trans_date": D1 + " 05:00:00"},
        {"tx_type": "CNR", "msisdn": "2", "tmuserid": "not looked at", "trans_date": D1},
    )
    phones = spark.createDataFrame([("1",), ("2",), ("3",), ("",)], "p string")
    got = map_phones(phones, tx)
    assert tuples(got) == [("1", "first"), ("2", ""), ("3", "")]
    assert tuples(mapping_coverage(got)) == [(3, 1, 2)]
