from datetime import date

from pyspark.sql import functions as F

from subledger.operators.dedupe import duplicate_counts, keep_last
from subledger.operators.gaps import backfill_rows, calendar, distinct_dates, gap_ranges, missing_dates
from subledger.plans import quality as pq
from subledger.plans.lifecycle import subscription_view
from tests.conftest import tuples


def D(n):
    return date(2025, 1, n)


def dates(spark, *numbers):
    return spark.createDataFrame([(D(n),) for n in numbers], "date date")


def test_gap_ranges_and_back(spark):
    missing = missing_dates(dates(spark, 1, 2, 5, 9))
    assert tuples(missing) == [(D(n),) for n in (3, 4, 6, 7, 8)]
    ranges = gap_ranges(missing)
    assert tuples(ranges) == [(D(3), D(4), 2), (D(6), D(8), 3)]
    again = ranges.select(F.explode(F.sequence("gap_start", "gap_end")).alias("date"))
    assert tuples(again) == tuples(missing)


def test_missing_dates_bounds_and_groups(spark):
    rows = spark.createDataFrame([("a", D(1)), ("a", D(3)), ("b", D(9))], "k string, date date")
    end = F.lit("2025-01-04").cast("date")
    # Group b starts after the end: nothing to check.
    assert tuples(missing_dates(rows, ["k"], end=end)) == [("a", D(2)), ("a", D(4))]
    assert missing_dates(rows.where("false"), ["k"]).count() == 0


def test_calendar_is_inclusive(spark):
    assert calendar(spark, "2025-01-30", "2025-02-02").count() == 4


def test_undated_rows_have_no_date(make_tx):
    tx = make_tx({"trans_date": "2025-01-01 10:00:00"}, {"trans_date": "2025-01-01 11:00:00"}, {"trans_date": None})
    assert tuples(distinct_dates(tx, "trans_date")) == [(D(1),)]


def test_backfill_takes_only_missing_days_and_the_tail(spark, make_tx):
    source = make_tx(*[{"tx_type": "ACT", "cpc": n, "trans_date": f"2025-01-0{n} 12:00:00"} for n in (1, 2, 3, 4, 6)])
    got = backfill_rows(dates(spark, 2, 4), source, "trans_date")
    assert sorted(r.cpc for r in got.collect()) == [3, 6]


def test_keep_last_treats_null_as_a_key(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k bigint, o bigint")
    assert tuples(keep_last(rows, ["k"], [F.col("o")])) == sorted([(None, 2), (1, 3)], key=repr)
    assert tuples(duplicate_counts(rows, ["k"])) == [(3, 2, 1)]
    assert tuples(duplicate_counts(rows.where("false"), ["k"])) == [(0, 0, 0)]


def test_completeness_stops_before_the_day(make_tx):
    tx = make_tx({"tx_type": "ACT", "trans_date": "2025-01-01"}, {"tx_type": "ACT", "trans_date": "2025-01-03"},
                 {"tx_type": "CNR", "trans_date": "2025-01-01"})
    assert tuples(pq.completeness_tx(tx, "2025-01-06")) == [("ACT", D(2)), ("ACT", D(4)), ("ACT", D(5))]
    assert tuples(pq.completeness_ranges(tx, "2025-01-06")) == [("ACT", D(2), D(2), 1), ("ACT", D(4), D(5), 2)]


def test_lifecycle_completeness_starts_with_the_renewals(make_tx):
    tx = make_tx(
        {"tx_type": "ACT", "subscription_id": 1, "trans_date": "2025-01-01", "act_date": "2025-01-01"},
        {"tx_type": "RENO", "subscription_id": 1, "trans_date": "2025-01-04"},
        {"tx_type": "ACT", "subscription_id": 2, "trans_date": "2025-01-05", "act_date": "2025-01-05"},
    )
    got = pq.completeness_lifecycle(subscription_view(tx, "2025-01-07"), "2025-01-07")
    assert tuples(got) == [("Activation", D(4)), ("Activation", D(6)), ("Last Renewal", D(5)), ("Last Renewal", D(6))]


def test_duplicates_use_the_short_key_for_two_types(make_tx):
    same = {"subscription_id": 1, "trans_date": "2025-01-01"}
    tx = make_tx({"tx_type": "ACT", "trans_type_id": 1, **same}, {"tx_type": "ACT", "trans_type_id": 2, **same},
                 {"tx_type": "CNR", "trans_type_id": 1, **same}, {"tx_type": "CNR", "trans_type_id": 2, **same})
    assert tuples(pq.tx_duplicates(tx)) == [("ACT", 2, 2, 0), ("CNR", 2, 1, 1)]


def test_row_counts_have_a_total(make_tx):
    tx = make_tx({"tx_type": "ACT"}, {"tx_type": "ACT"}, {"tx_type": "CNR"})
    assert tuples(pq.row_counts(tx)) == [("ACT", 2), ("CNR", 1), ("TOTAL", 3)]


def test_quality_counts_duplicates(make_tx):
    tx = make_tx({"tx_type": "RENO", "subscription_id": 1, "trans_date": "2025-01-01"},
                 {"tx_type": "ACT", "subscription_id": 2, "trans_date": "2025-01-01", "act_date": "2025-01-01"})
    subs = subscription_view(tx, "2025-02-01")
    assert tuples(pq.quality_checks(subs.unionByName(subs))) == [(4, 2, 2, 2, 2, 0, 2, 0)]
