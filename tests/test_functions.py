from datetime import date, datetime

from pyspark.sql import functions as F

from subledger import functions as fn
from tests.conftest import tuples


def _one(spark, expression, *values):
    names = [f"c{i}" for i in range(len(values))]
    rows = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return rows.select(expression(*[F.col(n) for n in names]).alias("x")).first()[0]


def test_event_time_formats(spark):
    rows = spark.createDataFrame([(t,) for t in ("2025-01-01", "2025-01-01 10:00:00", "x", "2025-01-01 10:00:00.123",
                                                 "2025-13-01", None)], "t string")
    got = [r[0] for r in rows.select(fn.parse_event_time(F.col("t"))).collect()]
    assert got == [datetime(2025, 1, 1), datetime(2025, 1, 1, 10), None, None, None, None]


def test_event_time_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist in that zone on this day.
        got = spark.createDataFrame([("2025-03-09 02:30:00",)], "t string").select(
            fn.parse_event_time(F.col("t")).alias("t"), fn.month_of(fn.parse_event_time(F.col("t"))).alias("m")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (got.t, got.m) == (datetime(2025, 3, 9, 2, 30), "2025-03")


def test_days_between_counts_boundaries(spark):
    rows = spark.createDataFrame([(datetime(2025, 1, 1, 23, 59), datetime(2025, 1, 2, 0, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert rows.select(fn.days_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_rounding_is_half_away_on_the_decimal_value(spark):
    rows = spark.createDataFrame([(1.005,), (-2.675,), (0.125,)], "v double")
    assert [r[0] for r in rows.select(fn.round_half_up(F.col("v"), 2)).collect()] == [1.01, -2.68, 0.13]


def test_tagged_value(spark):
    text = "chrg_refid=34600;cpc=7;campaign=;"
    assert _one(spark, lambda c: fn.tagged_value(c, "cpc"), text) == "7"
    assert _one(spark, lambda c: fn.tagged_value(c, "campaign"), text) == ""
    assert _one(spark, lambda c: fn.tagged_value(c, "absent"), text) == ""
    assert _one(spark, lambda c: fn.tagged_value(c, "sbnId", ","), "sbnId=12,rest") == "12"


def test_country_code(spark):
    assert _one(spark, fn.with_country_code, "600111222") == "34600111222"
    assert _one(spark, fn.with_country_code, "34600111222") == "34600111222"


def test_keywords_and_categories(spark):
    assert _one(spark, fn.keyword_hit, "My NUBICO club") is True
    assert _one(spark, fn.keyword_hit, "Games") is False
    assert _one(spark, fn.grouped_category, " Education ") == "Edu_Ima"
    assert _one(spark, fn.grouped_category, "SPORTS") == "News_Sport"
    assert _one(spark, fn.grouped_category, " Free Time ") == "Free Time"


def test_whole_number_truncates(spark):
    assert _one(spark, fn.whole_number, "12.9") == 12
    assert _one(spark, fn.whole_number, "-1.9") == -1
    assert _one(spark, fn.whole_number, "n/a") is None


def test_list_functions(spark):
    rows = spark.createDataFrame([([1, 2],), ([None, 3],), (None,), ([],)], "v array<bigint>")
    assert [r[0] for r in rows.select(fn.list_has_any(F.col("v"), [2, 9])).collect()] == [True, False, False, False]
    assert [r[0] for r in rows.select(fn.list_has_any(F.col("v"), [])).collect()] == [False] * 4
    assert rows.select(fn.list_text(F.col("v"))).first()[0] == "1,2"


def test_undated_rows_lose_in_both_directions(spark):
    rows = spark.createDataFrame([(None, 1, "A"), (date(2025, 1, 1), 2, "B")], "d date, tie bigint, v string")
    first = rows.agg(F.min(fn.earliest(F.col("d"), F.col("tie"), "v"))["v"]).first()[0]
    last = rows.agg(F.max(fn.latest(F.col("d"), F.col("tie"), "v"))["v"]).first()[0]
    assert (first, last) == ("B", "B")


def test_parse_day(spark):
    rows = spark.createDataFrame([("2025-01-05",), ("05/01/2025",), ("2025-02-30",)], "t string")
    assert tuples(rows.select(fn.parse_day(F.col("t")))) == sorted([(date(2025, 1, 5),), (None,), (None,)], key=repr)
