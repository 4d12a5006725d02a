from datetime import date, datetime

from pyspark.sql import functions as F

from subledger.sources import dims, extract
from tests.conftest import tuples


def test_load_dim(spark, tmp_path):
    path = tmp_path / "dim.csv"
    path.write_text('cpc,service_name,tme_category,cpc_period,cpc_price\n7,"A 0,99",Games,30,2.5\n8,,NULL,,\n7,second,,1,1\nx,bad,,1,1\n')
    assert tuples(dims.load_dim(spark, str(path))) == [(7, "A 0,99", "Games", 30, 2.5), (8, "UNKNOWN", "", 0, 0.0)]


def test_build_dim(spark):
    rows = [("T", "A", "5", "Monthly 9", "1.5", 1), ("T", "B", "5", "Weekly", "2", 2), ("T", "C", "6", "PPD", None, 3),
            ("T", "D", "n/a", "Weekly", "2", 4), ("T", "E", "7", None, "2", 5), ("T", "F", "8", "Bimontly x", "2", 6), ("T", "G", "9", "45 d", "2", 7)]
    names = "`TME Category` string, `Service Name` string, CPC string, `Subscription Model` string, Price string, place int"
    got = dims.build_dim(spark.createDataFrame(rows, names), order=F.col("place"))
    assert tuples(got) == [(5, "A", "T", 30, 1.5), (6, "C", "T", 99999, None), (7, "E", "T", 0, 2.0), (8, "F", "T", 60, 2.0), (9, "G", "T", 45, 2.0)]


def test_expand_code_sets(spark):
    names = "`Service Name` string, `TME Category` string, Upgrade_CPC bigint, CHG_Period bigint, CHG_Price double, CPCs string"
    rows = [("S", "Games", 100, 30, 2.0, "{100,101, 102}"), (None, "News", 200, 30, 3.0, "{200}"), ("U", "News", 999, 30, 2.0, None)]
    got = dims.expand_code_sets(spark.createDataFrame(rows, names))
    assert tuples(got.select("cpc", "service_name")) == [(100, "S"), (101, "S"), (102, "S"), (200, "UNKNOWN"), (999, "U")]


def test_exclusion_list_with_and_without_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("msisdn,tmuserid\n111,u1\n222,\n,u3\n111,u1\n")
    (tmp_path / "b.csv").write_text("111\n333\n\n")
    phones, users = dims.load_excluded(spark, str(tmp_path / "a.csv"))
    assert (tuples(phones), tuples(users)) == ([("111",), ("222",)], [("u1",), ("u3",)])
    phones, users = dims.load_excluded(spark, str(tmp_path / "b.csv"))
    assert (tuples(phones), tuples(users)) == ([("111",), ("333",)], [])


def test_code_list(spark, tmp_path):
    (tmp_path / "c.txt").write_text("5\n\n 6 \n5\n")
    assert tuples(dims.load_codes(spark, str(tmp_path / "c.txt"))) == [(5,), (6,)]


def _source(spark, *rows):
    full = [("u", info, kind, channel, datetime.fromisoformat(ts), None, None, 1, 2.5) for info, kind, channel, ts in rows]
    return spark.createDataFrame(full, "msisdn string, generic_act_info string, trans_type_id bigint, channel_id bigint, tlog_ts timestamp_ntz, "
                                 "request_ts timestamp_ntz, next_charging_date timestamp_ntz, subscription_id bigint, charged_amount double")


def test_extract_range_is_half_open_and_keeps_unknown_channels(spark):
    channels = spark.createDataFrame([(1, "WEB")], "channel_id bigint, channel_desc string")
    source = _source(spark, ("chrg_refid=346;cpc=7;", 1, 1, "2025-01-01"), ("cpc=8;", 1, 2, "2025-01-02 23:59:59.999"),
                     ("cpc=9;", 1, 1, "2025-01-03"), ("cpc=9;", 1, 1, "2024-12-31 23:59:59"), ("cpc=9;", 2, 1, "2025-01-01"))
    got = extract.extract_fact(source, channels, "act", "2025-01-01", "2025-01-02")
    assert tuples(got.select("cpc", "channel_act", "msisdn", "camp_name")) == [("7", "WEB", "346", ""), ("8", None, "", "")]
    assert "rev" not in extract.extract_fact(source, channels, "dct", "2025-01-01", "2025-01-02").columns


def test_extract_refunds_group(spark):
    rows = [("u", 1, datetime(2025, 1, 1, 5), 1.0, "sbnId=9,AUTOMATIC REFUND"), ("u", 1, datetime(2025, 1, 1, 9), 2.0, "sbnId=9,automatic refund"),
            ("u", 1, datetime(2025, 1, 1, 9), 4.0, "sbnId=9,manual"), ("u", 1, datetime(2025, 1, 2), 8.0, None)]
    source = spark.createDataFrame(rows, "msisdn string, cpc bigint, timestamp timestamp_ntz, amount double, info string")
    got = extract.extract_refunds(source, "2025-01-01", "2025-01-02")
    day = date(2025, 1, 1)
    assert tuples(got) == sorted([("u", 1, day, 3.0, 2, "9", "t"), ("u", 1, day, 4.0, 1, "9", "f"), ("u", 1, date(2025, 1, 2), 8.0, 0, None, None)], key=repr)
