import os
from datetime import date

import pytest

from subledger import __main__ as cli
from subledger.operators.normalise import of_types
from subledger.operators.users import exclude_users, map_phones
from subledger.plans import jobs
from subledger.plans.counters import daily_counters
from subledger.plans.lookup import user_timeline
from subledger.plans.userbase import reconcile_user_base
from subledger.schemas import DIM_SCHEMA, FACTS
from subledger.sources import dims, tables
from subledger.sources.snapshots import read_rollup
from subledger.streaming.landing import follow_landing
from tests.conftest import tuples

ACT_HEADER = ",".join(FACTS["act"].columns)


def act(day, sub, cpc, rev="1.0", channel="WEB", user="u1", phone="m1"):
    return f"{user},{phone},{cpc},1,1,{channel},{day},{day},,camp,1,,,{sub},{rev}"


def put(folder, name, header, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join([header, *lines]) + "\n")


@pytest.fixture
def folders(tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    put(source, "act_atlas_2024.csv", ACT_HEADER, act("2024-12-30", 1, 10), act("2025-01-02", 2, 10), act("2025-01-02", 2, 11))
    put(source, "cnr_atlas_2024.csv", "cancel_date,sbn_id,tmuserid,cpc,mode", "2025-01-03 10:00:00,1,u1,10,APP")
    return source, root


def test_pipeline(spark, folders, tmp_path):
    source, root = folders
    done = jobs.load_historical(spark, source, root)
    assert (done["act"].rows_stored, done["act"].duplicates, done["cnr"].rows_stored) == (2, 1, 1)
    daily = str(tmp_path / "daily")
    put(daily, "act_atlas_day.csv", ACT_HEADER, act("2025-01-05", 3, 10, "0"), act("2025-01-02", 2, 12))
    for duplicates in (1, 2):
        done = jobs.append_daily(spark, daily, root, "2025-01-05")
        assert set(done) == {"act"} and done["act"].duplicates == duplicates
        assert done["act"].null_dates == {"trans_date": 0, "act_date": 0, "reno_date": 2}
        assert tuples(jobs.tx_of(spark, root).select("subscription_id", "cpc", "tx_type")) == [
            (1, 10, "ACT"), (1, 10, "CNR"), (2, 12, "ACT"), (3, 10, "ACT")]

    assert jobs.build_view(spark, root, "2025-02-01") == 3
    assert tuples(jobs.load_view(spark, root).select("subscription_id", "subscription_status", "activation_month")) == [
        (1, "Cancelled", "2024-12"), (2, "Active", "2025-01"), (3, "Active", "2025-01")]

    # A range, then everything missing, then a forced day whose rows have changed.
    assert jobs.build_counters(spark, root, "2025-01-01", "2025-01-03") == 3
    assert jobs.build_counters(spark, root) == 2
    assert jobs.build_counters(spark, root) == 0
    counters = tables.load_counters(spark, jobs.counters_path(root))
    assert tuples(counters.select("date", "cpc", "act_count", "act_free", "cnr_count")) == [
        (date(2024, 12, 30), 10, 1, 0, 0), (date(2025, 1, 2), 12, 1, 0, 0), (date(2025, 1, 3), 10, 0, 0, 1), (date(2025, 1, 5), 10, 1, 1, 0)]
    phones = spark.createDataFrame([("m1",)], "p string")
    assert jobs.build_counters(spark, root, "2025-01-05", force=True, phones=phones) == 1
    assert tables.load_counters(spark, jobs.counters_path(root)).count() == 3
    # A day whose rows are all excluded has no counters, so it stays among the days to process.
    assert tuples(jobs.dates_to_process(spark, root)) == [(date(2025, 1, 5),)]
    # A forced month that has no rows left disappears with its folder.
    assert jobs.build_counters(spark, root, "2024-12-30", force=True, phones=phones) == 1
    assert not os.path.exists(f"{tables.location(spark, jobs.counters_path(root)).removeprefix('file:')}/year_month=2024-12")


def test_backfill(spark, folders, tmp_path):
    source, root = folders
    jobs.load_historical(spark, source, root, ["act"])
    late = str(tmp_path / "late")
    put(late, "act_atlas_x.csv", ACT_HEADER, act("2024-12-31", 7, 1), act("2025-01-02", 8, 1), act("2025-01-04", 9, 1))
    want = [("act", date(2024, 12, 31), date(2025, 1, 1), 2), ("act", date(2025, 1, 3), date(2025, 1, 4), 2)]
    assert tuples(jobs.backfill(spark, late, root, dry_run=True)) == want
    assert jobs.tx_of(spark, root).count() == 2
    assert tuples(jobs.backfill(spark, late, root)) == want
    # The day that was already present takes nothing from the source.
    assert sorted(r.subscription_id for r in jobs.tx_of(spark, root).collect()) == [1, 2, 7, 9]


def test_user_base_files(spark, tmp_path):
    source = str(tmp_path / "base")
    put(source, "20250102_base.csv", "service_name,tme_category,cpc,count", "Chess,Education,2,3", "Chess,images,1,4.0", "Nubico,News,9,9")
    root = str(tmp_path / "out")
    out = jobs.build_user_base(spark, source, root)
    back = spark.read.option("header", True).option("sep", "|").csv(out["service"])
    assert back.columns == ["date", "service_name", "tme_category", "User_Base"]
    assert tuples(back) == [("2025-01-02", "Chess", "Edu_Ima", "7")]
    dim = dims.complete_dim(spark.createDataFrame([(1, "Chess", "", 0, 0.0)], DIM_SCHEMA))
    differences = reconcile_user_base(read_rollup(spark, out["service"]), read_rollup(spark, out["cpc"]), dim)
    assert tuples(differences) == [("Chess", date(2025, 1, 2), 7, 4, 3)]
    assert tuples(spark.read.option("header", True).option("sep", "|").csv(out["cpc"])) == [("2025-01-02", "1", "4"), ("2025-01-02", "2", "3")]


def test_only_new_snapshots_are_read(spark, tmp_path):
    source, root = str(tmp_path / "base"), str(tmp_path / "out")
    header = "service_name,tme_category,cpc,count"
    put(source, "20250102_base.csv", header, "Chess,Education,2,3")
    put(source, "undated.csv", header, "Chess,Education,2,8")
    assert [f.rpartition("/")[2] for f in jobs.update_user_base(spark, source, root)] == ["20250102_base.csv", "undated.csv"]
    put(source, "20250103_base.csv", header, "Chess,Education,2,5", "Chess,Education,x,5")
    put(source, "20250102_base.csv", header, "Chess,Education,2,1000")  # known by its date: not read again
    assert [f.rpartition("/")[2] for f in jobs.update_user_base(spark, source, root)] == ["20250103_base.csv"]
    assert jobs.update_user_base(spark, source, root) == []
    want = [(None, 2, 8), (date(2025, 1, 2), 2, 3), (date(2025, 1, 3), 2, 5)]
    assert tuples(jobs.load_user_base(spark, root, "cpc")) == want
    assert len(jobs.update_user_base(spark, source, root, force=True)) == 3
    assert tuples(jobs.load_user_base(spark, root, "cpc"))[1] == (date(2025, 1, 2), 2, 1000)


def test_refreshed_view_equals_a_rebuild(spark, folders, tmp_path):
    source, root = folders
    jobs.load_historical(spark, source, root)
    jobs.build_view(spark, root, "2025-01-04")
    before = {r.subscription_id: r for r in jobs.load_view(spark, root).collect()}
    daily = str(tmp_path / "daily")
    put(daily, "act_atlas_day.csv", ACT_HEADER, act("2025-01-05", 3, 10, "0"), act("2025-01-02", 2, 12), act("x", 5, 12), act("2025-01-06", "NULL", 12))
    put(daily, "cnr_atlas_day.csv", "cancel_date,sbn_id,tmuserid,cpc,mode", "2025-01-07,2,u1,10,APP", "2025-01-07,99,u1,10,APP")
    put(daily, "ppd_atlas_day.csv", ",".join(FACTS["ppd"].columns), "u1,m1,10,4,1,2025-01-08,,,c,1,,,1,3.0")
    days = {day for loaded in jobs.append_daily(spark, daily, root, "2025-01-07").values() for day in loaded.days}
    assert days == {"2025-01-02", "2025-01-05", "2025-01-06", "2025-01-07", "2025-01-08", None}
    # Subscriptions 2, 3 and 5 and the rows without an id; 99 was never activated, and a purchase touches none.
    assert jobs.refresh_view(spark, root, "2025-02-01", sorted(days, key=str)) == 4
    refreshed = tuples(jobs.load_view(spark, root))
    assert jobs.build_view(spark, root, "2025-02-01") == len(refreshed)
    assert refreshed == tuples(jobs.load_view(spark, root))
    assert before.keys() == {1, 2} and {r[0] for r in refreshed} == {1, 2, 3, 5, None}


def test_a_user_lookup_skips_row_groups_without_the_user(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for d in range(1, 9):
        lines = [act(f"2025-01-{d:02d}", 1000 * d + k, 10, user=f"u{1000 * d + 7 * k}", phone=f"m{k}") for k in range(300)]
        lines += [act(f"2025-01-{d:02d}", 1000 * d + 900, 10, user="u0"), act(f"2025-01-{d:02d}", 1000 * d + 901, 10, user="u99999")]
        put(source, f"act_atlas_{d}.csv", ACT_HEADER, *lines)
    jobs.load_historical(spark, source, root, ["act"])
    mine = tables.read_fact(spark, jobs.transactions(root), FACTS["act"]).where("tmuserid = 'u3070'")
    assert [r.subscription_id for r in mine.collect()] == [3010]
    scan = mine._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    # Every day's file has users below and above, so only filters by value leave its rows unread.
    assert scan.metrics().apply("numOutputRows").value() == 302


def test_landing_stream_appends_new_files_once(spark, tmp_path):
    landing, root, mark = (str(tmp_path / n) for n in ("land", "root", "mark"))
    fact = FACTS["act"]

    def run():
        query = follow_landing(spark, landing, root, fact, mark)
        query.awaitTermination(120)
        return tuples(tables.read_fact(spark, root, fact).select("subscription_id", "cpc"))

    put(landing, "act_atlas_1.csv", ACT_HEADER, act("2025-01-01", 1, 10), act("2025-01-01", 1, 11))
    put(landing, "cnr_atlas_1.csv", "cancel_date,sbn_id,tmuserid,cpc,mode", "2025-01-03,1,u1,10,APP")
    assert run() == [(1, 11)]
    put(landing, "act_atlas_2.csv", ACT_HEADER, act("2025-01-01", 1, 12), act("2025-01-09", 2, 10))
    assert run() == [(1, 12), (2, 10)]
    assert run() == [(1, 12), (2, 10)]


def test_command_line(spark, folders, tmp_path, capsys):
    source, root = folders
    dim = tmp_path / "dim.csv"
    dim.write_text("cpc,service_name,tme_category,cpc_period,cpc_price\n10,Chess,Games,30,2.5\n")
    codes = tmp_path / "codes.txt"
    codes.write_text("10\n")
    for line in (
        f"load-historical --source {source}", "build-view --as-of 2025-02-01", f"build-counters --backfill --dim {dim}",
        f"refunds --dim {dim}", f"revenue --dim {dim} --services Chess --months 2025-01", f"lifetime --dim {dim} chess 2024-12",
        f"category --codes {codes}", "user msisdn m1", "timeline msisdn m1", "check-transactions --as-of 2025-02-01",
        "check-view --as-of 2025-02-01", f"backfill --source {source} --dry-run",
    ):
        cli.main(["--root", root, *line.split()])
    shown = capsys.readouterr().out
    assert "act: 2 rows, 1 duplicates removed" in shown and "chess" in shown
    assert "totals by date" in shown and "unmapped codes" in shown and "act columns: {'missing': [], 'extra': []}" in shown
    cli.main(["--root", root, "--out", str(tmp_path / "csv"), "lifetime", "--dim", str(dim)])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().service == "chess"


def test_command_line_shows_every_row(spark, tmp_path, capsys):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    put(source, "act_atlas_1.csv", ACT_HEADER, *[act(f"2025-01-{1 + k % 28:02d}", k, 10) for k in range(60)])
    for line in (f"load-historical --source {source}", "timeline msisdn m1"):
        cli.main(["--root", root, *line.split()])
    lines = capsys.readouterr().out.split("\ntransactions\n")[1].split("\nsummary\n")[0].strip().split("\n")
    assert len(lines) == 1 + jobs.tx_of(spark, root).where("msisdn = 'm1'").count() > 50


def test_loads_without_a_usable_row(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    put(source, "act_atlas_1.csv", ACT_HEADER, act("2025-01-01", 1, "abc"))
    put(source, "cnr_atlas_1.csv", "cancel_date,sbn_id,tmuserid,cpc,mode")
    done = jobs.load_historical(spark, source, root)
    assert {name: (d.rows_read, d.rows_stored) for name, d in done.items()} == {"act": (0, 0), "cnr": (0, 0)}
    assert [os.path.basename(f) for f in done["act"].rejected] == ["act_atlas_1.csv"] and not done["cnr"].rejected
    assert jobs.append_daily(spark, source, root, "2025-01-05")["cnr"].rows_stored == 0
    assert jobs.tx_of(spark, root).count() == 1  # the lenient daily load keeps the row, without its code


def test_a_load_of_rejected_files_keeps_the_table(spark, tmp_path):
    source, bad, root = (str(tmp_path / n) for n in ("in", "bad", "out"))
    put(source, "act_atlas_1.csv", ACT_HEADER, act("2025-01-01", 1, 10), act("2025-01-02", 2, 10))
    jobs.load_historical(spark, source, root, ["act"])
    put(bad, "act_atlas_1.csv", ACT_HEADER, act("2025-01-01", 1, "abc"))
    assert jobs.load_historical(spark, bad, root, ["act"])["act"].rows_stored == 0
    assert jobs.tx_of(spark, root).count() == 2


def test_scans_read_only_what_is_needed(spark, folders):
    source, root = folders
    jobs.load_historical(spark, source, root)

    def scans(rows):
        return [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]

    tx = jobs.tx_of(spark, root, ["2025-01"])
    for line in scans(daily_counters(tx)):
        assert "campana_id" not in line and "tmuserid" not in line and "PartitionFilters: [isnotnull(year_month" in line
    # A day is asked for by partition and by time, so neither other days nor other row groups are read.
    for line in scans(daily_counters(jobs.tx_of(spark, root, days=["2025-01-02"]))):
        assert "day#" in line.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThanOrEqual(" in line
    # Asking for one type leaves one table to scan; building a plan runs no job.
    assert len(scans(of_types(tx, "CNR"))) == 1
    spark.sparkContext.setJobGroup("plans", "plans")
    phones = spark.createDataFrame([("m1",)], "p string")
    for rows in (user_timeline(tx, "msisdn", "m1"), map_phones(phones, tx), exclude_users(tx, phones, phones)):
        rows._jdf.queryExecution().optimizedPlan()
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plans")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_failed_check_leaves_the_old_table(spark, folders, monkeypatch):
    source, root = folders
    jobs.load_historical(spark, source, root)
    before = tuples(jobs.tx_of(spark, root))

    def fail(*_):
        raise tables.RowCountMismatch("short")

    monkeypatch.setattr(tables, "verify_count", fail)
    with pytest.raises(tables.RowCountMismatch):
        jobs.append_daily(spark, source, root, "2025-01-05", ["act"])
    with pytest.raises(tables.RowCountMismatch):
        jobs.load_historical(spark, source, root, ["act"])
    assert tuples(jobs.tx_of(spark, root)) == before
