import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from subledger.operators.merge import append_rows
from subledger.plans import quality
from subledger.schemas import FACTS
from subledger.sources import csv, tables
from tests.conftest import tuples

CNR = FACTS["cnr"]
HEADER = "cancel_date,sbn_id,tmuserid,cpc,mode\n"


def put(folder, name, *lines, header=HEADER):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(header + "".join(line + "\n" for line in lines))
    return path


def test_lenient_scan_keeps_rows_and_nulls_bad_cells(spark, tmp_path):
    path = put(tmp_path, "cnr_atlas.csv", "2025-01-01,1,u1,abc,M", "2025-01-01 10:00:00,NULL,null,7,", "x,3,u3,8,\"a, \"\"b\"\"\"")
    rows = csv.read_lenient(spark, CNR, path).select(*CNR.stored_columns)
    assert tuples(rows) == sorted([
        (datetime(2025, 1, 1), 1, "u1", None, "M", "2025-01"),
        (datetime(2025, 1, 1, 10), None, None, 7, None, "2025-01"),
        (None, 3, "u3", 8, 'a, "b"', None),
    ], key=repr)
    assert csv.null_dates(rows, CNR).first()[0] == 1


def test_columns_go_by_position(spark, tmp_path):
    path = put(tmp_path, "cnr_atlas.csv", "2025-01-01,1,u1,7,M", header="a,b,c,d,e\n")
    csv.check_arity(spark, CNR, path)
    assert csv.read_lenient(spark, CNR, path).first().sbn_id == 1
    short = put(tmp_path, "short.csv", "2025-01-01,1", header="a,b\n")
    with pytest.raises(ValueError):
        csv.check_arity(spark, CNR, short)


def test_strict_load_leaves_out_whole_files(spark, tmp_path):
    good = put(tmp_path, "cnr_atlas 1.csv", "2025-01-01,1,u1,7,M", "bad date,2,u2,7,M")
    bad = put(tmp_path, "cnr_atlas 2.csv", "2025-01-01,3,u3,7,M", "2025-01-01,4,u4,abc,M")
    ragged = put(tmp_path, "cnr_atlas 3.csv", "2025-01-01,5,u5,7,M,extra")
    rows = csv.read_strict(spark, CNR, [good, bad, ragged])
    assert sorted(r.sbn_id for r in rows.collect()) == [1, 2]
    assert csv.rejected_files(spark, CNR, [good, bad, ragged]).count() == 2
    assert csv.read_strict(spark, CNR, [bad]).count() == 0


def test_daily_file_resolution(spark, tmp_path):
    folder = str(tmp_path)
    assert csv.daily_file(spark, folder, CNR, "2025-01-02") is None
    put(tmp_path, "cnr_atlas_x.csv")
    assert csv.daily_file(spark, folder, CNR, "2025-01-02").endswith("cnr_atlas_x.csv")
    put(tmp_path, "cnr_atlas_y.csv")
    with pytest.raises(csv.AmbiguousFiles):
        csv.daily_file(spark, folder, CNR, "2025-01-02")
    put(tmp_path, "cnr_atlas_20250102.csv")
    assert csv.daily_file(spark, folder, CNR, "2025-01-02").endswith("_20250102.csv")
    put(tmp_path, "cnr_atlas_day.csv")
    assert csv.daily_file(spark, folder, CNR, "2025-01-02").endswith("_day.csv")


def test_historical_load_keeps_the_last_of_the_last_file(spark, tmp_path):
    put(tmp_path, "cnr_atlas_1.csv", "2025-01-01,1,u1,10,M", "2025-01-01,1,u1,11,M", "2025-01-02,2,u2,20,M")
    put(tmp_path, "cnr_atlas_2.csv", "2025-01-02,2,u2,21,M")
    rows = csv.load_historical(spark, CNR, csv.list_files(spark, str(tmp_path), CNR))
    assert tuples(rows.select("sbn_id", "cpc")) == [(1, 11), (2, 21)]


def test_file_order_survives_splits(spark, tmp_path):
    """The last of many rows of one key wins although the file is read in several parts."""
    path = put(tmp_path, "cnr_atlas_1.csv", *[f"2025-01-01,{i % 3},u,{i},M" for i in range(30000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        raw = csv.read_lenient(spark, CNR, path)
        assert raw.rdd.getNumPartitions() > 3
        rows = csv.load_historical(spark, CNR, path)
        assert tuples(rows.select("sbn_id", "cpc")) == [(0, 29997), (1, 29998), (2, 29999)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")


def _cnr(spark, *rows):
    data = [(datetime.fromisoformat(d) if d else None, s, u, c, "M", d[:7] if d else None) for d, s, u, c in rows]
    return spark.createDataFrame(data, CNR.stored_schema)


def test_append_replaces_and_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "t")
    first = _cnr(spark, ("2025-01-01", 1, "a", 10), ("2025-01-31", 2, "a", 10), ("2025-02-01", 3, "a", 10), (None, 4, "a", 10))
    tables.append_batch(spark, root, CNR, first)
    batch = _cnr(spark, ("2025-01-31", 2, "b", 99), ("2025-01-31", 5, "b", 99), (None, 4, "b", 99))
    want = [(1, "a", 10), (2, "b", 99), (3, "a", 10), (4, "b", 99), (5, "b", 99)]
    files = "_metadata.file_path"

    def others():
        rows = tables.read_current(spark, f"{root}/cnr").where("day in ('2025-01-01', '2025-02-01')")
        return tuples(rows.select(files).distinct())

    before = others()
    for _ in range(2):
        tables.append_batch(spark, root, CNR, batch)
        assert tuples(tables.read_fact(spark, root, CNR).select("sbn_id", "tmuserid", "cpc")) == want
    # Untouched days were not rewritten, even of a touched month; nothing is left of the writes.
    assert others() == before and len(before) == 2
    assert os.listdir(root) == ["cnr"] and os.listdir(f"{root}/cnr") == ["version-0000000001"]


def test_a_table_by_month_is_appended_to(spark, tmp_path):
    root = str(tmp_path / "t")
    first = _cnr(spark, ("2025-01-01", 1, "a", 10), ("2025-01-31", 2, "a", 10), ("2025-02-01", 3, "a", 10), (None, 4, "a", 10))
    tables.save_fact(first, root, CNR, partitions=("year_month",))
    for before in (2, 3):
        done = tables.append_batch(spark, root, CNR, _cnr(spark, ("2025-01-31", 2, "b", 99), ("2025-01-31", 5, "b", 99), (None, 4, "b", 99)))
        assert (done.rows_before, done.rows_stored, done.duplicates) == (before, 3, before)
        assert tuples(tables.read_fact(spark, root, CNR).select("sbn_id", "tmuserid", "cpc")) == [
            (1, "a", 10), (2, "b", 99), (3, "a", 10), (4, "b", 99), (5, "b", 99)]
    tables.append_batch(spark, root, CNR, _cnr(spark, ("2025-02-02", 7, "c", 1)))
    assert tables.read_fact(spark, root, CNR).count() == 6
    assert tuples(tables.stored_days(spark, root, CNR).select(F.col("date").cast("string"), "row_count")) == [
        ("2025-01-01", 1), ("2025-01-31", 2), ("2025-02-01", 1), ("2025-02-02", 1), (None, 1)]
    assert tables.read_range(spark, root, CNR, "2025-01-31", "2025-02-01").count() == 3


def test_append_parses_its_batch_once_and_reads_touched_days_only(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    tables.append_batch(spark, root, CNR, _cnr(spark, *[(f"2025-01-{d:02d}", d, "a", 1) for d in range(1, 29)]))
    source = put(tmp_path, "cnr_atlas_1.csv", "2025-01-05,5,b,2,M", "2025-01-06,77,b,2,M")
    plans, real = [], tables.write_partitioned

    def seen(rows, *args, **named):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return real(rows, *args, **named)

    monkeypatch.setattr(tables, "write_partitioned", seen)
    scans = spark.sparkContext.accumulator(0)
    rows = csv.read_lenient(spark, CNR, source)
    counted = rows.mapInArrow(lambda batches: ((scans.add(b.num_rows), b)[1] for b in batches), rows.schema)
    assert tables.append_batch(spark, root, CNR, counted).rows_before == 2
    assert scans.value == 2  # each row of the file was parsed once
    assert "FileScan csv" not in plans[0] and plans[0].count("FileScan parquet") == 2
    assert "day#" in plans[0].split("PartitionFilters: [")[1].split("]")[0] or "day#" in plans[0].split("PartitionFilters: [")[2].split("]")[0]
    assert tables.read_fact(spark, root, CNR).count() == 29


def test_append_shuffles_only_touched_days(spark):
    """Stored rows of other days reach the output without a dedupe: even two that share a key stay."""
    stored = _cnr(spark, ("2025-01-01", 1, "a", 1), ("2025-01-01", 1, "b", 2), ("2025-01-02", 1, "c", 3))
    got = append_rows(stored, _cnr(spark, ("2025-01-02", 1, "d", 4)), CNR)
    assert tuples(got.select("tmuserid", "cpc")) == [("a", 1), ("b", 2), ("d", 4)]


def test_refund_key_ignores_code_and_flag(spark):
    fact = FACTS["rfnd"]
    rows = spark.createDataFrame(
        [("u", 1, datetime(2025, 1, 1), 1.0, 1, 9, "t", "2025-01"), ("u", 2, datetime(2025, 1, 1), 2.0, 1, 9, "f", "2025-01")],
        fact.stored_schema).coalesce(1).withColumn("_row", F.monotonically_increasing_id())
    empty = spark.createDataFrame([], fact.stored_schema)
    assert tuples(append_rows(empty, rows, fact).select("cpc")) == [(2,)]


def test_partitioned_write_and_pruned_read(spark, tmp_path):
    root = str(tmp_path)
    tables.save_fact(_cnr(spark, ("2025-01-01", 1, "a", 1), ("2025-02-01", 2, "a", 1), ("2025-02-28", 3, "a", 1)), root, CNR)
    assert tables.read_fact(spark, root, CNR, ["2025-02"]).count() == 2
    one_day = tables.read_range(spark, root, CNR, "2025-02-28", "2025-02-28")
    assert [r.sbn_id for r in one_day.collect()] == [3]
    plan = one_day._jdf.queryExecution().toString()
    assert "year_month" in plan.split("PartitionFilters: [")[1] and "day" in plan.split("PartitionFilters: [")[1]
    assert "PushedFilters: [IsNotNull(cancel_date)" in plan
    assert dict(one_day.dtypes)["year_month"] == "string"
    assert tuples(tables.partition_inventory(tables.read_fact(spark, root, CNR))) == [(2, "2025-01", "2025-02")]


def test_owned_partitions_without_rows_disappear(spark, tmp_path):
    path = f"{tmp_path}/cnr"
    tables.write_partitioned(_cnr(spark, ("2025-01-01", 1, "a", 1), ("2025-02-01", 2, "a", 1)), path)
    tables.write_partitioned(_cnr(spark, ("2025-01-01", 7, "a", 1)), path, owned=["2025-01", "2025-02"])
    assert tuples(tables.read_current(spark, path).select("sbn_id")) == [(7,)]


@pytest.mark.parametrize("step", ["verify_count", "_rename", "recover", "tidy", "remove"])
def test_a_write_cut_off_at_any_step_loses_nothing(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "t")
    for day in ("2025-01-01", "2025-01-02", "2025-02-01"):
        tables.append_batch(spark, root, CNR, _cnr(spark, (day, 1, "a", 10), ("2025-03-01", 9, "a", 10)))
    before = tuples(tables.read_fact(spark, root, CNR).select("cancel_date", "sbn_id", "tmuserid"))
    batch = _cnr(spark, ("2025-01-02", 1, "b", 11), ("2025-02-05", 2, "b", 11))
    real = getattr(tables, step)

    def cut(*args):
        raise KeyboardInterrupt(step)

    monkeypatch.setattr(tables, step, cut)
    try:
        tables.append_batch(spark, root, CNR, batch)
    except KeyboardInterrupt:
        pass
    monkeypatch.setattr(tables, step, real)
    after = tuples(tables.read_fact(spark, root, CNR).select("cancel_date", "sbn_id", "tmuserid"))
    done = sorted([r for r in before if str(r[0])[:10] != "2025-01-02"] + [
        (datetime(2025, 1, 2), 1, "b"), (datetime(2025, 2, 5), 2, "b")], key=repr)
    assert after in (before, done)
    loaded = tables.append_batch(spark, root, CNR, batch)
    assert loaded.rows_before > 0
    assert tuples(tables.read_fact(spark, root, CNR).select("cancel_date", "sbn_id", "tmuserid")) == done


def test_an_unfinished_first_write_is_no_table(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/cnr"
    monkeypatch.setattr(tables, "_rename", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        tables.write_partitioned(_cnr(spark, ("2025-01-01", 1, "a", 1)), path)
    assert tables.read_current(spark, path) is None
    monkeypatch.undo()
    tables.write_partitioned(_cnr(spark, ("2025-01-01", 2, "a", 1)), path)
    assert tuples(tables.read_current(spark, path).select("sbn_id")) == [(2,)]


def test_a_published_append_is_read_before_and_after_it_is_brought_in(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    tables.append_batch(spark, root, CNR, _cnr(spark, ("2025-01-01", 1, "a", 1), ("2025-01-02", 2, "a", 1), (None, 3, "a", 1)))
    real, calls = tables.recover, []

    def cut(*args):
        calls.append(args)
        if len(calls) == 3:  # after the publishing rename
            raise KeyboardInterrupt
        real(*args)

    monkeypatch.setattr(tables, "recover", cut)
    with pytest.raises(KeyboardInterrupt):
        tables.append_batch(spark, root, CNR, _cnr(spark, ("2025-01-02", 2, "b", 9), (None, 4, "b", 9)))
    monkeypatch.undo()
    want = [(1, "a", 1), (2, "b", 9), (3, "a", 1), (4, "b", 9)]
    columns = ("sbn_id", "tmuserid", "cpc")
    assert os.path.isdir(f"{root}/cnr/pending")
    assert tuples(tables.read_fact(spark, root, CNR).select(*columns)) == want
    assert tuples(tables.stored_days(spark, root, CNR).select(F.col("date").cast("string"), "row_count")) == [
        ("2025-01-01", 1), ("2025-01-02", 1), (None, 2)]
    # A session without a metastore finds the table by its folder.
    spark.sql(f"DROP TABLE {tables.table_name(f'{root}/cnr')}")
    assert tuples(tables.read_fact(spark, root, CNR).select(*columns)) == want
    tables.recover(spark, f"{root}/cnr")
    assert tuples(tables.read_fact(spark, root, CNR).select(*columns)) == want
    assert os.listdir(f"{root}/cnr") == ["version-0000000001"]


def test_a_full_load_moves_the_table_and_keeps_one_version_for_readers(spark, tmp_path):
    root = str(tmp_path / "t")
    for k in range(4):
        readers = tables.read_current(spark, f"{root}/cnr") if k else None
        tables.save_fact(_cnr(spark, ("2025-01-01", k, "a", 1)), root, CNR)
        assert tuples(tables.read_fact(spark, root, CNR).select("sbn_id")) == [(k,)]
        if readers is not None:
            assert tuples(readers.select("sbn_id")) == [(k - 1,)]
    assert tables.location(spark, f"{root}/cnr").endswith("version-0000000004")
    assert [v[-1] for v in tables.versions(spark, f"{root}/cnr")] == ["3", "4"]


def test_counts_come_from_footers(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.save_fact(_cnr(spark, ("2025-01-01", 1, "a", 1), ("2025-01-01", 2, "a", 1), ("2025-03-01", 3, "a", 1), (None, 4, "a", 1)), root, CNR)
    counts = quality.stored_row_counts(spark, root)
    assert "PushedAggregation: [COUNT(*)]" in counts._jdf.queryExecution().executedPlan().toString()
    assert tuples(counts) == [("CNR", 4), ("TOTAL", 4)]
    assert tuples(quality.stored_date_ranges(spark, root)) == [("CNR", datetime(2025, 1, 1), datetime(2025, 3, 1))]
    assert tuples(quality.stored_inventory(spark, root)) == [("CNR", 2, "2025-01", "2025-03")]


def test_row_count_is_verified(spark):
    with pytest.raises(tables.RowCountMismatch):
        tables.verify_count(spark.range(3), 4)


def test_missing_table_is_empty_with_schema(spark, tmp_path):
    rows = tables.load_counters(spark, f"{tmp_path}/none")
    assert rows.isEmpty() and {"date", "cpc", "act_count"} <= set(rows.columns)
    assert tables.read_fact(spark, str(tmp_path), CNR).columns == CNR.stored_columns


def test_schema_diff(spark):
    rows = spark.createDataFrame([(1, 2)], "a int, b int")
    assert tables.schema_diff(rows, ["a", "c"]) == {"missing": ["c"], "extra": ["b"]}
    assert tables.schema_diff(rows, ["a", "b"]) == {"missing": [], "extra": []}


def test_csv_round_trip_quotes_commas_and_flattens_lists(spark, tmp_path):
    path = f"{tmp_path}/out"
    rows = spark.createDataFrame([("A 0,99", [1, 2]), ('say "x"', [3])], "service_name string, codes array<bigint>")
    tables.write_csv(rows, path, sort_by=["service_name"])
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert tuples(back) == [("A 0,99", "1,2"), ('say "x"', "3")]


def test_loads_may_run_side_by_side(spark, tmp_path):
    paths = [f"{tmp_path}/it's t{k}" for k in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda p: tables.write_partitioned(_cnr(spark, ("2025-01-01", 1, "a", 1), ("2025-02-01", 2, "a", 1)), p), paths))
    assert [tables.read_current(spark, p).count() for p in paths] == [2] * 6
