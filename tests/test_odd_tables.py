"""Queries against their SQL counterparts over small tables that hold what the driver's small ones lack."""

from datetime import datetime, timedelta

import duckdb
import pytest

from subledger.sources import extract
from workload.catalog import ORACLES, QUERIES
from workload.fixtures import Data

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@pytest.fixture
def agrees(spark, tmp_path):
    """Compares a query with its SQL over the given events; returns the rows."""
    def check(name, *events):
        spark.createDataFrame(list(events), EVENTS).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
        duck = duckdb.connect()
        duck.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        rows = QUERIES[name](Data(spark, str(tmp_path)))
        result = duck.execute(ORACLES[name])
        columns = [d[0] for d in result.description]
        got = sorted(map(tuple, rows.select(*columns).collect()), key=repr)
        assert got == sorted(result.fetchall(), key=repr)
        return [dict(zip(columns, row)) for row in got]

    return check


def _event(event_id, kind, code, second=0, user=8, value=1.5):
    return event_id, datetime(2024, 1, 2) + timedelta(seconds=second), user, kind, value, f'{{"k": {code}}}'


# Every 83rd event has no code, so the one subscription of user 8 has a list of one null code.
UNCODED = [_event(83, "signup", 5), _event(84, "signup", 6, user=9), _event(88, "purchase", 7, 1, user=9)]


@pytest.mark.parametrize("name, column", [
    ("cpc_list", "cpc_list"), ("list_to_csv", "cpc_text"), ("subscription_view", "cpc_list"),
    ("subscription_view_channel_upgrades", "cpc_list"), ("user_subscriptions", "cpc_list"),
])
def test_list_of_null_codes_is_an_empty_text(agrees, name, column):
    assert "" in [row[column] for row in agrees(name, *UNCODED)]


def test_strict_scan_keeps_the_last_row_of_a_subscription_and_second(agrees):
    # Events 4, 8 and 16 share subscription and second and stand in the table in another order; event 9 condemns its file.
    got = agrees("scan_csv_strict", _event(16, "signup", 3, 5.9, value=4.25), _event(4, "signup", 1, 5.1), _event(8, "signup", 2, 5.2),
                 _event(20, "signup", 1, 6), _event(9, "signup", 1), _event(5, "signup", 1))
    assert [(row["cpc"], row["loaded"], row["rev"]) for row in got] == [(1, 1, 1.5), (3, 1, 4.25)]


# The first and the last days of the month, and beyond it.
SPREAD = [0, 3 * 86400, 20 * 86400, 28 * 86400, 60 * 86400]


def test_cancellations_are_extracted_whole(spark, agrees):
    assert len(agrees("extract_cnr", *[_event(2 * k, "click", k, second) for k, second in enumerate(SPREAD)])) == len(SPREAD)
    source = spark.createDataFrame([(datetime(2024, 1, day), "7", "u", 1, "m") for day in (1, 2, 3, 4)],
                                   "timestamp timestamp_ntz, sbn_id string, msisdn string, cpc bigint, mode string")
    assert [row.cancel_date.day for row in extract.extract_cancellations(source, "2024-01-02", "2024-01-03").collect()] == [2, 3]


def test_refunds_are_extracted_whole(agrees):
    assert len(agrees("extract_refunds", *[_event(k, "error", k, second) for k, second in enumerate(SPREAD)])) == len(SPREAD)
