"""Key-set work on users: exclusion, lookup by key, phone -> user mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger import fixed_values as fixed
from subledger.functions import earliest

def _without(rows: DataFrame, listed: DataFrame, column: str, applies: Column | None, keep_null_ids: bool) -> DataFrame:
    ids = listed.select(F.col(listed.columns[0]).cast("string").alias("_id")).where("_id <> ''").distinct()
    left = rows.join(ids, F.col(column) == F.col("_id"), "left_anti")
    if keep_null_ids:
        return left
    # A row without an id is dropped as soon as anything is listed; types that have no such column are not
    # subject to the rule. Whether anything is listed is one scalar, found at run time.
    no_id = F.col(column).isNull() if applies is None else F.col(column).isNull() & applies
    listed_any = ids.agg((F.count(F.lit(1)) > 0).alias("_any"))
    return left.where(~(no_id & listed_any.scalar()))


def exclude_users(
    tx: DataFrame,
    phones: DataFrame | None = None,
    users: DataFrame | None = None,
    keep_null_ids: bool = False,
) -> DataFrame:
    """Drop the transactions of listed phones, then of listed users.

    Cancellations and refunds carry no phone, so only the user list applies to them. An empty list
    excludes nothing. The lists are joined, and broadcast only when their size is under the session's
    threshold.
    """
    if phones is not None:
        has_phone = ~F.col("tx_type").isin("CNR", "RFND")
        tx = _without(tx, phones, "msisdn", has_phone, keep_null_ids)
    if users is not None:
        tx = _without(tx, users, "tmuserid", None, keep_null_ids)
    return tx


def semi_keys(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose column is among the keys, by a semi-join: no key set is fetched while the plan is built.

    Spark broadcasts the keys when they are under its threshold at run time, and filters the scan by them where its
    runtime filters apply.
    """
    keys = keys.select(F.col(keys.columns[0]).alias("_key")).where("_key is not null").distinct()
    return rows.join(keys, F.col(column) == F.col("_key"), "left_semi")


def map_phones(
    phones: DataFrame, tx: DataFrame, order: Sequence[str] = fixed.PHONE_LOOKUP_ORDER
) -> DataFrame:
    """Each listed phone with the first user seen for it, by type priority and then by time.

    A phone never seen, or seen only without a user, maps to an empty text. The transactions are reduced
    to those of listed phones, then to one row per phone with a partial minimum per task, so a phone shared by many
    rows is no hot partition.
    """
    wanted = phones.select(F.col(phones.columns[0]).cast("string").alias("msisdn")).where("msisdn <> ''").distinct()
    seen = tx.where(F.col("tx_type").isin(list(order)) & F.col("msisdn").isNotNull() & (F.col("tmuserid") != ""))
    seen = semi_keys(seen, "msisdn", wanted)
    priority = F.array_position(F.lit(list(order)), F.col("tx_type"))
    rank = F.struct(priority, earliest(F.col("trans_date"), F.col("tie")), F.col("tmuserid"))
    found = seen.groupBy("msisdn").agg(F.min(rank)["tmuserid"].alias("tmuserid"))
    return wanted.join(found, "msisdn", "left").select(
        "msisdn", F.coalesce("tmuserid", F.lit("")).alias("tmuserid")
    )


def mapping_coverage(mapped: DataFrame) -> DataFrame:
    """Listed, mapped and unmapped phones."""
    hit = F.col("tmuserid") != ""
    return mapped.agg(
        F.count(F.lit(1)).alias("listed"),
        F.count(F.when(hit, 1)).alias("mapped"),
        F.count(F.when(~hit, 1)).alias("unmapped"),
    )
