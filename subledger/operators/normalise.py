"""Six fact tables -> one normalised transaction view."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.schemas import FACTS, TX_SCHEMA, Fact


# Columns the first/last picks read anyway; hashing others would only widen the scan.
_TIE_COLUMNS = ("cpc", "tmuserid", "msisdn", "act_date", "camp_name", "rev")


def default_tie(fact: Fact) -> Column:
    """Order of rows of one moment: by type code, then by a hash of what a pick can return.

    Rows that share it are alike in every picked column, so the pick does not depend on which one wins.
    """
    code = F.coalesce("trans_type_id", F.lit(0)) if "trans_type_id" in fact.columns else F.lit(0)
    picked = [c for c in (*_TIE_COLUMNS, fact.channel) if c in fact.columns]
    return F.shiftleft(code.cast("bigint"), 56) + F.shiftrightunsigned(F.xxhash64(*picked), 8)


def tag_fact(fact: Fact, rows: DataFrame, tie: Column | None = None) -> DataFrame:
    """One fact table under the normalised names; columns the type lacks are typed nulls."""
    have = set(rows.columns)
    source = {
        "tx_type": F.lit(fact.tag),
        "subscription_id": F.col(fact.subscription),
        "trans_date": F.col(fact.event_date),
        "channel": F.col(fact.channel) if fact.channel else F.lit(None),
        "tie": tie if tie is not None else default_tie(fact),
    }
    picked = []
    for field in TX_SCHEMA.fields:
        value = source.get(field.name)
        if value is None:
            value = F.col(field.name) if field.name in have else F.lit(None)
        picked.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*picked)


def normalise(tables: dict[str, DataFrame]) -> DataFrame:
    """Union of the given fact tables, keyed by type name."""
    parts = [tag_fact(FACTS[name], rows) for name, rows in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def of_types(tx: DataFrame, *types: str) -> DataFrame:
    return tx.where(F.col("tx_type").isin([t.upper() for t in types]))
