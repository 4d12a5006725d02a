"""Registry of the six fact tables and of the derived tables' schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
}


def _ddl(text: str) -> T.StructType:
    """``name type, name type`` as a schema; unlike the DDL parser it needs no running session."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Fact:
    """One transaction type: its schema and the roles its columns play."""

    name: str
    schema: T.StructType
    event_date: str
    key: tuple[str, ...]
    subscription: str
    channel: str | None
    file_prefix: str

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stored_columns(self) -> list[str]:
        return self.columns + ["year_month"]

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType(list(self.schema.fields) + [T.StructField("year_month", T.StringType())])

    @property
    def tag(self) -> str:
        return self.name.upper()


_ID = "tmuserid string, msisdn string, cpc bigint, trans_type_id bigint"
_DATES = "trans_date timestamp_ntz, act_date timestamp_ntz, reno_date timestamp_ntz"
_CAMPAIGN = "camp_name string, tef_prov bigint, campana_medium string, campana_id string, subscription_id bigint"
_TX_KEY = ("subscription_id", "trans_date", "trans_type_id")
_CHARGED = _ddl(f"{_ID}, channel_id bigint, channel_act string, {_DATES}, {_CAMPAIGN}, rev double")

FACTS: dict[str, Fact] = {
    "act": Fact("act", _CHARGED, "trans_date", _TX_KEY, "subscription_id", "channel_act", "act_atlas"),
    "reno": Fact("reno", _CHARGED, "trans_date", _TX_KEY, "subscription_id", "channel_act", "reno_atlas"),
    "dct": Fact(
        "dct", _ddl(f"{_ID}, channel_dct string, {_DATES}, {_CAMPAIGN}"),
        "trans_date", _TX_KEY, "subscription_id", "channel_dct", "dct_atlas",
    ),
    "cnr": Fact(
        "cnr", _ddl("cancel_date timestamp_ntz, sbn_id bigint, tmuserid string, cpc bigint, mode string"),
        "cancel_date", ("sbn_id", "cancel_date"), "sbn_id", "mode", "cnr_atlas",
    ),
    "ppd": Fact(
        "ppd", _ddl(f"{_ID}, channel_id bigint, {_DATES}, {_CAMPAIGN}, rev double"),
        "trans_date", _TX_KEY, "subscription_id", None, "ppd_atlas",
    ),
    "rfnd": Fact(
        "rfnd",
        _ddl("tmuserid string, cpc bigint, refnd_date timestamp_ntz, rfnd_amount double, rfnd_cnt bigint, "
             "sbnid bigint, instant_rfnd string"),
        "refnd_date", ("sbnid", "refnd_date"), "sbnid", None, "rfnd_atlas",
    ),
}

# The one normalised view over all six types that every plan reads.
TX_SCHEMA = _ddl(
    "tx_type string, subscription_id bigint, tmuserid string, msisdn string, cpc bigint, trans_type_id bigint, "
    "channel_id bigint, channel string, trans_date timestamp_ntz, act_date timestamp_ntz, reno_date timestamp_ntz, "
    "camp_name string, rev double, rfnd_amount double, rfnd_cnt bigint, instant_rfnd string, year_month string, "
    "tie bigint"
)

DIM_SCHEMA = _ddl("cpc bigint, service_name string, tme_category string, cpc_period bigint, cpc_price double")

COUNTERS_SCHEMA = _ddl(
    "date date, cpc bigint, act_count bigint, act_free bigint, act_pay bigint, upg_count bigint, reno_count bigint, "
    "dct_count bigint, upg_dct_count bigint, cnr_count bigint, ppd_count bigint, rfnd_count bigint, "
    "rfnd_amount double, rev double, last_updated timestamp_ntz"
)
