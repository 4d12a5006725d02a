"""Extraction of the six transaction types from the operational tables.

The tables may come from any source; ``read_jdbc`` reads them in parallel ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger import fixed_values as fixed
from subledger.functions import tagged_value
from subledger.schemas import FACTS


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: str, upper: str, parts: int, **options: str) -> DataFrame:
    """A database table split into ``parts`` ranges of a numeric, date or timestamp column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper,
                 numPartitions=str(parts), **options)
        .load()
    )


def in_days(moment: Column, start: str | None, end: str | None) -> Column:
    """From the start of the first day up to, not including, the day after the last; a side without a day is open."""
    fits = F.lit(True)
    if start is not None:
        fits = fits & (moment >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        fits = fits & (moment < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return fits


def extract_fact(source: DataFrame, channels: DataFrame, kind: str, start: str, end: str) -> DataFrame:
    """Activations, renewals, deactivations or purchases from the subscription fact.

    The phone, code and campaign fields are ``key=value;`` pairs of one text; an absent key gives an
    empty text. Channels without a description stay, with a null one.
    """
    info = F.col("generic_act_info")
    picked = source.where(in_days(F.col("tlog_ts"), start, end)).where(
        F.col("trans_type_id") == fixed.SOURCE_TYPE_CODES[kind]
    )
    rows = picked.join(channels.select("channel_id", "channel_desc"), "channel_id", "left")
    columns = {
        "tmuserid": F.col("msisdn"),
        "msisdn": tagged_value(info, "chrg_refid"),
        "cpc": tagged_value(info, "cpc"),
        "channel_act": F.col("channel_desc"),
        "channel_dct": F.col("channel_desc"),
        "trans_date": F.col("tlog_ts"),
        "act_date": F.col("request_ts"),
        "reno_date": F.col("next_charging_date"),
        "camp_name": tagged_value(info, "campaign"),
        "tef_prov": tagged_value(info, "TEFProvider"),
        "campana_medium": tagged_value(info, "TEFmedium"),
        "campana_id": tagged_value(info, "TEFcampaign"),
        "rev": F.col("charged_amount"),
    }
    return rows.select(*[columns.get(name, F.col(name)).alias(name) for name in FACTS[kind].columns])


def extract_cancellations(source: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Cancellations of the days, or all."""
    return source.where(in_days(F.col("timestamp"), start, end)).select(
        F.col("timestamp").alias("cancel_date"), F.col("sbn_id").cast("decimal(38,0)").alias("sbn_id"),
        F.col("msisdn").alias("tmuserid"), "cpc", "mode",
    )


def extract_refunds(source: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Refunds of the days, or all, summed per user, code, day, subscription and automatic flag; the flag is written 't' or 'f'."""
    automatic = F.col("info").ilike("%Automatic Refund%")
    rows = source.where(in_days(F.col("timestamp"), start, end)).select(
        F.col("msisdn").alias("tmuserid"), "cpc", F.to_date("timestamp").alias("refnd_date"), "amount",
        tagged_value(F.col("info"), "sbnId", ",").alias("sbnid"),
        F.when(automatic, "t").when(~automatic, "f").alias("instant_rfnd"),
    )
    return rows.groupBy("tmuserid", "cpc", "refnd_date", "sbnid", "instant_rfnd").agg(
        F.sum("amount").alias("rfnd_amount"), F.count("sbnid").alias("rfnd_cnt")
    ).select(*FACTS["rfnd"].columns)
