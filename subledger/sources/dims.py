"""Reference data: the product dimension, exclusion lists and code lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger import fixed_values as fixed
from subledger.functions import blank_to_null, lookup
from subledger.operators.dedupe import keep_last
from subledger.schemas import DIM_SCHEMA
from subledger.sources.csv import with_position


def complete_dim(raw: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Null defaults, then one row per code: the first in ``order``, or the smallest row where none is given."""
    filled = raw.withColumns({
        "service_name": F.coalesce("service_name", F.lit("UNKNOWN")),
        "tme_category": F.coalesce("tme_category", F.lit("")),
        "cpc_period": F.coalesce("cpc_period", F.lit(0)).cast("bigint"),
        "cpc_price": F.coalesce("cpc_price", F.lit(0.0)),
    })
    if order is None:
        rest = F.struct("service_name", "tme_category", "cpc_period", "cpc_price")
        first = filled.groupBy("cpc").agg(F.min(rest).alias("r"))
        return first.select("cpc", "r.*")
    return keep_last(filled, ["cpc"], order).select(*DIM_SCHEMA.fieldNames())


def distinct_dim(rows: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """One row per code with its blanks left null, for joins that must not fill names."""
    if order is None:
        rest = F.struct("service_name", "tme_category", "cpc_period", "cpc_price")
        return rows.groupBy("cpc").agg(F.min(rest).alias("r")).select("cpc", "r.*")
    return keep_last(rows, ["cpc"], order).select(*DIM_SCHEMA.fieldNames())


def load_dim(spark: SparkSession, path: str, fill: bool = True) -> DataFrame:
    """The product dimension from CSV; of rows sharing a code the first in the file stays.

    Missing cells get their defaults, unless ``fill`` is off.
    """
    raw = spark.read.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", True).csv(path)
    cells = [blank_to_null(F.col(f.name), ("", "NULL")).try_cast(f.dataType).alias(f.name) for f in DIM_SCHEMA.fields]
    rows = with_position(raw).select(*cells, "_file", "_block", "_row").where("cpc is not null")
    return (complete_dim if fill else distinct_dim)(rows, [F.struct(-F.col("_block"), -F.col("_row"))])


def first_word(text: Column) -> Column:
    return F.try_element_at(F.split(F.trim(text), r"\s+"), F.lit(1))


def build_dim(raw: DataFrame, period_days: Mapping[str, int] = fixed.PERIOD_DAYS, order: Column | None = None) -> DataFrame:
    """The product dimension from the raw product sheet.

    ``raw`` has the columns ``TME Category``, ``Service Name``, ``CPC``, ``Subscription Model`` and
    ``Price``; codes that are not numeric are dropped, and of rows sharing a code the first in ``order``
    stays (row order of the sheet).
    """
    days = F.coalesce(lookup(first_word(F.col("Subscription Model")), period_days), F.lit(0))
    rows = raw.select(
        F.col("CPC").cast("string").try_cast("double").try_cast("bigint").alias("cpc"),
        F.col("Service Name").alias("service_name"),
        F.col("TME Category").alias("tme_category"),
        days.cast("bigint").alias("cpc_period"),
        F.col("Price").cast("string").try_cast("double").alias("cpc_price"),
        (order if order is not None else F.monotonically_increasing_id()).alias("_place"),
    ).where("cpc is not null")
    return keep_last(rows, ["cpc"], [-F.col("_place")]).drop("_place")


def expand_code_sets(raw: DataFrame) -> DataFrame:
    """Legacy dimension with codes in set notation, ``{1,2,3}``: one row per code.

    An empty set falls back to the row's upgrade code; an empty service name becomes UNKNOWN.
    """
    text = F.btrim(F.coalesce("CPCs", F.lit("")), F.lit("{} "))
    upgrade = F.coalesce(F.col("Upgrade_CPC").cast("string"), F.lit(""))
    codes = F.split(F.when(text == "", upgrade).otherwise(text), ",")
    return raw.select(
        F.explode(F.transform(codes, lambda c: F.trim(c).try_cast("bigint"))).alias("cpc"),
        F.coalesce(blank_to_null(F.col("Service Name")), F.lit("UNKNOWN")).alias("service_name"),
        F.coalesce(blank_to_null(F.col("TME Category")), F.lit("")).alias("tme_category"),
        F.coalesce(F.col("CHG_Period").cast("string").try_cast("bigint"), F.lit(0).cast("bigint")).alias("cpc_period"),
        F.coalesce(F.col("CHG_Price").cast("string").try_cast("double"), F.lit(0.0)).alias("cpc_price"),
    ).where("cpc is not null")


def load_excluded(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Phones and users of an exclusion list, with or without a header line; empties are left out."""
    cells = F.split(F.col("value"), ",")
    lines = spark.read.text(path).select(
        *[F.btrim(F.try_element_at(cells, F.lit(i)), F.lit(' "')).alias(c) for i, c in ((1, "a"), (2, "b"))]
    )
    body = lines.where("lower(a) <> 'msisdn'")
    phones = body.where("a <> ''").select(F.col("a").alias("msisdn")).distinct()
    users = body.where("b <> ''").select(F.col("b").alias("tmuserid")).distinct()
    return phones, users


def load_codes(spark: SparkSession, path: str) -> DataFrame:
    """A list of codes, one per line; blank lines are skipped."""
    lines = spark.read.text(path).select(F.trim("value").try_cast("bigint").alias("cpc"))
    return lines.where("cpc is not null").distinct()
