"""The training-data pipeline: quality rules, near duplicates, decontamination, mixing, sharding.

Each stage takes all that its predecessor kept and returns the columns of ``documents``; the last one adds ``shard``
and ``slot``. A document that is taken several times by the mix stands there as often. Nulls in any column, empty and
very long texts, repeated rows and empty tables have the results that the stages' operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from subledger.llm.common import release, stored, table
from subledger.llm.decontamination import decontaminated
from subledger.llm.mixing import mix
from subledger.llm.ngram_join import one_of_each
from subledger.llm.quality import good_documents
from subledger.llm.sharding import shard_rows


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return good_documents(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a phrase of the benchmark."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with ``shard`` and ``slot``."""
    return shard_rows(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_to_weights),
    ("sharding", sharding),
]
# The seeded draws and robust estimates have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        release(spark)
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
