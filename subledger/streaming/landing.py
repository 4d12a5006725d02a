"""The daily append as a micro-batch job over a landing folder.

It runs the same functions as the batch job, which are idempotent, so a replayed batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from subledger.schemas import Fact
from subledger.sources.csv import text_schema, typed, with_place
from subledger.sources.tables import append_batch


def follow_landing(
    spark: SparkSession, landing: str, root: str, fact: Fact, checkpoint: str, max_files: int = 100
) -> StreamingQuery:
    """Append every new file of a type to its table, then stop (``availableNow``)."""
    raw = (
        spark.readStream.schema(text_schema(fact))
        .option("header", True).option("escape", '"')
        .option("maxFilesPerTrigger", max_files)
        .option("pathGlobFilter", f"{fact.file_prefix}*.csv")
        .csv(landing)
    )

    def append(batch: DataFrame, _: int) -> None:
        numbered = batch.withColumn("_row", F.monotonically_increasing_id())
        append_batch(batch.sparkSession, root, fact, typed(numbered, fact, "_file", "_block", "_row"))

    return (
        with_place(raw).writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
