"""Mixing sources to target weights, by capped water-filling.

Every source asks for its weight's share of all words. A source that asks for more than ``max_epochs`` times
its own size is clamped there, and what it leaves is shared among the others by weight, until none exceeds
its cap. A source then gives its documents as often as its target holds whole repetitions, and a seeded part
of them once more: those with the smallest keys, up to the key at which the part's words are reached. That key
is found by narrowing key ranges over all documents, so no source is ever ordered in one task.

Null and empty texts have size 0 and take no words; a null source is a source of its own, the last one; an empty
table gives no rows; sources without words have target 0. Equal rows stand side by side in the order of keys and are
taken one by one, so a source that is one row many times meets its target, too; which of them are taken makes no
difference to the rows of the result. Input columns with the name of an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.llm.common import FEW, KEY_BITS, count_words, keeping, key63, stored, table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 11
# Bits of the key that one round of narrowing fixes; the last round looks at the keys themselves.
BITS = 16
ROUNDS = 4
# Lowest bits of the key that tell equal rows apart; more rows than they have values share them evenly.
ROW_BITS = 20


def ranked(rows: DataFrame, *order) -> DataFrame:
    """The rows with ``rank`` from 0: ranges are numbered side by side, then shifted by what is before them."""
    placed = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"),
                F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")),
        "ranked",
    )
    # One row per shuffle partition.
    before = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(before, "_part").select(*keeping(rows), (F.col("_before") + F.col("_place")).alias("rank"))


def water_filled(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (``source``, ``source_size``, ``weight``) with ``target``."""
    cap = F.col("source_size") * float(max_epochs)
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level, clamped = 0.0, -1
    while True:
        # What the clamped sources hold and what the others weigh, under the level of the last round.
        full = F.col("weight") * level > cap
        n, held, weight = sources.agg(
            F.count_if(full), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if n == clamped or not weight:
            break
        level, clamped = (total - (held or 0.0)) / weight, n
    return sources.withColumn("target", F.least(cap, F.col("weight") * level))


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents with ``size`` (words) and a seeded ``_key``: of id and text, and last of the row's number.

    Equal rows get other numbers when they are computed again, so the rows must be stored before they are used twice.
    """
    content = key63(seed, F.col("doc_id"), F.col("text"))
    number = key63(seed, F.monotonically_increasing_id())
    low = F.lit((1 << ROW_BITS) - 1)
    return docs.select(
        *keeping(docs, "size", "_key"), count_words(F.col("text")).alias("size"),
        content.bitwiseAND(F.bitwise_not(low.cast("long"))).bitwiseOR(number.bitwiseAND(low)).alias("_key"),
    )


def recipe(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source_size``, ``target``, ``whole`` repetitions, and the last ``cut`` key of the part."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stored(
        ranked(totals, F.col("source").asc_nulls_last()).withColumn("weight", weight.cast("double")), "sources", FEW)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    state = stored(
        water_filled(sources, max_epochs)
        .withColumn("whole", F.floor(epochs + 1e-12))
        .select(
            "source", "source_size", "target", "whole",
            F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)).alias("part"),
            F.lit(0).cast("long").alias("bin"), F.lit(0.0).alias("before"),
        ),
        "recipe", FEW,
    )
    shift = KEY_BITS
    for round_ in range(ROUNDS):
        prefix, shift = shift, 0 if round_ == ROUNDS - 1 else shift - BITS
        # Keys inside the range found so far, cut into finer ranges; at most 2 ** BITS per source before the last.
        inside = F.lit(0).cast("long") if prefix == KEY_BITS else F.shiftright(F.col("_key"), prefix)
        fine = (
            sized.select("source", "size", F.shiftright(F.col("_key"), shift).alias("fine"), inside.alias("bin"))
            .groupBy(F.col("source").alias("of"), F.col("bin").alias("in"), "fine").agg(F.sum("size").alias("words"))
        )
        run = F.sum("words").over(Window.partitionBy("of").orderBy("fine"))
        found = (
            state.drop("words").where("part > 0")
            .join(fine, F.col("of").eqNullSafe(F.col("source")) & (F.col("in") == F.col("bin")))
            .select("of", "part", "fine", "words", (F.col("before") + run).alias("after"))
            .where(F.col("after") >= F.col("part"))
            .groupBy("of").agg(F.min(F.struct("fine", "after", "words")).alias("f"))
        )
        state = stored(
            state.drop("words").join(found, F.col("source").eqNullSafe(F.col("of")), "left")
            .select(
                "source", "source_size", "target", "whole", "part",
                F.coalesce("f.fine", F.lit(-1).cast("long")).alias("bin"),
                F.coalesce(F.col("f.after") - F.col("f.words"), F.lit(0.0)).alias("before"),
                F.coalesce("f.words", F.lit(0)).alias("words"),
            ),
            "recipe", FEW,
        )
    # The document at the cut is taken if that brings the source nearer to its target.
    taken = F.col("part") - F.col("before") >= F.col("words") / 2
    return state.select(
        "source", "source_size", "target", "whole",
        F.when(F.col("bin") < 0, -1).when(taken, F.col("bin")).otherwise(F.col("bin") - 1).alias("cut"),
    )


def mixed(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """The measured documents with ``source_size``, ``target``, ``copies`` and ``taken``."""
    sized = sized.select(*keeping(sized, "source_size", "target", "copies", "taken"))
    copies = (F.col("whole") + F.when(F.col("_key") <= F.col("cut"), 1).otherwise(0)).cast("long")
    plan = plan.withColumnRenamed("source", "_of")
    return sized.join(plan, F.col("source").eqNullSafe(F.col("_of"))).select(
        *keeping(sized, "_key"), "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken."""
    columns = [F.col(f"row.`{c}`") for c in docs.columns]
    packed = docs.select(F.struct(*keeping(docs)).alias("row"), "doc_id", "text", "source")
    sized = stored(measured(packed, seed).select("row", "source", "size", "_key"), "sized")
    plan = recipe(sized.select("source", "size", "_key"), weights, max_epochs)
    rows = mixed(sized, plan).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*columns)


def op6_water_filling(spark: SparkSession, folder: str) -> DataFrame:
    """How many words the mix takes of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    sized = stored(measured(docs).select("doc_id", "source", "size", "_key"), "sized")
    return mixed(sized, recipe(sized)).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")
