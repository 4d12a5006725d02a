"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Each stored input partition is permuted locally. How many of its rows go to each shard is drawn from the
multivariate hypergeometric law whose margins are the partition sizes and the exact shard sizes; so the
counts are those of a uniform permutation of all rows. Rows are then exchanged, and permuted again inside
their shard. The matrix is drawn down a tree over the partitions, one level a job, so neither the driver nor
one task ever holds it.

Law ``rows``: shard sizes differ by one row at most. Sizes do not depend on content: null or empty texts,
repeated rows, null ids and very long texts are rows like others; equal rows are interchangeable, equal
texts are not kept together. An empty table gives no rows. Input columns named ``shard`` or ``slot`` are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.llm.common import KEY_BITS, keeping, key63, stored, table, uniform

SHARDS = 24
SEED = 20240501
# Partitions that one node of the tree divides among its children.
FAN_OUT = 32
# Rows that one task permutes inside a shard, about.
ROWS_PER_BLOCK = 50_000
# Outcomes further than this many standard deviations from the mode weigh less than a double resolves.
REACH = 9


def _long(value) -> Column:
    return F.lit(value).cast("long")


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """Number of good items among ``draws`` items drawn from ``good + bad``, by inversion at ``u``.

    Outcomes are visited from the mode upward, then downward; their weights follow from the ratio of
    neighbouring probabilities, so no factorial is needed.
    """
    def parts(good, bad, draws, u):
        low, high = F.greatest(_long(0), draws - bad), F.least(draws, good)
        items = (good + bad).cast("double")
        mode = F.floor((draws + 1).cast("double") * (good + 1).cast("double") / (items + 2))
        mode = F.least(F.greatest(mode, low), high)
        spread = F.sqrt(
            draws.cast("double") * good.cast("double") * bad.cast("double") * (items - draws)
            / F.greatest(items * items * (items - 1), F.lit(1.0))
        )
        reach = F.ceil(spread * REACH) + REACH
        return F.struct(
            good.alias("good"), bad.alias("bad"), draws.alias("draws"), u.alias("u"), mode.alias("mode"),
            F.greatest(low, mode - reach).alias("first"), F.least(high, mode + reach).alias("last"),
        )

    def up(s, x):  # probability of x + 1 over that of x
        return ((s["good"] - x).cast("double") * (s["draws"] - x).cast("double")
                / ((x + 1).cast("double") * (s["bad"] - s["draws"] + x + 1).cast("double")))

    def down(s, x):  # probability of x - 1 over that of x
        return (x.cast("double") * (s["bad"] - s["draws"] + x).cast("double")
                / ((s["good"] - x + 1).cast("double") * (s["draws"] - x + 1).cast("double")))

    def steps(first, last):
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    def weigh(s, ratio, xs):
        zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        return F.aggregate(xs, zero, lambda acc, x: F.struct(
            (acc["w"] * ratio(s, x)).alias("w"), (acc["sum"] + acc["w"] * ratio(s, x)).alias("sum")))["sum"]

    def walk(s, ratio, xs, offset, seen, goal):
        zero = F.struct(F.lit(1.0).alias("w"), seen.alias("sum"), _long(-1).alias("at"))

        def visit(acc, x):
            w = acc["w"] * ratio(s, x)
            hit = (acc["at"] < 0) & (acc["sum"] + w >= goal)
            return F.struct(w.alias("w"), (acc["sum"] + w).alias("sum"),
                            F.when(hit, x + offset).otherwise(acc["at"]).alias("at"))

        return F.aggregate(xs, zero, visit)["at"]

    def choose(s):
        ups, downs = steps(s["mode"], s["last"] - 1), F.reverse(steps(s["first"] + 1, s["mode"]))
        sums = F.struct(weigh(s, up, ups).alias("up"), weigh(s, down, downs).alias("down"))

        def pick(t):
            goal = s["u"] * (F.lit(1.0) + t["up"] + t["down"])
            above = walk(s, up, ups, 1, F.lit(1.0), goal)
            below = walk(s, down, downs, -1, F.lit(1.0) + t["up"], goal)
            return (F.when(goal <= 1.0, s["mode"]).when(goal <= F.lit(1.0) + t["up"], above).otherwise(below))

        picked = F.transform(F.array(sums), pick)[0]
        return F.when(F.coalesce(picked, _long(-1)) < 0, s["mode"]).otherwise(picked)

    return F.transform(F.array(parts(good, bad, draws, u)), choose)[0]


def _draw(margins: Column, node: Column, rows: Column, seed: int) -> Column:
    """How many of a child's rows go to each column, given what the columns still have room for."""
    total = F.aggregate(margins, _long(0), lambda acc, m: acc + m)
    zero = F.struct(F.array().cast("array<bigint>").alias("out"), total.alias("rest"), rows.alias("left"))

    def one(acc, place):
        good = F.element_at(margins, (place + 1).cast("int"))
        drawn = hypergeometric(good, acc["rest"] - good, acc["left"], uniform(seed, node, place))
        return F.transform(F.array(drawn), lambda x: F.struct(
            F.concat(acc["out"], F.array(x)).alias("out"), (acc["rest"] - good).alias("rest"),
            (acc["left"] - x).alias("left")))[0]

    return F.aggregate(F.sequence(_long(0), (F.size(margins) - 1).cast("long")), zero, one)["out"]


def _divide(level: int, seed: int):
    """Gives one child its rows' columns and leaves the rest of the room to its later siblings."""
    def one(acc, child):
        drawn = _draw(acc["room"], child["child"] * 64 + level, child["rows"], seed)
        return F.transform(F.array(drawn), lambda d: F.struct(
            F.zip_with(acc["room"], d, lambda r, x: r - x).alias("room"),
            F.concat(acc["done"], F.array(F.struct(child["child"].alias("node"), d.alias("counts")))).alias("done"),
        ))[0]

    return one


def communication_matrix(sizes: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(``part``, ``counts``) for (``part``, ``rows``): an exact draw with shard sizes at most one apart."""
    spark = sizes.sparkSession
    total, top = sizes.agg(F.sum("rows"), F.max("part")).first()
    if not total:
        return sizes.select("part", F.array().cast("array<bigint>").alias("counts"))
    levels = 1
    while FAN_OUT ** levels <= top:
        levels += 1
    whole, extra = divmod(total, shards)
    nodes = spark.range(1).select(
        F.col("id").alias("node"),
        F.transform(F.sequence(_long(0), _long(shards - 1)), lambda s: _long(whole) + F.when(s < extra, 1).otherwise(0)).alias("counts"),
    )
    for level in reversed(range(levels)):
        width = FAN_OUT ** level
        children = (
            sizes.groupBy(F.floor(F.col("part") / width).cast("long").alias("child")).agg(F.sum("rows").alias("rows"))
            .groupBy(F.floor(F.col("child") / FAN_OUT).cast("long").alias("node"))
            .agg(F.sort_array(F.collect_list(F.struct("child", "rows"))).alias("children"))  # FAN_OUT at most
        )

        zero = F.struct(
            F.col("counts").alias("room"),
            F.array().cast("array<struct<node:bigint,counts:array<bigint>>>").alias("done"),
        )
        nodes = stored(
            nodes.join(children, "node")
            .select(F.explode(F.aggregate("children", zero, _divide(level, seed))["done"]).alias("c")).select("c.*"),
            "matrix",
        )
    return nodes.withColumnRenamed("node", "part")


def shard_rows(rows: DataFrame, shards: int = SHARDS, seed: int = SEED,
               rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """All rows and columns, with ``shard`` (int) and ``slot`` (long, gapless from 0 in its shard)."""
    kept = keeping(rows, "shard", "slot")
    names = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    packed = rows.select(F.struct(*kept).alias("row"))
    # First permutation, inside each input partition; stored, so partitions and places are fixed from here on.
    placed = stored(
        packed.sortWithinPartitions(key63(seed, F.col("row")))
        .select("row", F.spark_partition_id().cast("long").alias("part"),
                F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place")),
        "placed",
    )
    sizes = stored(placed.groupBy("part").agg(F.count("*").alias("rows")), "sizes")
    matrix = communication_matrix(sizes, shards, seed).select(
        "part",
        F.aggregate(
            "counts", F.array().cast("array<bigint>"),
            lambda acc, n: F.concat(acc, F.array(n + F.coalesce(F.try_element_at(acc, F.lit(-1)), _long(0)))),
        ).alias("ends"),
    )
    # The exchange: a row goes where its place falls among its partition's counts.
    key = key63(seed + 1, F.col("part"), F.col("place"))
    sent = placed.join(matrix, "part").select(
        "row", "part", "place", key.alias("key"),
        F.size(F.filter("ends", lambda end: end <= F.col("place"))).alias("shard"),
    )
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    blocks = max(1, -(-total // (shards * rows_per_block)))
    sent = sent.withColumn("block", F.floor(F.col("key") / float(2 ** KEY_BITS) * blocks).cast("long"))
    # Second permutation: the shard's blocks are key ranges, so its order is that of the whole shard's keys.
    before = (
        sent.groupBy("shard", "block").agg(F.count("*").alias("n"))
        .select("shard", "block", (F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")).alias("before"))
    )
    order = Window.partitionBy("shard", "block").orderBy("key", "part", "place")
    return (
        sent.withColumn("n", F.row_number().over(order))
        .join(before, ["shard", "block"])
        .select(*[F.col(f"row.`{c}`") for c in names], F.col("shard").cast("int").alias("shard"),
                (F.col("before") + F.col("n") - 1).cast("long").alias("slot"))
    )


def op5_hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards, under the law ``rows``."""
    slim = table(spark, folder, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return shard_rows(slim).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
