"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates.

Statistics of a text (words, word length, symbols, repeated lines, repeated three-word windows) are turned into
a vector of logarithms. For each language and source, location and scatter are estimated from the three quarters
of the documents that fit best: from several deterministic starts, concentration steps alternate between the
estimate and the documents nearest to it, and the start with the smallest determinant wins. A reweighting step
follows, and a document whose squared Mahalanobis distance exceeds a chi-square quantile is rejected.

All documents that pass the base rules take part, through sums per group and histograms of distances, so no
group is gathered or ordered anywhere. A statistic that hardly varies in a group gets the least variance that lets
its bound pass: a document farther than ``BOUNDS`` from the group's center is then rejected for that alone; where a
group varies more, its own scatter holds. Documents of a group smaller than ``MIN_GROUP`` are judged with all small
groups of their language; if these are still too few, only the base rules hold.

Null and empty texts have no words and fail the base rules; null languages or sources are groups like others;
repeated rows count as often as they occur, and get the same verdict; an empty table gives no rows. Input columns
with the name of an output column are replaced.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.llm.common import FEW, SPACES, keeping, release, stored, table

MIN_WORDS = 50
MAX_REPEATED = 50  # percent
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
# Distances from the center beyond which a statistic rejects by itself: eight times as many or few words, words longer
# or shorter by a third, and, from a center of none, a symbol for every five words, half of the lines or two fifths of
# the words repeated (half of the words fail the base rule).
BOUNDS = (math.log(8), math.log(1.35), math.log1p(10 * 0.2), math.log1p(10 * 0.5), math.log1p(10 * 0.4))
DIMENSIONS = len(BOUNDS)
# Share of a group that the concentration steps keep, and how many of them run.
SHARE = 0.75
STEPS = 5
MIN_GROUP = 40
# Clean documents beyond the cut: about one in a hundred thousand of a normal law.
TAIL = 1e-5
REWEIGHT_TAIL = 0.025
# Histogram bins per factor e of the squared distance.
FINENESS = 20
# Part of its own variance that every statistic gets on top, so that a scatter of tied statistics can be inverted.
RIDGE = 0.01


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the statistics and ``base_failed``; row by row, without a shuffle."""
    docs = docs.select(*keeping(docs, *STATISTICS, "base_failed", "_words", "_lines"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        *names,
        F.filter(F.split(text, SPACES), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    w = F.col("_words")
    windows = F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), w[i].alias("a"), w[i + 1].alias("b"),
                           w[i + 2].alias("c"), i.alias("i")),
    )).otherwise(F.array().cast("array<struct<h:bigint,a:string,b:string,c:string,i:int>>"))
    # Equal windows stand side by side once sorted, the hash first so that words are seldom compared.
    sorted_ = split.select(*names, "_words", "_lines", F.sort_array(windows).alias("_windows"))
    s = F.col("_windows")

    def same(x, y):
        return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    # Out of range gives null, which counts as different.
    again = F.filter(s, lambda x, k: F.coalesce(same(x, F.get(s, k - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, k + 1)), F.lit(False)))
    starts = F.transform(again, lambda x: x["i"])
    covered = F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))
    counted = sorted_.select(
        *names,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def vector() -> list[Column]:
    """The transformed statistics of a document that has words."""
    n = F.col("n_words").cast("double")

    def share(part, whole):
        return F.log1p(10 * F.col(part) / F.col(whole))

    return [F.log(n), F.log(F.col("word_chars") / n), share("n_symbols", "n_words"),
            share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]


def chi_square_cdf(x: float, k: float) -> float:
    """Distribution function of the chi-square law with ``k`` degrees of freedom."""
    a, h = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= h / n
        total += term
    return total * math.exp(a * math.log(h) - h - math.lgamma(a)) if x > 0 else 0.0


def chi_square_quantile(p: float, k: float) -> float:
    """Its inverse, by bisection."""
    low, high = 0.0, 1.0
    while chi_square_cdf(high, k) < p:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, k) < p else (low, middle)
    return high


# Least variance of each statistic: its bound is then at the cut.
CUT = chi_square_quantile(1 - TAIL, DIMENSIONS)
FLOORS = tuple(bound ** 2 / CUT for bound in BOUNDS)


def consistency(share: float) -> float:
    """Factor that makes the scatter of the nearest ``share`` estimate that of the whole normal law."""
    return share / chi_square_cdf(chi_square_quantile(share, DIMENSIONS), DIMENSIONS + 2)


def inverted(scatter: Column) -> Column:
    """(``inverse``, ``logdet``) of a positive matrix (array of rows), by elimination without pivoting."""
    p = DIMENSIONS
    unit = F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda i: F.concat(
        F.element_at(scatter, i + 1),
        F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda j: F.when(i == j, 1.0).otherwise(0.0))))
    zero = F.struct(unit.alias("m"), F.lit(0.0).alias("logdet"))

    def eliminate(acc, k):
        row = acc["m"][k]
        scaled = F.transform(row, lambda v: v / row[k])
        return F.struct(
            F.transform(acc["m"], lambda r, i: F.when(i == k, scaled).otherwise(
                F.zip_with(r, scaled, lambda a, b: a - r[k] * b))).alias("m"),
            (acc["logdet"] + F.log(row[k])).alias("logdet"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(p - 1)), zero, eliminate, lambda acc: F.struct(
        F.flatten(F.transform(acc["m"], lambda r: F.slice(r, p + 1, p))).alias("inverse"), acc["logdet"].alias("logdet")))


PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]


SUMS = [f"s{i}" for i in range(DIMENSIONS)] + [f"q{i}{j}" for i, j in PAIRS]


def summed(points: DataFrame, *keys: str) -> DataFrame:
    """Count and sums of ``x`` and of its products around ``origin``, per key.

    Sums are decimals of fixed scale: they do not depend on the order of rows.
    """
    y = [F.col("x")[i] - F.col("origin")[i] for i in range(DIMENSIONS)]
    terms = y + [y[i] * y[j] for i, j in PAIRS]
    return points.groupBy(*keys).agg(
        F.count("*").alias("n"), F.first("origin").alias("origin"),
        *[F.sum(term.cast("decimal(24,12)")).alias(name) for term, name in zip(terms, SUMS)])


def estimate(sums: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """(keys, ``origin``, ``center``, ``inverse``, ``logdet``) from sums."""
    n = F.col("n").cast("double")
    mean = [F.col(f"s{i}").cast("double") / n for i in range(DIMENSIONS)]

    def cell(i, j):
        i, j = min(i, j), max(i, j)
        spread = F.col(f"q{i}{j}").cast("double") / n - mean[i] * mean[j]
        return F.greatest(spread * (factor * (1 + RIDGE)), F.lit(FLOORS[i])) if i == j else spread * factor

    rows = F.array(*[F.array(*[cell(i, j) for j in range(DIMENSIONS)]) for i in range(DIMENSIONS)])
    center = F.array(*[F.col("origin")[i] + mean[i] for i in range(DIMENSIONS)])
    return (
        sums.select(*keys, "origin", center.alias("center"), rows.alias("scatter"))
        .withColumn("i", inverted(F.col("scatter")))
        .select(*keys, "origin", "center", "i.inverse", "i.logdet")
    )


def squared_distance() -> Column:
    """Squared Mahalanobis distance of ``x`` from ``center`` under ``inverse``."""
    d = [F.col("x")[i] - F.col("center")[i] for i in range(DIMENSIONS)]
    inverse = F.col("inverse")
    return reduce(lambda a, b: a + b, [
        d[i] * d[j] * inverse[i * DIMENSIONS + j] * (1.0 if i == j else 2.0) for i, j in PAIRS])


def concentrated(points: DataFrame, fit: DataFrame) -> DataFrame:
    """One concentration step: the estimate from the nearest ``SHARE`` of each group under ``fit``.

    Points are summed by bins of their distance, in one pass; the nearest bins are those before the one in which the
    share is reached, and this one as a whole. Bins per group are bounded by the range of a double's logarithm.
    """
    near = points.join(fit.drop("logdet"), "g").withColumn("bin", F.floor(F.log(squared_distance() + 1e-6) * FINENESS).cast("int"))
    group = Window.partitionBy("g", "start")
    bins = (
        summed(near, "g", "start", "bin")
        .withColumn("until", F.sum("n").over(group.orderBy("bin")))
        .withColumn("all", F.sum("n").over(group))
        .where(F.col("until") - F.col("n") < F.ceil(F.col("all") * SHARE))
        .groupBy("g", "start").agg(F.first("origin").alias("origin"), F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in SUMS])
    )
    return estimate(bins, ["g", "start"], consistency(SHARE))


def _starts(points: DataFrame) -> DataFrame:
    """Estimates from which the concentration steps begin: (``g``, ``start``, ``origin``, fit).

    Medians and median deviations per statistic give the first; the second and third let only the points near
    the medians, or near them in word length and repetition, make the estimate.
    """
    # Sketches of fixed size: merged before and after the shuffle.
    q = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    quartiles = points.groupBy("g").agg(*[F.percentile_approx(F.col("x")[i], q, F.lit(1000)).alias(f"p{i}") for i in range(DIMENSIONS)])
    middle = F.array(*[F.col(f"p{i}")[1] for i in range(DIMENSIONS)])

    def diagonal(weights):
        return F.array(*[
            (weights[i] / F.greatest(F.pow((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349, 2), F.lit(FLOORS[i]))) if i == j else F.lit(0.0)
            for i in range(DIMENSIONS) for j in range(DIMENSIONS)])

    weights = ([1.0] * 5, [0.25, 1.0, 1.0, 1.0, 1.0], [0.0625, 4.0, 1.0, 1.0, 4.0])
    return quartiles.select("g", middle.alias("origin"), middle.alias("center"), F.explode(F.array(*[
        F.struct(F.lit(k).alias("start"), diagonal(w).alias("inverse")) for k, w in enumerate(weights)])).alias("s")).select(
            "g", "s.start", "origin", "center", "s.inverse")


def group_key(rows: DataFrame) -> DataFrame:
    """Documents that take part, as (``g``, ``x``): their group's key and vector."""
    size = rows.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("members"))
    return stored(size.select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), "members",
        F.when(F.col("members") >= MIN_GROUP, F.struct(F.col("lang"), F.col("source"), F.lit(False).alias("small")))
        .otherwise(F.struct(F.col("lang"), F.lit(None).cast("string").alias("source"), F.lit(True).alias("small"))).alias("key"),
    ).select("_lang", "_source", "members", F.to_json("key").alias("g")), "groups", FEW)


def fitted(rows: DataFrame) -> DataFrame:
    """(``_lang``, ``_source``, ``center``, ``inverse``): the final estimate for each language and source."""
    groups = group_key(rows)
    own = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    points = rows.where(~F.col("base_failed")).select("lang", "source", F.array(*vector()).alias("x")).join(groups, own).select("g", "x")
    enough = points.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_GROUP).select("g")
    points = stored(points.join(enough, "g", "left_semi"), "points", numeric=True)
    fit = stored(_starts(points), "fit", FEW)
    for _ in range(STEPS):
        fit = stored(concentrated(points, fit), "fit", FEW)
        release(rows.sparkSession)
    best = Window.partitionBy("g").orderBy("logdet", "start")
    fit = fit.withColumn("place", F.row_number().over(best)).where("place = 1").select("g", "origin", "center", "inverse")
    # Reweighting: all points that the raw estimate finds ordinary.
    inside = points.join(fit, "g").where(squared_distance() <= chi_square_quantile(1 - REWEIGHT_TAIL, DIMENSIONS))
    final = estimate(summed(inside, "g"), ["g"], consistency(1 - REWEIGHT_TAIL))
    return stored(groups.join(final, "g", "left").select("_lang", "_source", "center", "inverse"), "final", FEW)


def judged(rows: DataFrame, numeric: bool = False) -> DataFrame:
    """Rows of :func:`text_statistics` with ``distance`` (null where no estimate is) and ``kept``.

    The rows are stored first, since every step of the estimate reads them; ``numeric`` is that of ``stored``.
    """
    rows = stored(rows, "statistics", numeric=numeric)
    release(rows.sparkSession)
    fit = fitted(rows)
    rows = rows.select(*keeping(rows, "distance", "kept"))
    names = [F.col(f"`{c}`") for c in rows.columns]
    own = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    measured = rows.join(fit, own).withColumn("x", F.when(F.col("n_words") > 0, F.array(*vector())))
    distance = measured.select(*names, squared_distance().alias("distance"))
    return distance.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUT))


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    packed = docs.select(F.struct(*keeping(docs)).alias("row"), "text", "lang", "source")
    return judged(text_statistics(packed).drop("text")).where("kept").select("row.*")


def op2_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return judged(text_statistics(docs).drop("text"), numeric=True).select("doc_id", *STATISTICS, "base_failed", "kept", "distance", "lang", "source")
