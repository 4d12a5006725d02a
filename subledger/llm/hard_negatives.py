"""Hard negatives by an inverted multi-index: exact windows of integer inner products.

1. Vectors are scaled and floored to integers. Each half of a vector has a codebook of its own (k-means on a bounded sample
   of ``SAMPLE`` rows: the only thing that is fitted). The two nearest codes of a row name its cell; all rows are indexed.
   Each code keeps the largest distance of its rows' halves, its radius, and so does each cell.
2. A cell's rows score at most ``sum over halves of <anchor half, code> + |anchor half| * radius``. A heap over the two
   sorted sequences of half-bounds yields the cells by falling sum (multi-sequence algorithm).
3. Positives: a first visit of the best cells, up to ``PROBE`` rows, gives an anchor's score to beat. The second visit takes
   the cells that follow until the bound falls below that score: no unseen row can be among the first ones then.
4. Negatives: a positive's window of scores is fixed now. Cells whose scores all lie above it are passed over; again a
   first visit gives the score of the last negative wanted, and the second stops below it or below the window.

Cells are put on shelves of about ``SHELF`` rows; a larger cell fills several. Requests (anchor, shelf, cells) meet the shelf's
rows in blocks of at most ``REQUESTS`` anchors, so neither a crowded cell nor a popular shelf grows a task, and only the best
rows of each anchor leave it. Where vectors have no clusters the bounds certify late, and the visits come to all anchors
against all rows, in blocks.

Results: a row per anchor, positive and negative, with ranks from 1. Rows with a null id or label, a null vector or any null
or non-finite component take no part. A shorter vector counts as filled up with zeros. Repeated rows are rows of their own:
each is an anchor and may be another one's positive. Ties of a score go by smaller id. An empty table gives no rows; other
columns are not looked at. Scores are exact; they must fit in a long.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.llm.common import stored, table

CODES = 32
SAMPLE = 4096
PROBE = 2048
SHELF = 8192
REQUESTS = 4096
# Requests whose scores a task holds at once.
AT_ONCE = 128
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# Percent of the positive's score.
LOW, HIGH = 50, 95
# Sums below this are exact in doubles.
EXACT = 2.0 ** 53


def usable(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _floor(x: Column) -> Column:
    # Doubles from 2 ** 52 on are whole, and may be beyond the long that floor() gives.
    return F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x)


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    size = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (size == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(size), dim))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def fit_codes(sample: np.ndarray, codes: int = CODES, rounds: int = 12) -> np.ndarray:
    """Centres of a sample by k-means; at most as many as it has different rows."""
    different = np.unique(sample, axis=0)
    centres = different[np.random.default_rng(1).permutation(len(different))[:codes]]
    for _ in range(rounds):
        near = _nearest(sample, centres)
        often = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        centres = np.where(often[:, None] > 0, sums / np.maximum(often, 1)[:, None], centres)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (np.square(centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def multi_sequence(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, place in ``left``, place in ``right``) of all pairs, by falling sum."""
    a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    s, t = left[a].tolist(), right[b].tolist()
    a, b = a.tolist(), b.tolist()
    heap = [(-(s[0] + t[0]), 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, a[i], b[j]
        if j + 1 < len(t):
            heapq.heappush(heap, (-(s[i] + t[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(s):
            heapq.heappush(heap, (-(s[i + 1] + t[0]), i + 1, 0))


class Index:
    """Codebooks, and of each cell its number of rows, its radii and its shelves. Its size depends on ``CODES`` only."""

    def __init__(self, sample: np.ndarray):
        self.dim = sample.shape[1]
        self.half = self.dim // 2
        self.codes = [fit_codes(sample[:, :self.half]), fit_codes(sample[:, self.half:])]
        self.cells = len(self.codes[0]) * len(self.codes[1])

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, :self.half], x[:, self.half:]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Cell of each row, and the distances of its halves from their codes."""
        near = [_nearest(h, c) for h, c in zip(self.halves(x), self.codes)]
        away = [np.sqrt(np.square(h - c[k]).sum(axis=1)) for h, c, k in zip(self.halves(x), self.codes, near)]
        return near[0] * len(self.codes[1]) + near[1], away

    def learn(self, cells: list) -> Index:
        """Takes (cell, rows, radius, radius) of all cells with rows."""
        self.rows, self.radius = np.zeros(self.cells, np.int64), np.zeros((2, self.cells))
        for cell, n, a, b in cells:
            self.rows[cell], self.radius[:, cell] = n, (a, b)
        grid = self.radius.reshape(2, len(self.codes[0]), len(self.codes[1]))
        self.code_radius = [grid[0].max(axis=1), grid[1].max(axis=0)]
        # Neighbouring cells share a shelf while they fit.
        self.shelf, self.shelves = np.zeros(self.cells, np.int64), np.ones(self.cells, np.int64)
        shelf = filled = 0
        for cell, n in enumerate(self.rows.tolist()):
            if filled and filled + n > SHELF:
                shelf, filled = shelf + 1, 0
            self.shelf[cell] = shelf
            if n > SHELF:
                self.shelves[cell] = -(-n // SHELF)
                shelf, filled = shelf + int(self.shelves[cell]), 0
            else:
                filled += n
        return self

    def visits(self, x: np.ndarray, least: float, low: float, high: float, probe: bool) -> list[int]:
        """Cells of one visit of an anchor: the best ones up to ``PROBE`` rows, or those after them down to ``least``.

        Only scores from ``low`` to ``high`` are wanted; cells that hold none by their own radii are passed over.
        """
        parts = [x[:self.half], x[self.half:]]
        length = [float(np.sqrt(p @ p)) for p in parts]
        dots = [c @ p for c, p in zip(self.codes, parts)]
        bounds = [d + n * r for d, n, r in zip(dots, length, self.code_radius)]
        middle = np.add.outer(dots[0], dots[1]).ravel()
        reach = length[0] * self.radius[0] + length[1] * self.radius[1]
        # Doubles round; a bound is never taken for smaller than it is.
        slack = 1e-6 + 1e-9 * (np.abs(middle) + reach)
        most, fewest = middle + reach + slack, middle - reach - slack
        wanted, width, seen, out = (self.rows > 0) & (most >= low) & (fewest <= high), len(self.codes[1]), 0, []
        for bound, i, j in multi_sequence(*bounds):
            if bound + slack.max() < low:
                break
            cell = i * width + j
            if not wanted[cell]:
                continue
            if seen < PROBE:
                seen += int(self.rows[cell])
                if probe:
                    out.append(cell)
            elif probe or bound + slack.max() < least:
                break
            elif most[cell] >= least:
                out.append(cell)
        return out


def _indexed(items: DataFrame, index: Index) -> DataFrame:
    """Items with ``cell`` and the distances ``e1`` and ``e2`` of their halves from their codes."""
    def run(batches):
        for batch in batches:
            cell, away = index.assign(_matrix(batch.column("q"), index.dim))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("r", "id", "label", "anchor", "q")), pa.array(cell), pa.array(away[0]), pa.array(away[1])],
                names=["r", "id", "label", "anchor", "q", "cell", "e1", "e2"])

    return items.mapInArrow(run, "r long, id long, label long, anchor boolean, q array<double>, cell long, e1 double, e2 double")


WINDOWS = "windows array<struct<low:bigint,high:bigint>>"


def _requests(anchors: DataFrame, index: Index, probe: bool) -> DataFrame:
    """Anchors (``r``, ``label``, ``q``, ``windows``, ``least``) -> the shelves they visit, with the cells there.

    Without windows an anchor wants the best rows of its own label.
    """
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("q"), index.dim)
            take, shelf, cells = [], [], []
            for k, (least, windows) in enumerate(zip(batch.column("least").to_pylist(), batch.column("windows").to_pylist())):
                low, high = (-np.inf, np.inf) if windows is None else (min(w["low"] for w in windows), max(w["high"] for w in windows))
                places: dict[int, list[int]] = {}
                for cell in index.visits(x[k], -np.inf if least is None else least, low, high, probe):
                    for n in range(int(index.shelves[cell])):
                        places.setdefault(int(index.shelf[cell]) + n, []).append(cell)
                take += [k] * len(places)
                shelf += places.keys()
                cells += places.values()
            some = batch.select(["r", "label", "q", "windows"]).take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(shelf, pa.int64()), pa.array(cells, pa.list_(pa.int64()))],
                names=["r", "label", "q", "windows", "shelf", "cells"])

    return anchors.select("r", "label", "q", "windows", "least").mapInArrow(
        run, f"r long, label long, q array<double>, {WINDOWS}, shelf long, cells array<long>")


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers."""
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if a.shape[1] * largest * largest < EXACT:
        return a @ b.T
    whole = np.vectorize(int, otypes=[object])
    return whole(a) @ whole(b).T


def _best(index: Index, positives: int, negatives: int):
    """Rows of a shelf and requests for them -> the best rows of each anchor, or of each of its windows."""
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if len(rows) and len(asked):
            rows = rows.sort_by("id")  # the first of equal scores is that with the smallest id
            x, ids, labels, r, cell = _matrix(rows["q"], index.dim), *(rows[c].to_numpy() for c in ("id", "label", "r", "cell"))
            for at in range(0, len(asked), AT_ONCE):
                some = asked.slice(at, AT_ONCE)
                anchor, label = some["r"].to_numpy(), some["label"].to_numpy()
                scores = _product(_matrix(some["q"], index.dim), x)
                cells = some["cells"].to_pylist()
                want = np.zeros((len(some), index.cells), bool)
                for k, c in enumerate(cells):
                    want[k, c] = True
                want = want[:, cell]
                windows = some["windows"].to_pylist()
                same = label[:, None] == labels
                if windows[0] is None:
                    open_ = [(want & same & (anchor[:, None] != r), -1, positives)]
                else:
                    want &= ~same
                    open_ = []
                    for w in range(max(map(len, windows))):
                        # An empty window where the anchor has fewer.
                        low, high = (np.array([v[w][end] if w < len(v) else empty for v in windows])[:, None]
                                     for end, empty in (("low", 1), ("high", 0)))
                        open_.append((want & (scores >= low) & (scores <= high), w, negatives))
                for mask, w, n in open_:
                    left = np.where(mask, scores, -np.inf)
                    for _ in range(n):
                        best = left.argmax(axis=1)
                        k = np.flatnonzero(mask[np.arange(len(best)), best] & (left[np.arange(len(best)), best] > -np.inf))
                        if not len(k):
                            break
                        out.append((anchor[k], np.full(len(k), w), ids[best[k]], scores[k, best[k]].astype(np.int64)))
                        left[k, best[k]] = -np.inf
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table({name: pa.array(c.astype(np.int64)) for name, c in zip(("a", "w", "id", "score"), columns)})

    return run


def _visited(items: DataFrame, anchors: DataFrame, index: Index, probe: bool, positives: int, negatives: int) -> DataFrame:
    """(``a``, ``w``, ``id``, ``score``): the best rows that the anchors find on the shelves of one visit."""
    asked = stored(_requests(anchors, index, probe), "requests")
    blocks = asked.groupBy("shelf").agg(F.ceil(F.count("*") / REQUESTS).cast("int").alias("blocks"))
    rows = items.join(blocks, "shelf").select(
        "shelf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "r", "id", "label", "q", "cell")
    dealt = asked.join(blocks, "shelf").select(
        "shelf", F.pmod(F.xxhash64("r"), "blocks").cast("int").alias("block"), "r", "label", "q", "windows", "cells")
    found = rows.groupBy("shelf", "block").cogroup(dealt.groupBy("shelf", "block")).applyInArrow(
        _best(index, positives, negatives), "a long, w long, id long, score long")
    return stored(found, "found")


def _first(found: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each anchor and window, with ``rank``."""
    order = Window.partitionBy("a", "w").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {n}")


def hard_negatives(
    rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: float = SCALE,
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``).

    ``rows`` has ``id``, ``label``, ``vector`` and ``anchor`` (whether the row is one). A negative of another label scores
    between ``low`` and ``high`` percent of the positive.
    """
    spark = rows.sparkSession
    items = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))).select(
        F.monotonically_increasing_id().alias("r"), F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.coalesce("anchor", F.lit(False)).alias("anchor"), F.transform("vector", lambda x: _floor(x.cast("double") * scale)).alias("q"))
    items = stored(items, "items")
    longest = items.agg(F.max(F.size("q"))).first()[0]
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if longest is None:
        return spark.createDataFrame([], out)
    dim = max(longest, 2)  # either half has a component
    sample = items.orderBy(F.xxhash64("id", "r")).limit(SAMPLE).select("q").toArrow()
    index = Index(_matrix(sample["q"], dim))
    cells = stored(_indexed(items, index), "cells")
    of_cell = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("e1").alias("e1"), F.max("e2").alias("e2"))
    index.learn([tuple(c) for c in of_cell.collect()])  # at most CODES * CODES rows
    shelf_of = spark.createDataFrame(
        [(k, int(a), int(b)) for k, (a, b) in enumerate(zip(index.shelf, index.shelves))], "cell long, first long, shelves long")
    items = cells.join(F.broadcast(shelf_of), "cell").select(  # as many rows as cells
        "r", "id", "label", "q", "cell", "anchor", (F.col("first") + F.pmod(F.xxhash64("r"), F.col("shelves"))).alias("shelf"))
    asking = items.where("anchor").select("r", "id", "label", "q")
    none = F.lit(None).cast(WINDOWS.partition(" ")[2])

    def visit(anchors, probe):
        return _visited(items, anchors, index, probe, positives, negatives)

    # Positives.
    seen = visit(asking.withColumns({"windows": none, "least": F.lit(None).cast("double")}), True)
    beat = _first(seen, positives).groupBy("a").agg(F.min("score").cast("double").alias("least"), F.count("*").alias("n")).where(f"n = {positives}")
    rest = asking.join(beat, F.col("r") == F.col("a"), "left").select("r", "label", "q", none.alias("windows"), "least")
    best = stored(_first(seen.union(visit(rest, False)), positives).select("a", "id", "score"), "positives")
    # Windows of whole scores; those of negative positives are empty.
    window = F.struct(
        F.ceil(F.col("score") * low / F.lit(100).cast("decimal(3,0)")).cast("long").alias("low"),
        F.floor(F.col("score") * high / F.lit(100).cast("decimal(3,0)")).cast("long").alias("high"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"))
    open_ = best.select("a", window.alias("window")).where("window.low <= window.high").groupBy("a").agg(
        F.sort_array(F.collect_list("window")).alias("all"))  # as many as positives
    wanting = stored(
        asking.join(open_, F.col("r") == F.col("a"))
        .select("r", "id", "label", "q", "all", F.transform("all", lambda x: F.struct(x["low"].alias("low"), x["high"].alias("high"))).alias("windows")),
        "anchors")
    seen = visit(wanting.withColumn("least", F.lit(None).cast("double")), True)
    third = _first(seen, negatives).groupBy("a", "w").agg(F.min("score").alias("score"), F.count("*").alias("n")).where(f"n = {negatives}")
    # A window without enough rows yet needs all cells down to its low end.
    each = wanting.select(F.col("r").alias("a"), F.posexplode("windows").alias("w", "window"))
    beat = each.join(third, ["a", "w"], "left").groupBy("a").agg(F.min(F.coalesce("score", "window.low")).cast("double").alias("least"))
    rest = wanting.join(beat, F.col("r") == F.col("a")).select("r", "label", "q", "windows", "least")
    found = _first(seen.union(visit(rest, False)), negatives)
    named = wanting.select(F.col("r").alias("a"), F.col("id").alias("anchor_id"), F.posexplode("all").alias("w", "window"))
    return found.join(named, ["a", "w"]).select(
        "anchor_id", F.col("window.positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("window.positive_score").alias("positive_score"), F.col("score").alias("negative_score"))


def op12_multi_index_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth vector."""
    key = F.col("vec_id")
    label = F.when(key % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").select(
        key.alias("id"), label.alias("label"), F.col("embedding").alias("vector"), (key % 50 == 0).alias("anchor"))
    return hard_negatives(rows)


SQL = """
WITH items AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
    SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM items a JOIN items b ON a.vec_id % 50 = 0 AND a.r <> b.r
), positives AS (
    SELECT a, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY a ORDER BY score DESC, id) AS place
    FROM scores WHERE same QUALIFY place <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.place ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scores n
  ON n.a = p.a AND NOT n.same AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
