"""N-gram Jaccard self-join by MinHash banding, with every candidate pair verified on full n-gram sets.

1. Every whole text becomes its set of five-word n-grams (a text of one to four words is one n-gram). Documents
   with equal sets form one class, known by a 128-bit fingerprint; only classes go on, so copies cost nothing.
2. A class's MinHash signature is cut into bands. :func:`choose_bands` takes the fewest bands with which a pair
   at the threshold meets in at least one band with the target recall.
3. Classes are shuffled on band hashes. Buckets with the same members as another one are dropped. Members of the
   remaining buckets get their full n-gram sets, and each bucket is verified inside tasks, without emitting its
   pairs: a task answers with each member's number of links and with the edges of a spanning forest. Large buckets
   are cut into blocks, and every pair of blocks is a task of its own, so no task grows with a bucket.
   A pair is counted in the first band in which it meets, so never twice.
4. Forest edges are joined into groups by alternating large and small stars, in DataFrame steps.

Results: one row per document with its ``class_id`` (smallest id of its group of linked documents), ``rep_id``
(smallest id with an equal set) and ``n_links`` (other documents with a similarity of at least the threshold).
Null and empty texts have no n-grams: they are their own class with no link. Null ids are allowed (a group of
null ids only has a null ``class_id``); repeated rows are copies. An empty table gives no rows. Other columns
are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import keeping, stored, table
from subledger.llm.text import BLOCK_BYTES, Words, blocks, mixed, windows, words

N = 5
THRESHOLD = 0.8
# Part of the pairs at the threshold that must meet; pairs above it meet more often.
RECALL = 0.9999
ROWS = 5
# Members of a bucket that one task holds; a pair of blocks holds twice as many.
BLOCK_MEMBERS = 512
SEED = 0x5851F42D4C957F2D


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """Fewest bands of ``rows`` values with which a pair at the threshold meets with the target recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def ngrams(found: Words, rows: int, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes by row, as hashes sorted inside each row and the rows' bounds."""
    hashes, of = windows(found, n)
    size = np.bincount(found.row, minlength=rows)
    for few in range(1, n):  # texts shorter than an n-gram
        at = np.flatnonzero(size[found.row] == few) if len(found.row) else np.zeros(0, int)
        if len(at):
            short, home = windows(Words(found.hash[at], found.row[at], found.start[at], found.end[at]), few)
            hashes, of = np.concatenate([hashes, short]), np.concatenate([of, home])
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[new], of[new]
    return hashes, np.searchsorted(of, np.arange(rows + 1))


def _signatures(hashes: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint (two longs) and band hashes of each non-empty set."""
    starts = bounds[:-1]
    print_ = np.stack([np.add.reduceat(mixed(hashes ^ np.uint64(k)), starts) for k in (1, 2)], axis=1)
    out = np.empty((len(starts), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(starts), mixed(np.array([band + 1], np.uint64))[0], np.uint64)
        for row in range(rows):
            seed = mixed(np.array([SEED + band * rows + row], np.uint64))[0]
            # Odd multiplier, then the high bits folded in: one cheap permutation per signature value.
            value = (hashes ^ seed) * (seed | np.uint64(1))
            value ^= value >> np.uint64(32)
            low = np.minimum.reduceat(value, starts)
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + low)
        out[:, band] = key
    return print_, out


def signed(docs: DataFrame, bands: int, rows: int = ROWS) -> DataFrame:
    """(``id``, ``fp`` struct, ``n``, ``bands``) per document; ``fp`` is null without n-grams."""
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(docs.schema["id"].dataType)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                count = block.last - block.first
                hashes, bounds = ngrams(words(block), count)
                size = np.diff(bounds)
                some = np.flatnonzero(size)
                a, b = np.zeros(count, np.int64), np.zeros(count, np.int64)
                keys, ends = np.zeros(0, np.int64), np.zeros(count + 1, np.int32)
                if len(some):
                    print_, out = _signatures(hashes, np.append(bounds[some], len(hashes)), bands, rows)
                    a[some], b[some] = print_.view(np.int64).T
                    keys = out.view(np.int64).ravel()
                    ends[1:] = np.cumsum((size > 0) * bands)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(block.first, count).cast(id_type), pa.array(a), pa.array(b),
                    pa.array(size.astype(np.int64)), pa.ListArray.from_arrays(ends, keys),
                ], names=["id", "a", "b", "n", "bands"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(sign, f"id {kind}, a long, b long, n long, bands array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """(``a``, ``b``, ``grams``) per document."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                count = block.last - block.first
                hashes, bounds = ngrams(words(block), count)
                some = np.flatnonzero(np.diff(bounds))
                if not len(some):
                    continue
                starts = bounds[some]
                a, b = (np.add.reduceat(mixed(hashes ^ np.uint64(k)), starts).view(np.int64) for k in (1, 2))
                yield pa.RecordBatch.from_arrays([
                    pa.array(a), pa.array(b),
                    pa.ListArray.from_arrays(np.append(starts, len(hashes)).astype(np.int32), pa.array(hashes.view(np.int64))),
                ], names=["a", "b", "grams"])

    return docs.select("text").mapInArrow(make, "a long, b long, grams array<long>")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets (sorted arrays of distinct values)."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])
    every = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    order = np.argsort(every, kind="stable")
    every, row = every[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    often = np.diff(np.append(first, len(every)))
    # Values in one set only intersect nothing; the others are columns of two 0/1 matrices, taken in slices.
    column = np.repeat(np.cumsum(often > 1) - 1, often)
    keep = np.repeat(often > 1, often)
    row, column = row[keep], column[keep]
    out = np.zeros((len(left), len(right)), np.float32)
    step = max(256, (1 << 22) // (len(left) + len(right)))
    edges = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + step, step))
    for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        x = np.zeros((len(left) + len(right), step), np.float32)
        x[row[lo:hi], column[lo:hi] - k * step] = 1
        out += x[:len(left)] @ x[len(left):].T
    return out.astype(np.int64)


def _forest(pairs: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Edges (smallest member of the component, member) for all linked members."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        old = label.copy()
        np.minimum.at(label, pairs[:, 0], low)
        np.minimum.at(label, pairs[:, 1], low)
        label = label[label]
        if (label == old).all():
            break
    return [(int(label[v]), int(v)) for v in np.flatnonzero(label != np.arange(size))]


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[list]]:
    """Rows of each run of equal ``task``, however batches cut it."""
    held: list | None = None
    for batch in batches:
        values = [batch.column(c).to_pylist() if c not in ("grams", "bands") else batch.column(c) for c in columns]
        task = batch.column("task").to_pylist()
        for i, t in enumerate(task):
            row = [v[i] if isinstance(v, list) else v[i].values.to_numpy() for v in values]
            if held is None or held[0] != t:
                if held is not None:
                    yield held[1]
                held = (t, [])
            held[1].append(row)
    if held is not None:
        yield held[1]


def _verify(threshold: float, bands: int):
    """Members of each task -> their link counts and forest edges (a null other end is a count)."""
    columns = ["task", "band", "side", "a", "b", "n", "copies", "bands", "grams"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for members in _groups(batches, columns):
            band = members[0][1]
            left = [m for m in members if m[2] in (0, 1)]
            right = [m for m in members if m[2] == 2]
            alone = not right  # one block with itself
            if alone:
                right = left
            if len(left) < 2 and alone or not left:
                continue
            common = overlaps([m[8] for m in left], [m[8] for m in right])
            n1, n2 = np.array([m[5] for m in left]), np.array([m[5] for m in right])
            linked = common >= threshold * (n1[:, None] + n2[None, :] - common) - 1e-9
            if alone:
                linked = np.triu(linked, 1)
            # Count a pair only where it first meets.
            if band and linked.any():
                k1 = np.array([m[7][:band] for m in left])
                k2 = np.array([m[7][:band] for m in right])
                for at in range(band):
                    linked &= k1[:, at, None] != k2[None, :, at]
            pairs = np.argwhere(linked)
            if not len(pairs):
                continue
            if not alone:
                pairs = pairs + [0, len(left)]
            both = left if alone else [*left, *right]
            copies = np.array([m[6] for m in both])
            links = np.zeros(len(both), np.int64)
            np.add.at(links, pairs[:, 0], copies[pairs[:, 1]])
            np.add.at(links, pairs[:, 1], copies[pairs[:, 0]])
            out.extend((both[v][3], both[v][4], int(links[v]), None, None) for v in np.flatnonzero(links))
            out.extend((both[u][3], both[u][4], 0, both[v][3], both[v][4]) for u, v in _forest(pairs, len(both)))
            if len(out) > 20_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*rows)], names=["a", "b", "links", "a2", "b2"])

    return run


def star_groups(edges: DataFrame) -> DataFrame:
    """(``v``, ``root``) for all ends of the edges (``u``, ``v``): alternating large and small stars.

    ``u`` and ``v`` are comparable (here structs); every step shuffles edges only, and smallest neighbours are
    found by an aggregation that combines before the shuffle.
    """
    def star(edges, large):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        around = both.join(low, "u")
        if large:
            out = around.where("v > u").select(F.col("low").alias("u"), "v")
        else:
            out = around.where("v < u").select(F.col("low").alias("u"), "v").union(
                low.select(F.col("low").alias("u"), F.col("u").alias("v")))
        return stored(out.where("u != v").distinct(), "stars")

    def state(edges):
        # Equal edge sets have equal counts and equal sums of hashes.
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    edges, last = star(star(edges, True), False), None
    while (now := state(edges)) != last:
        edges, last = star(star(edges, True), False), now
    return edges.select("v", F.col("u").alias("root"))


def near_groups(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(``id``, ``rep_id``, ``class_id``, ``n_grams``, ``n_links``) per row of ``docs`` (``id``, ``text``)."""
    bands = choose_bands(threshold, recall)
    rows = stored(signed(docs, bands), "signed")
    classes = stored(
        rows.where("n > 0").groupBy("a", "b").agg(F.min("id").alias("rep_id"), F.count("*").alias("copies")), "classes")
    # One row per class and band; equal sets have equal bands, so distinct rows are pre-combined.
    keys = rows.where("n > 0").select("a", "b", F.posexplode("bands").alias("band", "key")).distinct()
    mark = F.xxhash64("a", "b").cast("decimal(20,0)")
    buckets = (
        keys.groupBy("band", "key").agg(F.count("*").alias("m"), F.sum(mark).alias("marks")).where("m > 1")
        # The same members meet in several bands: the first one is enough.
        .groupBy("m", "marks").agg(F.min(F.struct("band", "key")).alias("k"))
        .select("m", "k.band", "k.key")
    )
    members = stored(keys.join(buckets, ["band", "key"]).select("a", "b", "band", "key", "m"), "members")
    asked = members.select("a", "b").distinct().join(classes, ["a", "b"]).select("a", "b", "rep_id", "copies")
    asked = stored(asked, "asked")
    ids = asked.select(F.col("rep_id").alias("id")).distinct()
    sets = _sets(docs.join(ids, docs["id"].eqNullSafe(ids["id"]), "left_semi")).join(asked, ["a", "b"]).dropDuplicates(["a", "b"])
    signs = rows.where("n > 0").select("a", "b", "n", "bands").join(asked.select("a", "b"), ["a", "b"], "left_semi").dropDuplicates(["a", "b"])
    # Large buckets: blocks by hash; every two blocks meet in one task.
    blocks_of = F.ceil(F.col("m") / BLOCK_MEMBERS).cast("int")
    own = F.pmod(F.xxhash64("a", "b", "band"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = (
        members.withColumn("blocks", blocks_of).withColumn("own", own).withColumn("other", other)
        .select(
            "a", "b", "band",
            F.xxhash64("band", "key", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
            F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
        )
    )
    loaded = (
        tasks.join(sets.join(signs, ["a", "b"]), ["a", "b"])
        .select("task", "band", "side", "a", "b", "n", "copies", "bands", "grams")
        .repartition("task").sortWithinPartitions("task")
    )
    found = stored(
        loaded.mapInArrow(_verify(threshold, bands), "a long, b long, links long, a2 long, b2 long"), "links")
    links = found.where("a2 IS NULL").groupBy("a", "b").agg(F.sum("links").alias("links"))
    forest = found.where("a2 IS NOT NULL").select(F.struct("a", "b").alias("u"), F.struct(F.col("a2").alias("a"), F.col("b2").alias("b")).alias("v"))
    groups = star_groups(forest).select("v.a", "v.b", "root")
    in_group = (
        classes.join(groups, ["a", "b"], "left")
        .select("a", "b", "rep_id", "copies", F.coalesce("root", F.struct("a", "b")).alias("root"))
    )
    smallest = in_group.groupBy("root").agg(F.min("rep_id").alias("class_id"))
    facts = in_group.join(smallest, "root").join(links, ["a", "b"], "left").select(
        "a", "b", "rep_id", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    some = rows.where("n > 0").join(facts, ["a", "b"]).select("id", "rep_id", "class_id", F.col("n").alias("n_grams"), "n_links")
    none = rows.where("n = 0").select("id", F.col("id").alias("rep_id"), F.col("id").alias("class_id"), F.col("n").alias("n_grams"), F.lit(0).cast("long").alias("n_links"))
    return some.union(none)


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group, with all columns of ``docs``; different documents without n-grams all stay."""
    key = F.xxhash64("doc_id", "text")
    # Groups of row keys: rows of one key are equal documents, so one of them stays.
    packed = docs.select(F.struct(*keeping(docs)).alias("row"), "doc_id", "text", key.alias("key"))
    lead = near_groups(packed.select(F.struct("doc_id", "key").alias("id"), "text"))
    stay = lead.where("id = class_id").select(F.col("id.key").alias("stays")).distinct()
    # Whole rows are shuffled once: the join leaves them by key, as the last step needs them.
    return packed.select("row", "key").join(stay, F.col("key") == F.col("stays"), "left_semi").dropDuplicates(["key"]).select("row.*")


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class and number of links of every document."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return near_groups(docs).select(F.col("id").alias("doc_id"), "class_id", "n_links", "rep_id", "n_grams")
