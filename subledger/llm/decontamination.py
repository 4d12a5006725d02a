"""Benchmark decontamination through a distributed positional inverted index.

Training texts are indexed shard by shard: a shard holds whole documents of about eight megabytes and, for
each term, the sorted positions at which it stands. A test phrase is looked up from its rarest term (by counts
over all training texts): the positions of the next rarest one, shifted by its place in the phrase, are
intersected with what is left, until all terms agree (exact phrase) or stand within ``slop`` places of where
they should (proximity match). Index and search are spread over the shards; the test set is read in blocks of
bounded size, so it may grow as well.

Phrases are the windows of ten consecutive words of an item; an item of fewer words, but not none, is one
phrase. Null and empty texts have no words: such documents have no hit, such items no phrase. Equal items and
repeated documents are treated each on its own; a null ``item_id`` hits words but is not listed. Empty tables
give no hits or no rows. Other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.llm.common import keeping, stored, table
from subledger.llm.text import ALPHANUMERIC, Block, blocks, counts, utf8, words

WINDOW = 10
# Free places between documents of a shard: no phrase, however loose, reaches over.
GAP = 64
SLOP = 2
SHARD_BYTES = 8 << 20
# Bytes of test items that one pass over the index looks up.
TEST_BYTES = 4 << 20

MATCHES = "shard string, place int, spans array<struct<first:int,last:int>>, items array<string>, near array<string>"


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None) -> DataFrame:
    """One row per shard: its documents, and the postings of all terms (or of those in ``vocabulary``).

    ``docs`` has ``id`` and ``text``. Positions count the words of a shard, with a gap after each document.
    """
    wanted = None if vocabulary is None else np.sort(vocabulary)

    def pack(ids, parts):
        lengths = np.concatenate([p[0] for p in parts])
        base = np.concatenate([[0], np.cumsum(lengths + GAP)])
        terms, at, rows_before, words_before = [], [], 0, 0
        for sizes, hashes, rows, places in parts:
            terms.append(hashes)
            at.append(base[rows + rows_before] + places)
            rows_before += len(sizes)
        terms, at = np.concatenate(terms), np.concatenate(at)
        order = np.lexsort((at, terms))
        terms, at = terms[order], at[order]
        first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, int)
        return pa.RecordBatch.from_arrays([
            pa.array([uuid.uuid4().hex]), pa.array([list(ids)]).cast(pa.list_(id_type)), pa.array([lengths.tolist()], pa.list_(pa.int32())),
            pa.ListArray.from_arrays([0, len(first)], pa.array(terms[first].view(np.int64))),
            pa.ListArray.from_arrays([0, len(first)], pa.array(np.diff(np.append(first, len(terms))).astype(np.int32))),
            pa.ListArray.from_arrays([0, len(at)], pa.array(at.astype(np.int32))),
        ], names=["shard", "ids", "lengths", "terms", "sizes", "positions"])

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(docs.schema["id"].dataType)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("id")
            for block in blocks(texts):
                if held and held + len(block.data) > SHARD_BYTES:
                    yield pack(ids, parts)
                    ids, parts, held = [], [], 0
                found = words(block, ALPHANUMERIC, lower=True)
                sizes = counts(found, block.last - block.first)
                places = np.arange(len(found.hash)) - np.concatenate([[0], np.cumsum(sizes)])[found.row]
                hashes, rows = found.hash, found.row
                if wanted is not None:
                    known = _place(wanted, hashes) >= 0
                    hashes, rows, places = hashes[known], rows[known], places[known]
                ids.extend(keys.slice(block.first, block.last - block.first).to_pylist())
                parts.append((sizes, hashes, rows, places))
                held += len(block.data)
        if parts:
            yield pack(ids, parts)

    schema = T.StructType([
        T.StructField("shard", T.StringType()), T.StructField("ids", T.ArrayType(docs.schema["id"].dataType)),
        T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("terms", T.ArrayType(T.LongType())),
        T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("positions", T.ArrayType(T.IntegerType())),
    ])
    return stored(docs.select("id", "text").mapInArrow(index, schema), "index")


def _place(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted value stands among the sorted ones; -1 if it does not."""
    if not len(sorted_values):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return np.where(sorted_values[at] == wanted, at, -1)


def phrases(items: list[tuple[str | None, str | None]], window: int = WINDOW):
    """Distinct phrases (rows of term numbers, padded by -1), the terms' hashes, and the items of each phrase."""
    data, bounds = utf8(pa.array([text for _, text in items], pa.string()))
    found = words(Block(0, len(items), data, bounds), ALPHANUMERIC, lower=True)
    terms, number = np.unique(found.hash, return_inverse=True)
    rows, owners = [], []
    for item, size in enumerate(counts(found, len(items))):
        first = int(np.searchsorted(found.row, item))
        for at in range(first, first + max(size - window, 0) + 1) if size else ():
            row = number[at:min(at + window, first + size)]
            rows.append(np.pad(row, (0, window - len(row)), constant_values=-1))
            owners.append(item)
    if not rows:
        return np.zeros((0, window), np.int64), terms, []
    distinct, which = np.unique(np.array(rows), axis=0, return_inverse=True)
    of: list[set] = [set() for _ in distinct]
    for phrase, item in zip(which.ravel(), owners):
        of[phrase].add(item)
    return distinct, terms, [sorted(s) for s in of]


def _agree(lists, left: np.ndarray, offset: int, slop: int) -> np.ndarray:
    """Phrase starts of ``left`` for which the list has a position within ``slop`` of the offset."""
    target = left + offset
    at = np.searchsorted(lists, target - slop)
    inside = at < len(lists)
    inside[inside] = lists[at[inside]] <= target[inside] + slop
    return left[inside]


def search(index: DataFrame, items: list[tuple[str | None, str | None]], frequency: dict[int, int],
           slop: int = SLOP) -> DataFrame:
    """Documents with matches: word spans of exact phrases, items with one, items with one nearby."""
    table_, terms, owners = phrases(items)
    often = np.array([frequency.get(int(h), 0) for h in terms.view(np.int64)] + [np.iinfo(np.int64).max])
    order = np.argsort(often[table_], axis=1, kind="stable")  # rarest first, padding last
    length = (table_ >= 0).sum(axis=1)
    names = [item for item, _ in items]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = {n: batch.column(n)[row] for n in ("shard", "lengths", "terms", "sizes", "positions")}
                lengths, hashes, sizes, positions = (
                    own[n].values.to_numpy(zero_copy_only=False) for n in ("lengths", "terms", "sizes", "positions"))
                base = np.concatenate([[0], np.cumsum(lengths.astype(np.int64) + GAP)])
                ends = np.cumsum(sizes)
                at = _place(hashes.view(np.uint64), terms)
                have = np.append(at >= 0, True)
                edge = np.zeros(base[-1] + 1, np.int64)
                hits: dict[int, tuple[set, set]] = {}
                for phrase in np.flatnonzero(have[table_].all(axis=1)):
                    for tolerance in (0, slop) if slop else (0,):
                        left = None
                        for place in order[phrase, :length[phrase]]:
                            term = at[table_[phrase, place]]
                            lists = positions[ends[term] - sizes[term]:ends[term]]
                            left = lists - place if left is None else _agree(lists, left, place, tolerance)
                            if not len(left):
                                break
                        if not len(left):
                            continue
                        if not tolerance:
                            np.add.at(edge, left, 1)
                            np.add.at(edge, left + length[phrase], -1)
                        for doc in np.unique(np.searchsorted(base, left + tolerance, "right") - 1).tolist():
                            hits.setdefault(doc, (set(), set()))[1 if tolerance else 0].update(owners[phrase])
                if not hits:
                    continue
                covered = np.concatenate([[0], np.cumsum(edge) > 0, [0]]).astype(np.int8)
                starts, stops = np.flatnonzero(np.diff(covered) == 1), np.flatnonzero(np.diff(covered) == -1)
                home = np.searchsorted(base, starts, "right") - 1
                spans: dict[int, list] = {}
                for doc, s, e in zip(home.tolist(), starts.tolist(), stops.tolist()):
                    spans.setdefault(doc, []).append({"first": s - int(base[doc]), "last": e - 1 - int(base[doc])})
                yield pa.RecordBatch.from_pylist([
                    {"shard": own["shard"].as_py(), "place": doc, "spans": spans.get(doc, []),
                     "items": sorted({names[i] for i in exact if names[i] is not None}),
                     "near": sorted({names[i] for i in near if names[i] is not None})}
                    for doc, (exact, near) in sorted(hits.items())
                ], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(T.StructType.fromDDL(MATCHES))
    return index.mapInArrow(look, MATCHES)


def contamination(docs: DataFrame, tests: DataFrame, slop: int = SLOP) -> DataFrame:
    """One row per document (``id``, ``text``) against all tests (``item_id``, ``text``).

    ``n_words``, hit ``spans`` (word positions, disjoint), ``n_hit``, ``items`` with exact phrases, ``near``
    items with a loose one.
    """
    spark = docs.sparkSession
    # A repeated row changes neither hits nor items, and would only fill a block.
    tests = stored(tests.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct(), "tests")
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // TEST_BYTES))
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    index, found = None, None
    for part in range(parts):
        items = [(r.item_id, r.text) for r in tests.where(block_of == part).collect()]  # TEST_BYTES, about
        asked = phrases(items)[1]
        if index is None:
            # A single block needs the postings of its own terms only.
            index = build_index(docs, asked if parts == 1 else None)
        asked = asked.view(np.int64)
        listed = spark.createDataFrame([(int(h),) for h in asked], "term long")
        frequency = {
            r.term: r.n for r in
            index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("p"))
            .groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.sizes").alias("n"))
            .join(listed, "term", "left_semi").collect()  # as many rows as the block has terms
        }
        part = search(index, items, frequency, slop)
        found = part if found is None else found.union(part)
    merged = found.groupBy("shard", "place").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
    )
    zero = F.struct(F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("spans", zero, lambda acc, s: F.struct(
        F.greatest(acc["end"], s["last"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(acc["end"], s["first"] - 1))).alias("n")))["n"]
    everyone = index.select("shard", F.posexplode(F.arrays_zip("ids", "lengths")).alias("place", "d"))
    return everyone.join(merged, ["shard", "place"], "left").select(
        F.col("d.ids").alias("id"), F.col("d.lengths").cast("long").alias("n_words"), "spans",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("near", F.array().cast("array<string>")).alias("near"),
    )


def decontaminated(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns."""
    packed = docs.select(F.struct(*keeping(docs)).alias("row"), "doc_id", "text")
    key = F.xxhash64("doc_id", "text")
    # Rows of one key are the same document, so their verdict is the same.
    hit = contamination(packed.select(key.alias("id"), "text"), tests, slop=0).where("n_hit > 0").select("id").distinct()
    return packed.join(hit, key == F.col("id"), "left_anti").select("row.*")


def op10_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    """Hits of benchmark phrases in every document."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    found = contamination(docs, table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
    )
