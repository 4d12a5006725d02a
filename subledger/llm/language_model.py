"""Language-model scoring with a weighted backoff automaton.

Training. All tokens of the training rows are counted, words by a 64-bit hash, and every text ends in an end token.
The states of the automaton are all words and all bigrams that occur ``LEAST`` times or more, and its arcs lead by
words, and by bigrams and trigrams that occur as often, at any size of the input: the model grows with it. An arc
carries a discounted probability; what a state's arcs leave goes to its failure arc, whose weight makes the state's
probabilities sum to one. At the bottom stand all words, with their add-one-tenth probability.

Scoring. Each text is traversed once from left to right, carrying a state: the next token follows the state's arc,
or the failure arc (adding its weight) to the next shorter state, down to the words.

Where the work lies. Rows are packed into blocks of ``BLOCK`` bytes of text. A block counts its distinct n-grams and
sends their keys, sorted and packed, to ranges of keys; a range adds the counts of all blocks up and answers with one
number for each key, in the same order, so that keys do not travel back. The answer names one block as the owner of
each n-gram: this one sends the n-gram's share in its context's sums, by the same way, and the ranges answer with the
weights of failure arcs. Then every block holds the part of the automaton that its own texts can reach, and no more.
A key comes once from each block, whatever its frequency, so no key is hot; a task holds one block or one range.

Null and empty texts are the end token alone. Every row is scored on its own and trains as often as it occurs; a null
id is ``''`` for the split of the query. An empty table gives no rows; without training tokens every word has the
probability of an unseen one. N-grams are known by 61-bit hashes and their length. A single enormous text is a block
of its own. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import release, stored, table
from subledger.llm.text import Words, blocks, mixed, words

# Occurrences that make a bigram or trigram an arc.
LEAST = 2
DISCOUNT = 0.7
ADD = 0.1
ORDERS = 3
# Bytes of text of a block, and of all texts for each range of keys.
BLOCK = 8 << 20
RANGE = 4 << 20
# Parts, by key, in which counts are exchanged one after another, a power of two: bounds what is shuffled at a time.
SLICES = 2
# Steps per unit in which sums of probabilities and weights of failure arcs travel: sums do not depend on their order.
SUM_STEPS = 2.0 ** 32
WEIGHT_STEPS = 2.0 ** 28
# Tasks of a stage that works on blocks or ranges, beyond the session's own number.
TASKS = 1 << 13
# Fixed value: stands for the end of a text.
END = np.uint64(0xE17D0FE17D0FE17D)
NONE = -1
# Weight of an arc that does not exist; log10 probabilities are not above zero.
NO_ARC = 1.0
# What a failure arc shares out at least.
LITTLE = 1e-9

PACKED = "block long, size long, body binary"
PARTS = "range long, block long, n long, keys binary, first binary, second binary"


class Grams(NamedTuple):
    """The n-grams of a block."""

    row: np.ndarray   # text of each token
    keys: np.ndarray  # of all distinct n-grams, sorted; their order is in the low bits
    at: list          # per order: place in ``keys`` of the n-gram that ends at each token, or NONE


class Automaton(NamedTuple):
    """Per n-gram of a block: count, weight of the arc it is, weight of the failure arc of the state it makes."""

    count: np.ndarray
    weight: np.ndarray
    fail: np.ndarray


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of texts with their rows, each text ending in the end token."""
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for block in blocks(texts):
        found: Words = words(block, lower=True)
        size = block.last - block.first
        row = np.concatenate([found.row, np.arange(size)])
        order = np.argsort(row, kind="stable")
        hashes.append(np.concatenate([found.hash, np.full(size, END)])[order])
        rows.append(row[order] + block.first)
    return np.concatenate(hashes), np.concatenate(rows)


def order_of(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(1)) & np.uint64(3)).astype(np.int64)


def keys_of(hashes: np.ndarray, row: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-grams of one order, with an empty lowest bit, and the token at which each ends."""
    count = max(len(hashes) - order + 1, 0)
    total = np.zeros(count, np.uint64)
    for k in range(order):
        total = mixed(total + hashes[k:k + count])
    first = np.flatnonzero(row[:count] == row[order - 1:])
    return (total[first] & ~np.uint64(7)) | np.uint64(order << 1), first + order - 1


def counts_of(hashes: np.ndarray, row: np.ndarray, trains: np.ndarray, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of a part, and how often each occurs in texts that train."""
    found = []
    for order in range(1, ORDERS + 1):
        keys, end = keys_of(hashes, row, order)
        own = part_of(keys, parts) == part
        found.append(keys[own] | trains[row[end[own]]].astype(np.uint64))
    found = np.sort(np.concatenate(found))
    keys = found & ~np.uint64(1)
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat((found & np.uint64(1)).astype(np.int64), starts) if len(keys) else starts


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The range, of so many equal ones, in which a key lies."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def sorting(keys: np.ndarray) -> np.ndarray:
    """Order of the keys, equal ones by place: high bits with the place in the low ones, unless these bits tie."""
    bits = np.uint64(max(len(keys) - 1, 1).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    order = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    found = keys[order]
    return order if (found[1:] >= found[:-1]).all() else np.argsort(keys, kind="stable")


def grams(hashes: np.ndarray, row: np.ndarray) -> Grams:
    """All n-grams up to ``ORDERS`` words; none crosses from one text into the next."""
    found, ends = zip(*(keys_of(hashes, row, order) for order in range(1, ORDERS + 1)))
    found = np.concatenate(found)
    order = sorting(found)
    keys = found[order]
    new = np.append(True, keys[1:] != keys[:-1])[:len(keys)]
    which = np.empty(len(keys), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    at, first = [], 0
    for end in ends:
        place = np.full(len(hashes), NONE, np.int32)
        place[end] = which[first:first + len(end)]
        at.append(place)
        first += len(end)
    return Grams(row, keys[new], at)


def pack(values: np.ndarray) -> bytes:
    """Eight-byte values, byte by byte and compressed: sorted keys as differences, small numbers to next to nothing."""
    if values.dtype == np.uint64:
        values = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(body: bytes, n: int, kind: type) -> np.ndarray:
    """The ``n`` values of :func:`pack`."""
    planes = np.frombuffer(pa.decompress(body, decompressed_size=8 * n, codec="zstd"), np.uint8).reshape(8, n)
    values = np.ascontiguousarray(planes.T).view(kind).reshape(n)
    return np.cumsum(values, dtype=np.uint64) if kind is np.uint64 else values


def _packed(docs: DataFrame) -> DataFrame:
    """Blocks of whole rows (``id``, ``text``, ``trains``), one row each, stored: no row changes its block later."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, TaskContext.get().partitionId() << 32

        def packed():
            sink = pa.BufferOutputStream()
            rows = pa.Table.from_batches(held)
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
                out.write_table(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([size]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "size", "body"])

        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "text", "trains")], names=["id", "text", "trains"])
            before = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64) + 8)
            first = 0
            while first < batch.num_rows:
                taken = before[first - 1] if first else 0
                last = max(int(np.searchsorted(before, taken + BLOCK - size, "right")), first if held else first + 1)
                if last > first:
                    held.append(batch.slice(first, last - first))
                    size += int(before[last - 1] - taken)
                if last < batch.num_rows:
                    yield packed()
                    held, size, number = [], 0, number + 1
                first = last
        if held:
            yield packed()

    return stored(docs.select("id", "text", "trains").mapInArrow(run, PACKED), "blocks", numeric=True)


def _rows(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all().combine_chunks()


def _parts(block: int, keys: np.ndarray, ranges: int, *values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted keys with their values, cut by ranges of keys."""
    if not len(keys):
        return
    part = part_of(keys, ranges)
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    columns: list[list] = [[] for _ in range(3)]
    for a, e in zip(first.tolist(), np.append(first[1:], len(keys)).tolist()):
        for column, c in zip(columns, (keys, *values)):
            column.append(pack(c[a:e]))
    bodies = [pa.array(c or [None] * len(first), pa.binary()) for c in columns]
    yield pa.RecordBatch.from_arrays([
        pa.array(part[first].astype(np.int64)), pa.array(np.full(len(first), block)),
        pa.array(np.diff(np.append(first, len(keys)))), *bodies], names=["range", "block", "n", "keys", "first", "second"])


def _grouped(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[list[dict]]:
    """Rows, sorted by a column, one list for each of its values."""
    held: list[dict] = []
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
            if held and held[0][by] != row[by]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _tasks(spark: SparkSession, n: int) -> int:
    return min(max(n, 1), max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS))


def _answers(requests: DataFrame, ranges: int, names: list[str], kinds: tuple, answer: Callable) -> DataFrame:
    """(``block``, ``range``, ``n``, ``body``, and sums ``names`` of a range) for the requests, in the order of their keys.

    ``answer`` takes the values of a range's keys, sorted by key and block, and where each key begins.
    """
    schema = ", ".join(["block long, range long, n long, body binary", *(f"{name} long" for name in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "range"):
            sizes = [r["n"] for r in rows]
            keys = np.concatenate([unpack(r["keys"], r["n"], np.uint64) for r in rows])
            values = [np.concatenate([unpack(r[c], r["n"], kind) for r in rows]) for c, kind in zip(("first", "second"), kinds)]
            order = sorting(keys)
            keys = keys[order]
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            told, sums = answer(keys, starts, *(v[order] for v in values))
            back = np.empty_like(told)
            back[order] = told
            ends = np.cumsum(sizes)
            bodies = [pack(back[e - n:e]) for e, n in zip(ends.tolist(), sizes)]
            yield pa.RecordBatch.from_arrays([
                pa.array([r["block"] for r in rows], pa.int64()), pa.array([r["range"] for r in rows], pa.int64()),
                pa.array(sizes, pa.int64()), pa.array(bodies, pa.binary()),
                *(pa.array([s] + [0] * (len(rows) - 1), pa.int64()) for s in sums)],
                names=["block", "range", "n", "body", *names])

    dealt = requests.repartition(_tasks(requests.sparkSession, ranges), "range").sortWithinPartitions("range", "block")
    return stored(dealt.mapInArrow(run, schema), "answers", numeric=True)


def _total(keys: np.ndarray, starts: np.ndarray, counts: np.ndarray):
    """Twice the count of each kept n-gram, and one more for its owner; words and different words of the range."""
    total = np.add.reduceat(counts, starts)
    order = order_of(keys[starts])
    word = order == 1
    kept = np.where(word | (total >= LEAST), total, 0)
    told = 2 * np.repeat(kept, np.diff(np.append(starts, len(keys))))
    told[starts] += kept > 0
    return told, (int(total[word].sum()), int((total[word] > 0).sum()))


def _failing(keys: np.ndarray, starts: np.ndarray, arcs: np.ndarray, shorter: np.ndarray):
    """Weights of failure arcs: what the arcs leave, over what they would have had one order down."""
    left = np.maximum(1 - np.add.reduceat(arcs, starts) / SUM_STEPS, LITTLE)
    room = np.maximum(1 - np.add.reduceat(shorter, starts) / SUM_STEPS, LITTLE)
    weight = np.rint(np.log10(left / room) * WEIGHT_STEPS).astype(np.int64)
    return np.repeat(weight, np.diff(np.append(starts, len(keys)))), ()


def arcs_of(found: Grams, count: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of each n-gram as an arc (0: none), of its last word one order down, and place of its context."""
    order = order_of(found.keys)
    some = np.zeros(len(found.keys), np.int64)  # a token at which it ends
    for at in found.at:
        here = np.flatnonzero(at >= 0)
        some[at[here]] = here
    p, shorter, context = np.zeros(len(some)), np.zeros(len(some)), np.full(len(some), NONE)
    p[order == 1] = (count[order == 1] + ADD) / floor
    for k in range(2, ORDERS + 1):
        kept = np.flatnonzero((order == k) & (count > 0))
        context[kept] = found.at[k - 2][some[kept] - 1]
        p[kept] = (count[kept] - DISCOUNT) / count[context[kept]]
        shorter[kept] = p[found.at[k - 2][some[kept]]]
    return p, shorter, context


def context_sums(found: Grams, count: np.ndarray, own: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """For each n-gram as a context, what the block's ``own`` arcs have, and what they would have one order down."""
    p, shorter, context = arcs_of(found, count, floor)
    own = own & (context >= 0)
    return tuple(np.rint(np.bincount(context[own], c[own], len(count)) * SUM_STEPS).astype(np.int64) for c in (p, shorter))


def automaton(found: Grams, count: np.ndarray, fail: np.ndarray, floor: float) -> Automaton:
    """The part of the automaton that the block's texts can reach; ``fail`` in steps."""
    p, _, _ = arcs_of(found, count, floor)
    return Automaton(count, np.log10(p, out=np.full(len(p), NO_ARC), where=p > 0), fail / WEIGHT_STEPS)


def traverse(found: Grams, model: Automaton) -> np.ndarray:
    """Log10 probability of each text: one pass from left to right that carries the state."""
    if not len(found.row):
        return np.zeros(0)
    rows = int(found.row[-1]) + 1
    bounds = np.searchsorted(found.row, np.arange(rows + 1)).tolist()
    word, two, three = (np.where(at >= 0, model.weight[at], NO_ARC) for at in found.at)
    # The failure arcs of the states that end one token before; a text begins at the words.
    from_one, from_two = (np.append(0.0, np.where(at >= 0, model.fail[at], 0.0)[:-1]) for at in found.at[:2])
    from_one[bounds[:-1]] = 0.0
    lowest = from_one + word
    scores = np.zeros(rows)
    for text, (a, e) in enumerate(zip(bounds, bounds[1:])):
        longest, score = False, 0.0  # whether the state is a bigram
        for three_arc, two_arc, fail, word_arc in zip(*(c[a:e].tolist() for c in (three, two, from_two, lowest))):
            if longest:
                if three_arc <= 0:
                    score += three_arc
                    continue
                score += fail
            longest = two_arc <= 0
            score += two_arc if longest else word_arc
        scores[text] = score
    return scores


def _aligned(rows: list[dict], kind: str) -> np.ndarray:
    """The answers of one kind to a block, in the order of its keys."""
    parts = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["range"])
    return np.concatenate([np.zeros(0, np.int64), *(unpack(r["body"], r["n"], np.int64) for r in parts)])


def scored(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """(``id``, ``n_tokens``, ``n_known``, ``base_score``, ``score``) per row of ``docs`` (``id``, ``text``, ``trains``).

    The model is learnt from the rows that train; also returned are its tokens and different words.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    spark = docs.sparkSession
    id_type, kind = to_arrow_type(docs.schema["id"].dataType), docs.schema["id"].dataType.simpleString()
    packed = _packed(docs)
    n_blocks, size = packed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(SLICES * max(1, -(-size // (SLICES * RANGE))), 1 << 30)  # no range lies in two slices

    def counted(part: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _grouped(batches, "block"):
                docs_ = _rows(rows[0]["body"])
                keys, count = counts_of(*tokens(docs_.column("text")), docs_.column("trains").to_numpy(), part, SLICES)
                yield from _parts(rows[0]["block"], keys, ranges, count)

        found = _answers(packed.mapInArrow(run, PARTS), ranges, ["tokens", "words"], (np.int64,), _total)
        release(spark)
        return found

    def by_block(*answers: tuple[str, DataFrame]) -> DataFrame:
        """Each block's texts and answers, together."""
        rows = packed.select("block", F.lit("").alias("kind"), F.lit(0).cast("long").alias("range"), F.lit(0).cast("long").alias("n"), "body")
        for label, answer in answers:
            rows = rows.unionAll(answer.select("block", F.lit(label).alias("kind"), "range", "n", "body"))
        return rows.repartition(_tasks(spark, n_blocks), "block").sortWithinPartitions("block", "kind", "range")

    totals = reduce(DataFrame.unionAll, [counted(part) for part in range(SLICES)])
    total, distinct = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    floor = float(total + ADD * (distinct + 1))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "block"):
            found = grams(*tokens(_rows(rows[0]["body"]).column("text")))
            told = _aligned(rows, "totals")
            count = told >> 1
            state = (count > 0) & (order_of(found.keys) < ORDERS)
            sums = context_sums(found, count, (told & 1) > 0, floor)
            yield from _parts(rows[0]["block"], found.keys[state], ranges, *(c[state] for c in sums))

    fails = _answers(by_block(("totals", totals)).mapInArrow(summed, PARTS), ranges, [], (np.int64, np.int64), _failing)
    release(spark)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "block"):
            docs_ = _rows(rows[0]["body"])
            found = grams(*tokens(docs_.column("text")))
            count = _aligned(rows, "totals") >> 1
            fail = np.zeros(len(count), np.int64)
            fail[(count > 0) & (order_of(found.keys) < ORDERS)] = _aligned(rows, "fails")
            model = automaton(found, count, fail, floor)
            word, n = found.at[0], docs_.num_rows
            yield pa.RecordBatch.from_arrays([
                docs_.column("id").combine_chunks().cast(id_type), pa.array(np.bincount(found.row, minlength=n)),
                pa.array(np.bincount(found.row[count[word] > 0], minlength=n)),
                pa.array(np.bincount(found.row, model.weight[word], n)), pa.array(traverse(found, model)),
            ], names=["id", "n_tokens", "n_known", "base_score", "score"])

    rows = by_block(("totals", totals), ("fails", fails)).mapInArrow(
        walked, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return rows, total, distinct


def op9_backoff_automaton(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a model of the training ones."""
    out = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))) % 10 == 0
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    rows, total, _ = scored(docs.withColumn("trains", ~out))
    return rows.select(
        F.col("id").alias("doc_id"), out.alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
