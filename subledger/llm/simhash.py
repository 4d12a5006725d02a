"""SimHash near-duplicate groups by the generalised pigeonhole principle.

1. Every whole text becomes a 64-bit fingerprint: ASCII letters are lower-cased, words are runs without ASCII white space,
   and each three-word shingle (repeats included; a text of one or two words is one shingle) gives the XXH64 of its words
   joined by one space. A bit is set if it is set in over half of the hashes. Documents with equal fingerprints are one
   entry from there on, so copies cost nothing.
2. The 64 bits are cut into partitions. Bits that go together over all fingerprints come into the same partition: what
   they share then makes one partition less selective instead of all of them.
3. Two fingerprints within ``distance`` bits are, for any thresholds of the partitions with ``sum(t + 1) = distance + 1``,
   within ``t`` bits in one partition. Every fingerprint gets its own thresholds by dynamic programming over the estimated
   number of candidates in each partition (a threshold of -1 leaves a partition out). The estimates come from counts of the
   halves of each partition's values over all fingerprints.
4. Each fingerprint stands in the index under its value in every partition, and probes all values within its threshold.
   Index and probes are shuffled by partition and value; values with many of them are cut into blocks, and every index
   block meets every probe block in a task of its own. Candidates are verified on all 64 bits there, and a task answers
   with the edges of a spanning forest, never with all linked pairs.
5. Forest edges are joined into groups by alternating large and small stars.

No candidate is dropped, so every link is found. Verification compares each value's index with its probes, which grows with
the square of the number of *different* fingerprints that share a value.

Results: one row per row of the input with ``fingerprint`` (long) and ``component_id``, the smallest id reachable over links.
Null and empty texts have fingerprint zero and are linked like any other. Ids may be null: a component of null ids only has
a null ``component_id``. Repeated rows are copies. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from subledger.llm.common import stored, table
from subledger.llm.text import utf8

BITS = 64
WORDS = 3
SEED = 42
DISTANCE = 3
# Index or probe rows of one value that a task compares at once; beyond, they are cut into blocks.
BLOCK = 2048
# Rows of whole values that a task takes together, and pairs it compares at once.
TOGETHER, PAIRS = 1 << 15, 1 << 22
# Fingerprints a value may share by chance alone before partitions are made wider.
BY_CHANCE = 64
# What a probe costs, in compared candidates.
PROBE_COST = 8.0
# Tasks among which the edges of one centre are dealt.
SALTS = 16


def fingerprint(text: bytes) -> int:
    """SimHash of a text's three-word shingles."""
    found = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not found:
        return 0
    joined, size = b" ".join(found), np.array([len(w) for w in found])
    end = np.cumsum(size + 1) - 1
    n = min(WORDS, len(found))
    hashed = xxhash.xxh64_intdigest
    values = [hashed(joined[a:b], SEED) for a, b in zip((end - size).tolist(), end[n - 1:].tolist())]
    # Bytes of each hash, lowest first, to one column per bit.
    bits = np.unpackbits(np.array(values, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(values)
    return int(np.packbits(over, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(``id``, ``fp``) per row of ``docs`` (``id``, ``text``)."""
    id_type = to_arrow_type(docs.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8(batch.column("text"))
            raw = data.tobytes()
            found = np.array([fingerprint(raw[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(id_type), pa.array(found.view(np.int64))], names=["id", "fp"])

    return docs.select("id", "text").mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, fp long")


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(rows: DataFrame, counted) -> np.ndarray:
    """Sums of the equally long arrays that ``counted`` makes of each batch of fingerprints."""
    def run(batches):
        total = 0
        for batch in batches:
            total = total + counted(batch.column("fp").to_numpy(zero_copy_only=False))
        if not isinstance(total, int):
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["at", "n"])

    sums = rows.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(counted(np.zeros(0, np.int64))), np.int64)
    out[sums["at"].to_numpy()] = sums["n"].to_numpy()
    return out


def group_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """The bits of each partition: grown from the closest pair by the bit that goes best with those it has.

    ``together[i, j]`` counts fingerprints with both bits set.
    """
    ones = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(ones * (1 - ones), 1e-12))
    close = np.abs(together / max(n, 1) - np.outer(ones, ones)) / np.outer(spread, spread)
    np.fill_diagonal(close, 0)
    left, out = list(range(BITS)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        mine = [left[int(np.argmax(close[np.ix_(left, left)].max(axis=1)))]]
        while len(mine) < width:
            rest = [b for b in left if b not in mine]
            mine.append(rest[int(np.argmax(close[np.ix_(rest, mine)].sum(axis=1)))])
        out.append(sorted(mine))
        left = [b for b in left if b not in mine]
    return out


def choose_parts(n: int, distance: int = DISTANCE) -> int:
    """The most partitions, at most one more than the distance, of which one value is shared by few of ``n`` by chance."""
    most = distance + 1
    return next((p for p in range(most, 1, -1) if n <= BY_CHANCE << (BITS // p)), 2)


class Plan:
    """Partitions, their estimated candidates, and the thresholds of any fingerprint."""

    def __init__(self, parts: list[list[int]], distance: int):
        self.parts, self.distance = parts, distance
        # The halves of each partition, as runs of its bits.
        self.halves = [(p[:len(p) // 2], p[len(p) // 2:]) for p in parts]
        self.sizes = [1 << len(h) for pair in self.halves for h in pair]
        self.near: list[np.ndarray] = []
        # Bit masks within each threshold of a partition's own value.
        self.masks = [self._masks(len(p)) for p in parts]

    def _masks(self, width: int) -> list[np.ndarray]:
        rings, bits = [np.zeros(1, np.int64)], np.int64(1) << np.arange(width, dtype=np.int64)
        for _ in range(self.distance):
            last = np.unique((rings[-1][:, None] | bits).ravel())
            rings.append(last[np.bitwise_count(last) == len(rings)])
        return [np.concatenate(rings[:t + 1]) for t in range(self.distance + 1)]

    def value(self, bits: np.ndarray, chosen: list[int]) -> np.ndarray:
        """The chosen bits of each fingerprint as a number."""
        return bits[:, chosen].astype(np.int64) @ (np.int64(1) << np.arange(len(chosen), dtype=np.int64))

    def halves_counted(self, fps: np.ndarray) -> np.ndarray:
        """How often each half of each partition has each value, one after the other."""
        bits = _bits(fps)
        flat = [h for pair in self.halves for h in pair]
        return np.concatenate([np.bincount(self.value(bits, h), minlength=s) for h, s in zip(flat, self.sizes)])

    def learn(self, counted: np.ndarray, n: int) -> Plan:
        """Takes the counts of all fingerprints: how many lie at each distance of each half's value."""
        starts = np.concatenate([[0], np.cumsum(self.sizes)])
        for k, size in enumerate(self.sizes):
            # at[d, v]: share of fingerprints whose half differs from v in d bits, one bit of the half after the other.
            at = np.zeros((self.distance + 1, size))
            at[0] = counted[starts[k]:starts[k + 1]] / max(n, 1)
            for bit in range(size.bit_length() - 1):
                flipped = at[:, np.arange(size) ^ (1 << bit)]
                at[1:] += flipped[:-1]
            self.near.append(at)
        self.n = n
        return self

    def thresholds(self, bits: np.ndarray) -> np.ndarray:
        """Threshold of each partition (-1: none) for each fingerprint: the cheapest that find every link."""
        budget = self.distance + 1
        best = np.full((budget + 1, len(bits)), np.inf)
        best[0], choice = 0, []
        for k, (a, b) in enumerate(self.halves):
            left, right = self.near[2 * k][:, self.value(bits, a)], self.near[2 * k + 1][:, self.value(bits, b)]
            ring = np.array([sum(left[j] * right[d - j] for j in range(d + 1)) for d in range(budget)])
            cost = np.cumsum(ring, axis=0) * self.n + PROBE_COST * np.array([[len(m)] for m in self.masks[k]])
            cost = np.concatenate([np.zeros((1, len(bits))), cost])
            step = np.array([[best[s - g] + cost[g] if g <= s else np.full(len(bits), np.inf) for g in range(budget + 1)]
                             for s in range(budget + 1)])
            choice.append(step.argmin(axis=1))
            best = step.min(axis=1)
        out, spent = np.empty((len(bits), len(self.parts)), np.int64), np.full(len(bits), budget)
        for k in range(len(self.parts) - 1, -1, -1):
            given = choice[k][spent, np.arange(len(bits))]
            out[:, k] = given - 1
            spent = spent - given
        return out


def make_plan(prints: DataFrame, n: int, distance: int = DISTANCE, parts: int | None = None) -> Plan:
    """Partitions and estimates from all distinct fingerprints (``fp``)."""
    def pairs(fps):
        bits = _bits(fps).astype(np.float64)
        return (bits.T @ bits).astype(np.int64).ravel()

    together = _summed(prints, pairs).reshape(BITS, BITS)
    plan = Plan(group_bits(together, n, parts or choose_parts(n, distance)), distance)
    return plan.learn(_summed(prints, plan.halves_counted), n)


INDEX, PROBE = 1, 2


def _entries(plan: Plan):
    """Fingerprints -> (``key``, ``fp``, ``role``) of their index entries and probes."""
    def run(batches):
        for batch in batches:
            every = batch.column("fp").to_numpy(zero_copy_only=False)
            for lo in range(0, len(every), 8192):
                fps = every[lo:lo + 8192]
                bits = _bits(fps)
                chosen = plan.thresholds(bits)
                keys, whose, roles = [], [], []
                for k, part in enumerate(plan.parts):
                    # The partition's number stands above its value.
                    own, t = plan.value(bits, part) | np.int64(k) << np.int64(48), chosen[:, k]
                    keys.append(own)
                    whose.append(fps)
                    roles.append(np.where(t >= 0, INDEX | PROBE, INDEX))
                    for threshold in range(1, plan.distance + 1):
                        at = np.flatnonzero(t == threshold)
                        more = plan.masks[k][threshold][1:]
                        keys.append((own[at, None] ^ more).ravel())
                        whose.append(np.repeat(fps[at], len(more)))
                        roles.append(np.full(len(at) * len(more), PROBE))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(whose)), pa.array(np.concatenate(roles).astype(np.int32))],
                    names=["key", "fp", "role"])

    return run


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (smallest member, other member) that join the same members as the edges given."""
    names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[:len(u)], ends[len(u):]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[a], label[b])
        old = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, old[a], low)  # the whole group of an end moves with it
        np.minimum.at(label, old[b], low)
        label = label[label]
        if (label == old).all():
            break
    other = np.flatnonzero(label != np.arange(len(names)))
    return names[label[other]], names[other]


def _links(distance: int):
    """Rows sorted by unit -> forest edges of the fingerprints linked inside each unit."""
    def compare(unit, fp, role):
        order = np.argsort(unit, kind="stable")
        unit, fp, role = unit[order], fp[order], role[order]
        index, probe = np.flatnonzero(role & INDEX), np.flatnonzero(role & PROBE)
        # Index rows of each probe's unit.
        low, high = np.searchsorted(unit[index], unit[probe], "left"), np.searchsorted(unit[index], unit[probe], "right")
        size = high - low
        before = np.concatenate([[0], np.cumsum(size)])
        at = 0
        while at < len(probe):
            to = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS, "right")) - 1)
            many = size[at:to]
            left = np.repeat(fp[probe[at:to]], many)
            right = fp[index[np.repeat(low[at:to] - (before[at:to] - before[at]), many) + np.arange(many.sum())]]
            linked = (np.bitwise_count((left ^ right).view(np.uint64)) <= distance) & (left != right)
            if linked.any():
                yield forest(left[linked], right[linked])
            at = to

    def run(batches):
        held: list[tuple] = []
        rows = 0

        def flush(last: bool):
            nonlocal held, rows
            unit, fp, role = (np.concatenate(c) for c in zip(*held))
            # The last unit may go on in the next batch.
            cut = len(unit) if last else int(np.flatnonzero(unit == unit[-1])[0])
            held, rows = ([(unit[cut:], fp[cut:], role[cut:])], 0) if cut < len(unit) else ([], 0)
            found = list(compare(unit[:cut], fp[:cut], role[:cut])) if cut else []
            if found:
                u, v = forest(*(np.concatenate(c) for c in zip(*found)))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("unit", "fp", "role")))
            rows += batch.num_rows
            if rows > TOGETHER:
                yield from flush(False)
        if held:
            yield from flush(True)

    return run


def link_forest(prints: DataFrame, plan: Plan) -> DataFrame:
    """(``u``, ``v``): edges that join all distinct fingerprints within the plan's distance of each other."""
    entries = stored(prints.select("fp").mapInArrow(_entries(plan), "key long, fp long, role int"), "entries")
    is_index, is_probe = F.col("role").bitwiseAND(INDEX), F.col("role").bitwiseAND(PROBE) / PROBE
    cut = lambda n: F.ceil(n / BLOCK).cast("int")
    # Values that need several blocks; all others are one unit.
    large = stored(
        entries.groupBy("key").agg(F.sum(is_index).alias("i"), F.sum(is_probe).alias("p"))
        .where(f"greatest(i, p) > {BLOCK} AND i > 0 AND p > 0")
        .select("key", cut(F.col("i")).alias("index_blocks"), cut(F.col("p")).alias("probe_blocks")), "large")
    small = entries.join(large, "key", "left_anti").select(F.xxhash64("key").alias("unit"), "fp", "role")
    own = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cut_up = entries.join(large, "key")
    index = cut_up.where(is_index == 1).select("key", own("index_blocks").alias("a"), each("probe_blocks").alias("b"), "fp", F.lit(INDEX).alias("role"))
    probe = cut_up.where(is_probe == 1).select("key", each("index_blocks").alias("a"), own("probe_blocks").alias("b"), "fp", F.lit(PROBE).alias("role"))
    blocks = index.union(probe).select(F.xxhash64("key", "a", "b").alias("unit"), "fp", "role")
    units = small.union(blocks).repartition("unit").sortWithinPartitions("unit")
    return stored(units.mapInArrow(_links(plan.distance), "u long, v long"), "edges")


def components(edges: DataFrame) -> DataFrame:
    """(``v``, ``root``) for all ends of the edges (``u``, ``v``) but the roots: alternating large and small stars.

    A centre's edges are dealt among ``SALTS`` tasks; smallest neighbours are combined before their shuffle.
    """
    salt = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int").alias("salt")

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("low", "u").alias("low"))
        dealt = low.select("u", "low", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        # Not to be broadcast: the copies are more than Spark's estimate of the file tells.
        around = both.select("u", "v", salt).join(dealt.hint("merge"), ["u", "salt"])
        if large:
            out = around.where("v > u").select(F.col("low").alias("u"), "v")
        else:
            out = around.where("v < u").select(F.col("low").alias("u"), "v").union(low.select(F.col("low").alias("u"), F.col("u").alias("v")))
        return stored(out.where("u != v").distinct(), "stars")

    def state(edges: DataFrame):
        # Equal edge sets have equal counts and equal sums of hashes.
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    edges, last = star(star(edges, True), False), None
    while (now := state(edges)) != last:
        edges, last = star(star(edges, True), False), now
    return edges.select("v", F.col("u").alias("root"))


def simhash_groups(docs: DataFrame, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """(``id``, ``fp``, ``component_id``) per row of ``docs`` (``id``, ``text``)."""
    rows = stored(fingerprints(docs), "prints")
    prints = stored(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct")
    n = prints.count()
    groups = components(link_forest(prints, make_plan(prints, n, distance, parts)))
    rooted = prints.join(groups, F.col("fp") == F.col("v"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    # A table of its own: both sides of the join are then shuffled for it, and Spark may split a large component.
    smallest = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    facts = stored(rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id"), "facts")
    return rows.join(facts, "fp").select("id", "fp", "component_id")


def op13_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return simhash_groups(docs).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
