"""Exact repeated substrings across documents: suffix arrays per shard, Kasai prefixes, merged windows.

Every byte is found that a 50-byte string covers which also starts in a document with a smaller id.

1. *Anchors.* A 50-byte window is known by the smallest hash among its 16-byte strings, so equal windows have the
   same anchor wherever they stand. Only anchors that occur in two documents or more can hold a repeat; all others
   are left out, which loses nothing. Windows in a row with one anchor make up a *context*.
2. *Shards.* Contexts are dealt out by anchor, equal ones once per block of texts, with the smallest and largest id
   they have. Each shard sorts all their suffixes, anchor by anchor, by Larsson-Sadakane refinement (groups that are not
   yet single are split by the rank that lies twice as far on), and Kasai's walk gives the prefix that each window shares
   with its predecessor; runs of 50 bytes or more are one class, owned by its smallest id.
3. *Merging.* An anchor with very many contexts is cut over several shards. Their classes, as sorted runs of window
   digests, are merged by digest; binary search finds each class's place in the merged run and so its owner.
4. *Spans.* Owners go back to all places of a context, and a document loses the windows owned by a smaller id.

Null and empty texts have no bytes. Documents with a null id are smaller or larger than none: they lose nothing and
own nothing. Rows with equal ids do not take from each other; repeated rows get equal results; an empty table gives
no rows. Other columns are not looked at. Hashes of contexts and windows have 64 and 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import FEW, release, stored, table
from subledger.llm.text import Block, blocks, equal_span_hash, mixed, prefix_sums, span_hash

WINDOW = 50
ANCHOR = 16
# Windows of one context; longer runs are cut, which is free as every window lies in one context only.
RUN = 64
SHARD_BYTES = 2 << 20
# Contexts of one anchor that a shard takes before the anchor is cut over several shards: at up to RUN + WINDOW - 1 bytes each,
# they fit into one shard.
LIMIT = 16384
# Windows whose anchors are looked for at a time, so that the arrays stay in a core's cache.
STRETCH = 16384


def anchor_runs(block: Block, window: int = WINDOW, anchor: int = ANCHOR):
    """Anchor hash, row, first byte and number of windows of each context of a block, and its prefix sums."""
    data, bounds = block.data, block.bounds
    sums = prefix_sums(data)
    whole = len(data) - window + 1
    if whole <= 0:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none, sums
    reach = window - anchor + 1
    low = np.empty(whole, np.uint64)
    for at in range(0, whole, STRETCH):
        some = min(STRETCH, whole - at)
        part, size = equal_span_hash(sums, at, at + some + reach - 1, anchor), 1
        while size * 2 <= reach:  # smallest of the next 2, 4, 8, ...
            part = np.minimum(part[:-size], part[size:])
            size *= 2
        np.minimum(part[:some], part[reach - size:reach - size + some], out=low[at:at + some])
    # Windows that begin in the last bytes of a text would go beyond it: they make up runs of their own, left out below.
    beyond = np.maximum(bounds[:-1], bounds[1:] - window + 1)
    new = np.ones(whole, bool)
    np.not_equal(low[1:], low[:-1], out=new[1:])
    for edge in (bounds, beyond):
        new[edge[edge < whole]] = True
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, whole))
    row = np.searchsorted(bounds[1:], start, "right")
    inside = start < beyond[row]
    start, count, row = start[inside], count[inside], row[inside]
    pieces = -(-count // RUN)
    if (pieces > 1).any():
        which = np.repeat(np.arange(len(start)), pieces)
        step = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start, count, row = start[which] + step * RUN, np.minimum(count[which] - step * RUN, RUN), row[which]
    return low[start], row, start, count, sums


def suffix_array(data: np.ndarray, bounds: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes of all contexts in order, and each one's place; equal suffixes stand in order of position.

    With a ``group`` of each context (numbers from 0, ascending), the suffixes of a group stand together, group by group.
    """
    n = len(data)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    at = np.arange(n)
    # The first sort looks at as many leading bytes as fit beside the group: each as its place among the bytes in use, from 1,
    # so that an end comes before any byte.
    used = np.bincount(data, minlength=256) > 0
    bits = int(used.sum()).bit_length() or 1
    apart = 0 if group is None or not len(group) else int(group[-1]).bit_length()
    depth = 1
    key = np.cumsum(used).astype(np.uint64)[data]
    while more := min(depth, (64 - apart) // bits - depth):
        longer = key << np.uint64(more * bits)
        longer[:-depth] |= key[depth:] >> np.uint64((depth - more) * bits)
        key, depth = longer, depth + more
    for left in range(1, depth):  # what stands behind the end of a context
        short = bounds[1:][np.diff(bounds) >= left] - left
        key[short] &= ~np.uint64((1 << (depth - left) * bits) - 1)
    if apart:
        key |= np.repeat(group.astype(np.uint64) << np.uint64(64 - apart), np.diff(bounds))
    order = np.argsort(key)
    rank = np.empty(n, np.int64)

    def number(places, keys):
        """Group numbers (place of the group's first) for sorted keys at these places; the places not yet single."""
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        group = np.cumsum(new) - 1
        firsts = places[np.flatnonzero(new)]
        rank[order[places]] = firsts[group]
        return places[(np.bincount(group) > 1)[group]]

    open_ = number(at, key[order])
    while len(open_):
        suffix = order[open_]
        beyond = suffix + depth
        # Those that have ended are equal, and come first, by position.
        second = np.where(beyond < ends[suffix], n + rank[np.minimum(beyond, n - 1)], suffix)
        keys = (rank[suffix].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        sorted_ = np.argsort(keys)
        order[open_] = suffix[sorted_]
        open_ = number(open_, keys[sorted_])
        depth *= 2
    return order, rank


def kasai(data: np.ndarray, bounds: np.ndarray, order: np.ndarray, rank: np.ndarray, counts: np.ndarray,
          window: int = WINDOW, first: np.ndarray | None = None) -> np.ndarray:
    """Prefix (up to ``window``) that each window shares with the suffix before it in order.

    The walk along one context starts where its last step ended, less one byte; all contexts walk side by side.
    ``first`` is the place of the first suffix of each context's group, which shares nothing with the one before it.
    """
    ends = np.repeat(bounds[1:], np.diff(bounds))
    out = np.zeros(len(data), np.int64)
    by_count = np.argsort(-counts, kind="stable")
    starts, sizes = bounds[:-1][by_count], counts[by_count]
    first = np.zeros(len(starts), np.int64) if first is None else first[by_count]
    length = np.zeros(len(starts), np.int64)
    for step in range(int(counts.max(initial=0))):
        some = int(np.searchsorted(-sizes, -step, "left"))
        i = starts[:some] + step
        place = rank[i]
        p = order[np.maximum(place - 1, 0)]
        known = np.maximum(length[:some] - 1, 0)
        alone = place == first[:some]
        known[alone] = 0
        going = np.flatnonzero(~alone & (known < window))
        while len(going):
            x, y = i[going] + known[going], p[going] + known[going]
            fits = (x < ends[i[going]]) & (y < ends[p[going]])
            x, y, going = x[fits], y[fits], going[fits]
            going = going[data[x] == data[y]]
            known[going] += 1
            going = going[known[going] < window]
        out[i] = length[:some] = known
    return out


def window_classes(data: np.ndarray, bounds: np.ndarray, window: int = WINDOW,
                   group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, context and class of every window; equal windows of a group (see :func:`suffix_array`) have one class."""
    counts = np.diff(bounds) - window + 1
    order, rank = suffix_array(data, bounds, group)
    # The suffixes of a group take the places that its contexts take in the data.
    first = None if group is None else bounds[np.searchsorted(group, group)]
    shared = kasai(data, bounds, order, rank, counts, window, first)
    of = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[:-1][of]
    by_rank = np.argsort(rank[at])
    classes = np.empty(len(at), np.int64)
    classes[by_rank] = np.cumsum(shared[at[by_rank]] < window) - 1
    return at, of, classes - classes.min(initial=0)


SEEN_ALONE, SEEN_TWICE, SETTLED = 0, 1, 2


def _marks(docs: DataFrame) -> DataFrame:
    """(``h``, ``key``, ``id``, ``state``): the anchors of each document, combined over a batch of documents.

    An anchor that two ids of the batch have is known to be shared: its documents are SETTLED, and one row tells the
    other batches that it was SEEN_TWICE. So a very common anchor sends one row per batch, however many have it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
            hashes, rows = [], []
            for block in blocks(batch.column("text")):
                value, row, *_ = anchor_runs(block)
                hashes.append(value)
                rows.append(row + block.first)
            if not hashes:
                continue
            value, row = np.concatenate(hashes), np.concatenate(rows)
            order = np.argsort(value)
            value, row = value[order], row[order]
            if not len(value):
                continue
            first = np.append(True, value[1:] != value[:-1])
            # Where several rows have an anchor, in order of the row; each row once.
            alike = np.cumsum(first) - 1
            some = np.flatnonzero(~first | ~np.append(first[1:], True))
            row[some] = row[some][np.argsort(alike[some] * batch.num_rows + row[some])]
            new = first | np.append(True, row[1:] != row[:-1])
            value, row = value[new], row[new]
            starts = np.flatnonzero(first[new])
            id_ = ids[row]
            twice = np.minimum.reduceat(id_, starts) < np.maximum.reduceat(id_, starts)
            state = np.where(np.repeat(twice, np.diff(np.append(starts, len(value)))), SETTLED, SEEN_ALONE)
            told = value[starts[twice]]
            # By document, so that its key and id compress.
            order = np.argsort(row, kind="stable")
            value, row, id_, state = value[order], row[order], id_[order], state[order]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([value, told]).view(np.int64)),
                pa.array(np.concatenate([keys[row], np.zeros(len(told), np.int64)])),
                pa.array(np.concatenate([id_, np.zeros(len(told), np.int64)])),
                pa.array(np.concatenate([state, np.full(len(told), SEEN_TWICE)]).astype(np.int8)),
            ], names=["h", "key", "id", "state"])

    return docs.select("text", "id", "key").mapInArrow(run, "h long, key long, id long, state byte")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of :func:`_marks`, sorted by ``h`` -> (``key``, ``h``) of shared anchors.

    Only the rows of an anchor that one id has so far are held over to the next batch.
    """
    def out(h, key):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(h)], names=["key", "h"])

    none = np.zeros(0, np.int64)
    held = (none, none, none)
    known: int | None = None
    for batch in batches:
        h, key, id_, state = (batch.column(n).to_numpy() for n in ("h", "key", "id", "state"))
        settled = state == SETTLED
        if settled.any():
            yield out(h[settled], key[settled])
            h, key, id_, state = (x[~settled] for x in (h, key, id_, state))
        h, key, id_ = (np.concatenate(p) for p in zip(held, (h, key, id_)))
        twice = np.concatenate([np.zeros(len(held[0]), bool), state == SEEN_TWICE])
        held = (none, none, none)
        if not len(h):
            continue
        starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        sizes = np.diff(np.append(starts, len(h)))
        alone = ~twice
        low = np.minimum.reduceat(np.where(alone, id_, np.iinfo(np.int64).max), starts)
        high = np.maximum.reduceat(np.where(alone, id_, np.iinfo(np.int64).min), starts)
        yes = np.logical_or.reduceat(twice, starts) | (low < high)
        if known is not None and h[0] == known:
            yes[0] = True
        use = np.repeat(yes, sizes) & alone
        yield out(h[use], key[use])
        known = int(h[-1]) if yes[-1] else None
        if not yes[-1]:
            held = (h[starts[-1]:], key[starts[-1]:], id_[starts[-1]:])


def _contexts(docs: DataFrame) -> DataFrame:
    """Places of the contexts whose anchors the document shares (``hs``); the bytes once per block of texts.

    ``h`` is the lower half of the anchor's hash: it only deals contexts out, and where two anchors have the same, bytes decide.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
            lists = batch.column("hs")
            ends = lists.offsets.to_numpy().astype(np.int64)
            ends = ends - ends[0]
            shared = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends)).astype(np.uint64)
            shared = mixed(shared + owner * np.uint64(0x9E3779B97F4A7C15))
            for block in blocks(batch.column("text")):
                value, row, at, count, sums = anchor_runs(block)
                row = row + block.first
                pairs = np.sort(shared[ends[block.first]:ends[block.last]])
                asked = mixed(value + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                place = np.minimum(np.searchsorted(pairs, asked), max(len(pairs) - 1, 0))
                hit = pairs[place] == asked if len(pairs) else np.zeros(len(asked), bool)
                value, row, at, count = value[hit], row[hit], at[hit], count[hit]
                if not len(value):
                    continue
                end = at + count + WINDOW - 1
                content = span_hash(sums, at, end).view(np.int64)
                distinct, first, which = np.unique(content, return_index=True, return_inverse=True)
                low, high = np.full(len(distinct), np.iinfo(np.int64).max), np.full(len(distinct), np.iinfo(np.int64).min)
                np.minimum.at(low, which, ids[row])
                np.maximum.at(high, which, ids[row])
                text = block.data.tobytes()
                chosen = np.zeros(len(value), bool)
                chosen[first] = True
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.where(chosen, value.astype(np.uint32).view(np.int32), np.int32(0))), pa.array(content),
                    pa.array([text[a:e] if c else None for a, e, c in zip(at.tolist(), end.tolist(), chosen.tolist())], pa.binary()),
                    pa.array(np.where(chosen, low[which], 0)), pa.array(np.where(chosen, high[which], 0)),
                    pa.array(keys[row]), pa.array(ids[row]), pa.array((at - block.bounds[row - block.first]).astype(np.int32)),
                ], names=["h", "c", "bytes", "low", "high", "key", "id", "pos"])

    return docs.select("text", "id", "key", "hs").mapInArrow(
        run, "h int, c long, bytes binary, low long, high long, key long, id long, pos int")


FOUND = "c long, first int, last int, owner long, high long, shard long, class int, d1 long, d2 long"


FOUND_SHAPE = pa.schema([
    (name, {"long": pa.int64(), "int": pa.int32()}[kind]) for name, kind in (c.split() for c in FOUND.split(", "))])
RESULT = "id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"
RESULT_SHAPE = pa.schema([
    ("id", pa.int64()), ("n_bytes", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary())])


def _shard_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by shard -> owners of their windows, in runs.

    Of an anchor cut over several shards: one row per class with its digest, and one per window with its class.
    """
    shape = FOUND_SHAPE
    held: list[pa.RecordBatch] = []
    names = ["h", "salt", "c", "parts", "low", "high"]

    def combined(tables) -> pa.RecordBatch:
        """One row per context."""
        all_ = pa.Table.from_batches(tables).combine_chunks().to_batches()[0]
        h, salt, c = (all_.column(n).to_numpy() for n in ("h", "salt", "c"))
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (h[1:] != h[:-1])
        starts = np.flatnonzero(new)
        low = np.minimum.reduceat(all_.column("low").to_numpy(), starts)
        high = np.maximum.reduceat(all_.column("high").to_numpy(), starts)
        one = all_.take(pa.array(starts))
        return pa.RecordBatch.from_arrays(
            [one.column("h"), one.column("salt"), one.column("c"), one.column("parts"), pa.array(low), pa.array(high), one.column("bytes")],
            names=[*names, "bytes"])

    def solved(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        h, salt, c, parts, low, high = (batch.column(n).to_numpy() for n in names)
        data, bounds = binary(batch.column("bytes"))
        group = np.cumsum(np.append(False, h[1:] != h[:-1]))[:len(h)]
        at, of, classes = window_classes(data, bounds, WINDOW, group)
        owner = np.full(classes.max(initial=-1) + 1, np.iinfo(np.int64).max)
        np.minimum.at(owner, classes, low[of])
        place = (at - bounds[of]).astype(np.int32)
        split = parts[of] > 1
        own = owner[classes]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (own[1:] != own[:-1])
        starts = np.flatnonzero(new)
        stops = np.append(starts[1:], len(of)) - 1
        use = (own[starts] < high[of[starts]]) & ~split[starts]
        starts, stops = starts[use], stops[use]
        yield rows(c[of[starts]], place[starts], place[stops], own[starts], high[of[starts]])
        if split.any():
            # Windows of one class have one anchor, so a class lies in one cut anchor or in none.
            # The shard is named by its first context, which is in no other one.
            shard = mixed(mixed(h[:1].astype(np.int64).view(np.uint64)) + c[:1].view(np.uint64)).view(np.int64)
            cls, some = np.unique(classes[split], return_index=True)
            w = np.flatnonzero(split)[some]
            sums = prefix_sums(data)
            d1 = span_hash(sums, at[w], at[w] + WINDOW)
            half = WINDOW // 2
            d2 = mixed(span_hash(sums, at[w], at[w] + half) + np.uint64(3) * span_hash(sums, at[w] + half, at[w] + WINDOW))
            yield rows(None, None, None, owner[cls], None, np.repeat(shard, len(w)), cls, d1.view(np.int64), d2.view(np.int64), n=len(w))
            w = np.flatnonzero(split)
            yield rows(c[of[w]], place[w], place[w], None, high[of[w]], np.repeat(shard, len(w)), classes[w])

    def rows(*columns, n=None):
        n = len(columns[0]) if n is None else n
        columns = [*columns, *[None] * (len(shape) - len(columns))]
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, f.type) if v is None else pa.array(v).cast(f.type) for v, f in zip(columns, shape)], schema=shape)

    size = 0
    for batch in batches:
        # One schema for rows that come in and rows that were combined.
        batch = pa.RecordBatch.from_arrays([batch.column(n) for n in (*names, "bytes")], names=[*names, "bytes"])
        while batch.num_rows:
            weight = batch.column("bytes").nbytes
            if size + weight < SHARD_BYTES:
                held.append(batch)
                size += weight
                break
            # Cut at the last change of shard; a shard that goes on is combined and waits.
            h, salt = (batch.column(n).to_numpy() for n in ("h", "salt"))
            change = np.flatnonzero((h[1:] != h[:-1]) | (salt[1:] != salt[:-1])) + 1
            begins = held and (held[-1].column("h")[-1].as_py(), held[-1].column("salt")[-1].as_py()) != (int(h[0]), int(salt[0]))
            if begins:
                change = np.append(0, change)
            # The first change at which the shard is full, or the last one there is.
            full = np.searchsorted(change * (weight / batch.num_rows) + size, SHARD_BYTES)
            if not len(change):
                held = [combined([*held, batch])]
                size = held[0].column("bytes").nbytes
                break
            cut = int(change[min(full, len(change) - 1)])
            if cut:
                held.append(batch.slice(0, cut))
            yield from solved(combined(held))
            held, size, batch = [], 0, batch.slice(cut)
            if weight < SHARD_BYTES and batch.num_rows:
                batch = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in batch.columns], schema=batch.schema)
    if held:
        yield from solved(combined(held))


def binary(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a binary column without nulls."""
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    bounds = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class rows sorted by digest -> (``shard``, ``class``, ``owner``) with the smallest owner of the digest."""
    def solved(batch):
        d1, d2, owner = (batch.column(n).to_numpy() for n in ("d1", "d2", "owner"))
        new = np.ones(len(d1), bool)
        new[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
        starts = np.flatnonzero(new)
        low = np.minimum.reduceat(owner, starts)
        # Each row's place among the merged run's distinct digests.
        at = np.searchsorted(starts, np.arange(len(d1)), "right") - 1
        return pa.RecordBatch.from_arrays(
            [batch.column("shard"), batch.column("class"), pa.array(low[at])], names=["shard", "class", "owner"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        d1, d2 = (batch.column(n).to_numpy() for n in ("d1", "d2"))
        last = int(np.searchsorted(d1, d1[-1]))  # all rows of the last digest may go on in the next batch
        if last or held and held[-1].column("d1")[-1].as_py() != int(d1[-1]):
            held.append(batch.slice(0, last))
            yield solved(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
            held = []
        held.append(batch.slice(last))
    if held:
        yield solved(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(``key``, ``spans``) of the documents (``id``, ``text``, ``key``) that lose bytes."""
    spark = docs.sparkSession
    docs = docs.where(F.col("id").isNotNull() & (F.octet_length("text") >= WINDOW))
    # Settled rows wait for nobody: they go by document, the others by anchor.
    place = F.when(F.col("state") == SETTLED, F.col("key")).otherwise(F.col("h"))
    shared = (
        _marks(docs).repartition(place).sortWithinPartitions("h").mapInArrow(_shared, "key long, h long")
    )
    lists = stored(shared.groupBy("key").agg(F.collect_list("h").alias("hs")), "lists", numeric=True)
    release(spark)
    places = stored(_contexts(docs.join(lists, "key")), "contexts", codec="zstd")
    release(spark)
    contexts = places.where("bytes IS NOT NULL").select("h", "c", "bytes", "low", "high")
    # Stored, so that its size is known when the join is planned.
    hot = stored(
        contexts.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > LIMIT)
        .select(F.col("h").alias("hot"), F.ceil(F.col("n") / LIMIT).cast("int").alias("n_parts")),
        "hot", FEW,
    )
    parts = F.coalesce("n_parts", F.lit(1))
    dealt = (
        contexts.join(hot, F.col("h") == F.col("hot"), "left")
        .select("h", F.pmod("c", parts).cast("int").alias("salt"), "c", parts.alias("parts"), "low", "high", "bytes")
        .repartition("h", "salt").sortWithinPartitions("h", "salt", "c")
    )
    found = stored(dealt.mapInArrow(_shard_classes, FOUND), "classes", numeric=True)
    release(spark)
    cut = (
        found.where("d1 IS NOT NULL").select("d1", "d2", "owner", "shard", "class")
        .repartition("d1").sortWithinPartitions("d1", "d2").mapInArrow(_merged, "shard long, class int, owner long")
    )
    windows = found.where("d1 IS NULL AND shard IS NOT NULL").drop("owner").join(cut, ["shard", "class"]).where("owner < high")
    owners = (
        found.where("shard IS NULL").select("c", "first", "last", "owner")
        .union(windows.select("c", "first", "last", "owner"))
    )
    spans = (
        places.select("c", "key", "id", "pos").join(owners, "c").where("owner < id")
        .select("key", F.struct((F.col("pos") + F.col("first")).alias("start"),
                                (F.col("pos") + F.col("last") + WINDOW).alias("end")).alias("span"))
        .groupBy("key").agg(F.collect_list("span").alias("spans"))
    )
    return stored(spans, "spans", numeric=True)


def without_repeats(docs: DataFrame) -> DataFrame:
    """(``id``, ``n_bytes``, ``spans`` (maximal, in order), ``kept`` bytes) per row of ``docs`` (``id``, ``text``)."""
    docs = docs.select("id", "text", F.xxhash64("id", "text").alias("key"))
    lost = repeated_spans(docs)
    release(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("id"), pc.fill_null(batch.column("spans"), [])
            for block in blocks(batch.column("text")):
                data, bounds, rows = block.data, block.bounds, block.last - block.first
                some = lists.slice(block.first, rows)
                pairs = some.flatten()
                base = np.repeat(bounds[:-1], some.value_lengths().to_numpy())
                edge = np.bincount(base + pairs.field("start").to_numpy(), minlength=len(data) + 1)
                edge -= np.bincount(base + pairs.field("end").to_numpy(), minlength=len(data) + 1)
                gone = np.cumsum(edge[:-1]) > 0
                # Each text begins and ends its own runs.
                before, after = np.append(False, gone)[:len(data)], np.append(gone, False)[1:]
                inner = bounds[(bounds > 0) & (bounds < len(data))]
                before[inner] = after[inner - 1] = False
                start, end = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
                row = np.searchsorted(bounds[1:], start, "right")
                spans = pa.StructArray.from_arrays(
                    [pa.array((x - bounds[row]).astype(np.int32)) for x in (start, end)], fields=list(RESULT_SHAPE.field("spans").type.value_type))
                kept = np.append(0, np.cumsum(~gone))[bounds]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(block.first, rows), pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), spans),
                    pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(kept), pa.py_buffer(data[~gone])]).cast(pa.binary()),
                ], schema=RESULT_SHAPE)

    return docs.join(lost, "key", "left").select("id", "text", "spans").mapInArrow(cut, RESULT)


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What every document loses."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("long").alias("id"), "text")
    return without_repeats(docs).select(
        F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
