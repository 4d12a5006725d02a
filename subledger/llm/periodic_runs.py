"""Periodic runs of words in whole texts, found by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period ``q`` and a length of at least ``max(shortest, repeats * q)``
that no neighbouring word extends keeping that period.

1. Every word of a run stands in it at least ``repeats`` times, since the run holds each place of its period so often. A
   word that occurs more rarely inside the current segment therefore belongs to no run of it and splits the segment.
   The pieces are counted anew until none is split any more; pieces shorter than the shortest run go.
2. The surviving segments are scanned lag by lag. For lag ``p`` only words at multiples of ``p`` are looked at first: a run
   of period ``p`` holds ``repeats`` of these, all equal. Where that many agree, the equal stretch around them is
   followed to both ends. Stretches inside a run already found at a divisor of ``p`` are that run again and are passed
   over, so each run comes with its smallest period. Over all lags this looks at ``L log L`` words of a segment.

Texts are independent of each other: there is no shuffle, and a task holds a block of texts or the longest single one.

Results: a row per row of the input, with ``runs`` (structs of start, length and period, by start and then period),
``strongest`` (the run with the greatest length / period; ties: smallest start, then period; null without a run), ``kept``
(the words that no run contains after its first period, joined by one space) and ``n_words``. Null and empty texts have no
words: no runs, and an empty ``kept``. Repeated rows each have their result, ids may be null, an empty table gives no rows,
and other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from subledger.llm.common import WORDS, table

REPEATS = 4
SHORTEST = 6
# Bytes of text a task works on at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def split_segments(ids: np.ndarray, segment: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> np.ndarray:
    """Places (ascending) of the words that survive the splitting; ``segment`` is ascending and names each word's text.

    Surviving neighbours of one text are in one segment. Segments that a round leaves whole are settled and not counted
    again.
    """
    place, settled = np.arange(len(ids)), []
    while len(place):
        key = segment[place].astype(np.uint64) << np.uint64(32) | ids[place].astype(np.uint64)
        _, word, often = np.unique(key, return_inverse=True, return_counts=True)
        stays = often[word] >= repeats
        # Segments without a rare word are done.
        whole = np.minimum.reduceat(stays, first := np.flatnonzero(np.diff(segment[place], prepend=-1)))
        size = np.diff(np.append(first, len(place)))
        done = np.repeat(whole, size)
        settled.append(place[done])
        place, old = place[stays & ~done], segment
        if not len(place):
            break
        # New segments: stretches of neighbours that stay, within their old segment.
        new = np.ones(len(place), bool)
        new[1:] = (np.diff(place) > 1) | (np.diff(old[place]) > 0)
        number = np.cumsum(new) - 1
        long = np.bincount(number)[number] >= shortest
        place = place[long]
        segment = old.copy()
        segment[place] = number[long]
    return np.sort(np.concatenate(settled)) if settled else np.zeros(0, int)


def _stretch(equal_at, x: int, low: int, high: int) -> tuple[int, int]:
    """Ends of the stretch around ``x`` on which ``equal_at(from, to)`` is all true, within ``low`` to ``high``."""
    left, step = x, 64
    while left > low:
        a = max(low, left - step)
        differ = np.flatnonzero(~equal_at(a, left))
        if len(differ):
            left = a + int(differ[-1]) + 1
            break
        left, step = a, step * 2
    right, step = x, 64
    while right < high:
        b = min(high, right + step)
        differ = np.flatnonzero(~equal_at(right, b))
        if len(differ):
            right += int(differ[0])
            break
        right, step = b, step * 2
    return left, right


def scan_lags(words: np.ndarray, bounds: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the segments ``words[bounds[k]:bounds[k + 1]]``, longest segments first."""
    runs: list[tuple[int, int, int]] = []
    size = np.diff(bounds)
    # Runs long enough to hold all multiples of the lag that are looked at; shorter ones leave as the lag grows.
    start, end, period = (np.zeros(0, np.int64) for _ in range(3))
    for lag in range(1, int(size[0]) // repeats + 1 if len(size) else 0):
        stop = int(bounds[np.searchsorted(-size, -repeats * lag, "right")])  # segments that can hold such a run
        seen = words[:stop:lag]
        same = seen[1:] == seen[:-1]
        held = same[:len(same) - repeats + 2].copy()
        for k in range(1, repeats - 1):
            held &= same[k:len(held) + k]
        x = np.flatnonzero(held) * lag
        if len(start):
            wide = end - start > (repeats - 1) * lag
            start, end, period = start[wide], end[wide], period[wide]
            for k in np.flatnonzero(lag % period == 0) if len(x) else ():
                x = x[(x < start[k]) | (x + (repeats - 1) * lag >= end[k])]
        if len(x) == 0:
            continue
        # The equal stretch of a run covers all but the last of its multiples; look at its first words.
        probe = np.arange(min((repeats - 2) * lag + 1, 64))
        x = x[x + probe[-1] + lag < stop]
        x = x[(words[x[:, None] + probe] == words[x[:, None] + probe + lag]).all(axis=1)]
        done = -1
        found = []
        for at in x.tolist():
            k = int(np.searchsorted(bounds, at, "right")) - 1
            low, high = int(bounds[k]), int(bounds[k + 1]) - lag
            if at <= done or at >= high:  # of the stretch before, or equal to a word of the next segment
                continue
            left, right = _stretch(lambda a, b: words[a:b] == words[a + lag:b + lag], at, low, high)
            done = right
            length = right - left + lag
            if length >= repeats * lag and length >= shortest:
                found.append((left, right + lag, lag))
        # A stretch that lies in a run of a divisor of the lag is that run.
        for a, b, p in found:
            if not ((start == a) & (end == b) & (p % period == 0)).any():
                runs.append((a, b - a, p))
        if found:
            start, end, period = (np.append(old, [f[k] for f in found]) for k, old in enumerate((start, end, period)))
    return runs


def runs_of(texts: list[list[bytes]], repeats: int = REPEATS, shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """Runs of each text, given as its words; by start, then period."""
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for words in texts for w in words], np.int64)
    size = np.array([len(words) for words in texts], np.int64)
    text = np.repeat(np.arange(len(texts)), size)
    first = np.concatenate([[0], np.cumsum(size)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    place = split_segments(ids, text, repeats, shortest)
    if not len(place):
        return out
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(place) > 1) | (np.diff(text[place]) > 0)
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(place)))
    order = np.argsort(-length, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(length[order])])
    # Segments one after the other, longest first.
    taken = np.repeat(begin[order] - bounds[:-1], length[order]) + np.arange(len(place))
    for a, n, p in scan_lags(ids[place[taken]], bounds, repeats, shortest):
        at = int(place[taken[a]])
        out[text[at]].append((at - int(first[text[at]]), n, p))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _strongest(runs: list[tuple[int, int, int]]) -> dict | None:
    best = None
    for a, n, p in runs:
        # Exact: n / p > best's, as products; the list's order settles ties.
        if best is None or n * best[2] > best[1] * p:
            best = (a, n, p)
    return best and dict(zip(("start", "length", "period"), best))


def _without(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for a, n, p in runs:
        edge[a + p] += 1
        edge[a + n] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def periodic_runs(docs: DataFrame, repeats: int = REPEATS, shortest: int = SHORTEST) -> DataFrame:
    """(``id``, ``n_words``, ``runs``, ``strongest``, ``kept``) per row of ``docs`` (``id``, ``text``)."""
    id_type = to_arrow_type(docs.schema["id"].dataType)

    def batch_of(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of(texts, repeats, shortest)
        as_structs = [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs]
        kept = pa.array([_without(words, found) for words, found in zip(texts, runs)], pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.array(ids, id_type), pa.array([len(words) for words in texts], pa.int64()), pa.array(as_structs, pa.list_(_RUN)),
            pa.array([_strongest(found) for found in runs], _RUN), kept.cast(pa.string()),
        ], names=["id", "n_words", "runs", "strongest", "kept"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for key, text in zip(batch.column("id"), batch.column("text")):
                data = (text.as_py() or "").encode()
                if texts and held + len(data) > BLOCK_BYTES:
                    yield batch_of(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(key.as_py())
                texts.append(data.split())  # bytes are split at ASCII white space only
                held += len(data)
            if texts:
                yield batch_of(ids, texts)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(
        find, f"id {kind}, n_words long, runs array<{RUN}>, strongest {RUN}, kept string")


def with_planted_tails(doc_id: Column, text: Column) -> Column:
    """The text, or for every tenth id (by its checksum) its words with a tail that repeats itself."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    n = F.size(words)
    a = g % n
    p = F.floor((n - a) / (3 + g % 8)) + 1
    # No lambda: one would find the words anew for each of them.
    size = (n - a).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil(size / p).cast("int"))), F.lit(1), size)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
    return F.when((h % 10 == 0) & (F.regexp_count(text, F.lit(WORDS)) > 0), changed).otherwise(text)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document, with planted ones, as digests."""
    docs = table(spark, folder, "documents")
    found = periodic_runs(docs.select(F.col("doc_id").alias("id"), with_planted_tails(F.col("doc_id"), F.col("text")).alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("strongest")
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"), "n_words",
    )
