"""Words of whole texts as numpy arrays, for use inside tasks.

Texts are taken from Arrow batches in blocks of whole rows, so memory follows the block size or the longest
single text. A word is known by a 64-bit hash of its bytes and length; two different words share one with a
probability of about 2 ** -64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_UP, _DOWN = np.ones(1, np.uint64), np.ones(1, np.uint64)

# Word bytes: all but ASCII white space; digits, letters and everything beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[ord("0"):ord("9") + 1] = ALPHANUMERIC[ord("a"):ord("z") + 1] = ALPHANUMERIC[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


class Block(NamedTuple):
    """Texts of rows ``first`` to ``last`` of a batch: their bytes, and where each begins and the last ends."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Hash, row in its block, and byte range of each word."""

    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their bounds; a null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Runs of whole texts of about ``size`` bytes; a longer text is a block of its own."""
    data, bounds = utf8(texts)
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(bounds) - 1)
        yield Block(first, last, data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first])
        first = last


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) < n:
        n = max(n, BLOCK_BYTES + 1)
        up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _UP, _DOWN = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _UP, _DOWN


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit words over all others; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which :func:`span_hash` takes the hash of any byte range."""
    up, _ = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes in each range; it does not depend on where the range lies."""
    _, down = _powers(len(sums))
    raw = (sums[end] - sums[start]) * down[start]
    return mixed(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def equal_span_hash(sums: np.ndarray, first: int, last: int, size: int) -> np.ndarray:
    """:func:`span_hash` of the ``size`` bytes that begin at each place from ``first`` up to ``last``."""
    _, down = _powers(len(sums))
    x = sums[first + size:last + size] - sums[first:last]
    x *= down[first:last]
    x += np.uint64(size * 0xD6E8FEB86659FD93 % (1 << 64))
    half = x >> np.uint64(30)
    for factor, shift in ((0xBF58476D1CE4E5B9, 27), (0x94D049BB133111EB, 31)):
        x ^= half
        x *= np.uint64(factor)
        np.right_shift(x, np.uint64(shift), out=half)
    x ^= half
    return x


def words(block: Block, of_word: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """The block's words in order; no word crosses from one text into the next."""
    data, bounds = block.data, block.bounds
    if lower:
        data = _LOWER[data]
    inside = of_word[data]
    n = len(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = bounds[(bounds > 0) & (bounds < n)]
    before[edges], after[edges - 1] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    hashes = span_hash(prefix_sums(data), start, end) if n else np.zeros(0, np.uint64)
    return Words(hashes, np.searchsorted(bounds[1:], start, "right"), start, end)


def windows(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``n`` consecutive words of a text."""
    count = max(len(found.hash) - n + 1, 0)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        factor = np.uint64(pow(_BASE, 2 * k + 3, 1 << 64))
        total += found.hash[k:k + count] * factor
    same = found.row[:count] == found.row[n - 1:n - 1 + count]
    return mixed(total[same]), found.row[:count][same]


def counts(found: Words, rows: int) -> np.ndarray:
    """Words of each text."""
    return np.bincount(found.row, minlength=rows).astype(np.int64)
