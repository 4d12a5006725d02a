"""Token counts by byte-pair merging, without making tokens.

A word's symbols form a linked list; a heap holds the ranks of its adjacent pairs. The pair of lowest rank is
popped again and again and its symbols are joined; the word's tokens are its initial symbols minus the merges.
Counts of words met before are kept in a bounded memory per worker, so each task's work follows its texts.

The vocabulary is a file of the ``tokenizers`` library of the kind "BPE with word ends": NFC, lower case, words
cut by pattern, bytes as symbols, a word-end mark on the last one. Its added tokens are cut out of the raw text
first and count one each, as the library does by default. Null and empty texts have 0 tokens; every row is
counted on its own, so repeated rows, ties and null ids need no rule; an empty table gives no rows. Other
columns are not looked at.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import table

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
# Words whose counts a worker remembers, and the longest one it does.
REMEMBERED = 1_000_000
LONGEST_REMEMBERED = 48
ROWS_AT_ONCE = 512

# Unassigned code points that this Python's pattern library takes for letters, unlike the vocabulary's,
# and letters to which the vocabulary's Unicode version gives a lower case that this Python does not know.
NO_LETTERS = (r"\U00032808\U0003285C\U00032988\U0003D808\U0003D85C\U0003D988"
              r"\U0003E808\U0003E85C\U0003E988\U0003F808\U0003F85C\U0003F988")
NEW_LOWER = {"\uA7CB": "\u0264", "\uA7DC": "\u019B"}
# The vocabulary's own word pattern, for lower-case text, and its form for plain ASCII.
PATTERN = (r"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{L}--[" + NO_LETTERS + r"]]+|[\p{N}]"
           r"|[[^\s\p{L}\p{N}]||[" + NO_LETTERS + r"]]+")
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Counter:
    """Counts the tokens of texts for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        ids = rules["model"]["vocab"]
        mark = rules["model"]["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = [ids[x] for x in letters]
        self.final = [ids[x + mark] for x in letters]
        self.width = len(ids)
        # Pair -> rank and joined symbol.
        self.rank, self.joined = {}, []
        for rank, pair in enumerate(rules["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[ids[left] * self.width + ids[right]] = rank
            self.joined.append(ids[left + right])
        added = [re.escape(t["content"]) for t in rules["added_tokens"]]
        self.added = re.compile("|".join(added)) if added else None
        self.find, self.find_ascii = regex.compile(PATTERN).findall, re.compile(ASCII_PATTERN).findall
        self.known = _Known(self)

    def merged(self, word: str) -> int:
        """Tokens of one word: symbols minus merges."""
        data = word.encode()
        n = len(data)
        symbol = [self.inner[b] for b in data]
        symbol[-1] = self.final[data[-1]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, width, joined = self.rank, self.width, self.joined
        heap = []
        for i in range(n - 1):
            r = rank.get(symbol[i] * width + symbol[i + 1])
            if r is not None:
                heap.append(r * n + i)
        heapq.heapify(heap)
        left = n
        while heap:
            r, i = divmod(heapq.heappop(heap), n)
            j = after[i]
            # Stale: one of the two was joined to something else meanwhile.
            if j >= n or symbol[i] < 0 or rank.get(symbol[i] * width + symbol[j]) != r:
                continue
            symbol[i], symbol[j] = joined[r], -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                r = rank.get(symbol[i] * width + symbol[k])
                if r is not None:
                    heapq.heappush(heap, r * n + i)
            h = before[i]
            if h >= 0:
                r = rank.get(symbol[h] * width + symbol[i])
                if r is not None:
                    heapq.heappush(heap, r * n + h)
        return left

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if self.added and "<|" in text:
            parts = self.added.split(text)
            return len(parts) - 1 + sum(map(self._plain, parts))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        if text.isascii():
            return sum(map(self.known.__getitem__, self.find_ascii(text.lower())))
        # Lower case goes letter by letter: no final form of sigma.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        for upper, lower in NEW_LOWER.items():
            text = text.replace(upper, lower)
        return sum(map(self.known.__getitem__, self.find(text)))


class _Known(dict):
    """Counts of words seen; forgets them all when full, which costs time only."""

    def __init__(self, counter: Counter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> int:
        tokens = self.counter.merged(word)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = tokens
        return tokens


_COUNTERS: dict[str, Counter] = {}


def counter(path: str | None = None) -> Counter:
    """The worker's counter for a vocabulary file."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCABULARY)
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(``id``, ``n_bytes``, ``n_tokens``) per row of ``docs`` (``id``, ``text``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                texts = pc.fill_null(part.column("text"), "")
                tokens = [count(t) for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pc.binary_length(texts).cast(pa.int64()), pa.array(tokens, pa.int64())],
                    names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")


def op4_heap_bpe_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return token_counts(docs).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
