"""Every query against its plain version on a small corpus with all odd cases, and on empty tables."""

import base64
import collections
import hashlib
import os
import zlib

import brute
import pytest

from subledger.llm.queries import QUERIES

DRIVER_TABLES = "/root/testdata/sf0.001"


def got(spark, name, folder, *columns):
    rows = QUERIES[name](spark, folder).select(*columns).collect()
    return collections.Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_near_groups(spark, folder, rows):
    assert got(spark, "op1_ngram_join", folder, "doc_id", "class_id", "n_links") == collections.Counter(brute.near(rows))


def test_statistics_and_base_rules(spark, folder, rows):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got(spark, "op2_robust_outliers", folder, *columns) == collections.Counter((r[0], *brute.statistics(r[1])) for r in rows)


def test_warc_round_trip(spark, folder):
    from conftest import PAGES
    largest = {}
    for page, _, html in PAGES:
        key = html or ""
        largest[key] = max(largest.get(key, -1), -1 if page is None else page)
    want = []
    for page, _, html in PAGES:
        data, first = (html or "").encode(), largest[html or ""]
        kind = "response" if page == first else "revisit"
        want.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, first if kind == "revisit" else None))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got(spark, "op3_warc_round_trip", folder, *columns) == collections.Counter(want)


def test_token_counts(spark, folder, rows):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    want = []
    for r in rows:
        n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
        want.append((r[0], len((r[1] or "").encode()), n, n > 2048))
    assert got(spark, "op4_heap_bpe_counts", folder, "doc_id", "n_bytes", "n_tokens", "over_limit") == collections.Counter(want)


def test_shards(spark, folder, rows):
    found = QUERIES["op5_hypergeometric_shards"](spark, folder).collect()
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    slots = collections.defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert {(r.law, r.grown_shard) for r in found} == {("rows", None)}


def test_mix(spark, folder, rows):
    found = QUERIES["op6_water_filling"](spark, folder).collect()
    sizes, largest = collections.Counter(), collections.Counter()
    for r in rows:
        n = len(brute.SPACE_WORDS.findall((r[1] or "").encode()))
        sizes[r[3]] += n
        largest[r[3]] = max(largest[r[3]], n)
    names = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, full = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        target = {s: 3 * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in names if x not in full) for s in names}
        over = {s for s in names if target[s] > 3 * sizes[s] + 1e-9}
        if not over:
            break
        full |= over
    taken = collections.Counter()
    for r in found:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert len(found) == len(rows)
    # Within half of a document.
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in names)
    again = QUERIES["op6_water_filling"](spark, folder).collect()
    assert collections.Counter(map(tuple, found)) == collections.Counter(map(tuple, again))


def test_main_text(spark, folder):
    found = {(r.page_id, r.text) for r in QUERIES["op7_boosted_dom_text"](spark, folder).collect()}
    assert (1, "A title\nSome words & more, of a story that goes on for a while.\nAnother part of it, with a number of words.") in found
    assert (2, "") in found and (3, "") in found
    assert (10, "Long" + "\nMany words stand here, and they go on and on." * 3000) in found


def test_repeats(spark, folder, rows):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(spark, "op8_suffix_array_dedup", folder, *columns) == collections.Counter(brute.cut(rows))


def test_repeats_of_anchors_cut_over_shards(spark, folder, rows, monkeypatch):
    from subledger.llm import suffix_dedup
    monkeypatch.setattr(suffix_dedup, "LIMIT", 2)
    test_repeats(spark, folder, rows)


def test_base_scores(spark, folder, rows):
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    assert got(spark, "op9_backoff_automaton", folder, *columns) == collections.Counter(brute.base_scores(rows))


@pytest.mark.parametrize("size", [300, 5000, 8 << 20])
def test_trained_scores_do_not_depend_on_blocks_and_ranges(spark, folder, rows, monkeypatch, size):
    from subledger.llm import language_model
    monkeypatch.setattr(language_model, "BLOCK", size)
    monkeypatch.setattr(language_model, "RANGE", size)
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.score)
                   for r in QUERIES["op9_backoff_automaton"](spark, folder).collect())
    want = sorted((-1 if i is None else i, s) for i, s in brute.trained_scores(rows))
    assert [i for i, _ in found] == [i for i, _ in want]
    assert [s for _, s in found] == pytest.approx([s for _, s in want], abs=1e-6)


def test_hits(spark, folder, rows):
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256")
    assert got(spark, "op10_positional_index", folder, *columns) == collections.Counter(brute.hits(rows, brute.benchmark(rows)))


@pytest.mark.skipif(not os.path.isdir(DRIVER_TABLES), reason="driver tables absent")
def test_held_out_texts_get_likelier(spark):
    rows = [r for r in QUERIES["op9_backoff_automaton"](spark, DRIVER_TABLES).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
