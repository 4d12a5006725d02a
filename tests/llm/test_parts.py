"""Parts of the operators on their own."""

import itertools
import random
import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subledger.llm.common import stored
from subledger.llm import decontamination, html_text, language_model, mixing, ngram_join, quality, sharding, suffix_dedup, text, warc


@given(st.lists(st.text("ab é\n\0", max_size=12), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_are_those_of_a_pattern(texts):
    import re
    want = [(row, w.encode()) for row, t in enumerate(texts) for w in re.findall("[^\x20\x09-\x0D]+", t)]
    seen = []
    for block in text.blocks(pa.array(texts, pa.string()), 5):
        found = text.words(block)
        seen += [(int(r) + block.first, block.data[s:e].tobytes()) for r, s, e in zip(found.row, found.start, found.end)]
        assert len(set(zip(found.hash.tolist()))) == len({block.data[s:e].tobytes() for s, e in zip(found.start, found.end)})
    assert seen == want


@given(st.lists(st.binary(min_size=1, max_size=30).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=8))
@settings(max_examples=80, deadline=None)
def test_suffix_array_and_prefixes(parts):
    data, bounds = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
    order, rank = suffix_dedup.suffix_array(data, bounds)
    suffixes = [p[k:] for p in parts for k in range(len(p))]
    assert [suffixes[i] for i in order] == sorted(suffixes)
    assert [rank[i] for i in order] != [] and all(order[order == i].size == 1 for i in range(len(suffixes)))
    place = np.empty(len(order), int)
    place[order] = np.arange(len(order))
    shared = suffix_dedup.kasai(data, bounds, order, place, np.diff(bounds), 1000)
    for i, suffix in enumerate(suffixes):
        if place[i]:
            before = suffixes[order[place[i] - 1]]
            assert shared[i] == sum(1 for _ in itertools.takewhile(lambda ab: ab[0] == ab[1], zip(before, suffix)))


def test_shards_of_contexts_may_be_cut_anywhere(monkeypatch):
    rng = random.Random(1)
    bases = [bytes(rng.choice(b"abc") for _ in range(90)) for _ in range(3)]
    rows = []
    for k in range(60):
        one = bytearray(bases[k // 20])
        one[rng.randrange(90)] = 120
        rows.append((k // 20, 0, k, bytes(one), 1, k, k))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c) for c in zip(*rows)], names=["h", "salt", "c", "bytes", "parts", "low", "high"])

    def owners(size, cut):
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", size)
        parts = [batch.slice(k, cut) for k in range(0, 60, cut)]
        out = []
        for b in suffix_dedup._shard_classes(iter(parts)):
            out += [(r["c"], w, r["owner"]) for r in b.to_pylist() for w in range(r["first"], r["last"] + 1)]
        return sorted(out)

    whole = {(c, w) for c, w, _ in owners(1 << 20, 60)}
    assert whole <= {(r[2], w) for r in rows for w in range(41)}
    assert owners(500, 60) == owners(500, 7) == owners(3000, 13)


def test_band_choice_reaches_the_recall():
    bands = ngram_join.choose_bands(0.8, 0.9999, 5)
    assert 1 - (1 - 0.8 ** 5) ** bands >= 0.9999 > 1 - (1 - 0.8 ** 5) ** (bands - 1)


def test_overlaps_of_many_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, n).astype(np.uint64)) for n in rng.integers(1, 200, 30)]
    want = [[len(np.intersect1d(a, b)) for b in sets[10:]] for a in sets[:10]]
    assert (ngram_join.overlaps(sets[:10], sets[10:]) == np.array(want)).all()


def test_large_buckets_are_verified_in_blocks(spark, folder, rows, monkeypatch):
    import brute
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", 3)
    found = ngram_join.op1_ngram_join(spark, folder).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute.near(rows)))


def test_groups_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long").select(
        F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
    found = {r.v: r.root for r in ngram_join.star_groups(edges).collect()}
    assert found == {**{k: 0 for k in range(1, 41)}, 101: 100}


def test_hypergeometric_law(spark):
    rows = spark.range(4000).select(sharding.hypergeometric(
        F.lit(30).cast("long"), F.lit(70).cast("long"), F.lit(20).cast("long"), (F.col("id") + 0.5) / 4000).alias("x"))
    seen = np.array([r.x for r in rows.collect()])
    from math import comb
    law = {x: comb(30, x) * comb(70, 20 - x) / comb(100, 20) for x in range(21)}
    for x, p in law.items():
        assert abs((seen == x).mean() - p) < 1e-3


def test_communication_matrix_has_exact_margins(spark):
    sizes = spark.createDataFrame([(p, 10 + p * 7 % 40) for p in range(0, 90, 2)], "part long, rows long")
    found = sharding.communication_matrix(sizes, 24).collect()
    assert {r.part: sum(r.counts) for r in found} == {r.part: r.rows for r in sizes.collect()}
    columns = np.array([r.counts for r in found]).sum(axis=0)
    assert columns.max() - columns.min() <= 1 and min(min(r.counts) for r in found) >= 0


def test_chi_square_and_inverse(spark):
    assert quality.chi_square_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    a = np.array([[4, 1, 0, 0, 1], [1, 3, 0, .5, 0], [0, 0, 2, 0, 0], [0, .5, 0, 1, 0], [1, 0, 0, 0, 5.0]])
    row = spark.createDataFrame([(a.tolist(),)], "m array<array<double>>").select(quality.inverted(F.col("m")).alias("i")).first().i
    assert np.allclose(np.array(row.inverse).reshape(5, 5), np.linalg.inv(a)) and row.logdet == pytest.approx(np.log(np.linalg.det(a)))


def test_estimates_withstand_a_fifth_of_junk(spark):
    rng = np.random.default_rng(1)
    clean = [(i, "en", "s", int(n), int(n * 5 * f), 0, 0, 0, 10, False)
             for i, (n, f) in enumerate(zip(np.exp(rng.normal(5.5, 0.5, 400)), np.exp(rng.normal(0, 0.03, 400))))]
    junk = [(1000 + i, "en", "s", 300, 2400, 400, 5, 40, 10, False) for i in range(100)]
    rows = spark.createDataFrame(clean + junk, "doc_id long, lang string, source string, n_words long, word_chars long, "
                                 "n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, base_failed boolean")
    kept = {r.doc_id for r in quality.judged(rows).where("kept").collect()}
    assert kept == {r[0] for r in clean}


def test_each_statistic_rejects_by_itself(spark):
    rng = np.random.default_rng(2)
    # Words, word length, symbols, repeated lines, repeated words; most documents have none of the last three.
    clean = [(int(n), f, 0, 0, 0) for n, f in zip(1000 * np.exp(rng.normal(0, 0.1, 400)), np.exp(rng.normal(0, 0.02, 400)))]
    clean += [(6000, 1, 0, 0, 0), (170, 1, 0, 0, 0), (1000, 1.25, 0, 0, 0), (1000, 1, 150, 0, 0), (1000, 1, 0, 40, 0), (1000, 1, 0, 0, 300)]
    junk = [(10000, 1, 0, 0, 0), (100, 1, 0, 0, 0), (1000, 1.4, 0, 0, 0), (1000, 1, 240, 0, 0), (1000, 1, 0, 65, 0), (1000, 1, 0, 0, 480)]
    rows = spark.createDataFrame(
        [(i, "en", "s", n, int(n * 5 * f), symbols, lines, repeated, 100, False) for i, (n, f, symbols, lines, repeated) in enumerate(clean + junk)],
        "doc_id long, lang string, source string, n_words long, word_chars long, "
        "n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, base_failed boolean")
    assert {r.doc_id for r in quality.judged(rows).where("kept").collect()} == set(range(len(clean)))


def test_archive_reader_skips_what_is_not_wanted():
    made = [{"record_type": k, "record_id": f"r{i}", "payload": b"x" * (i * 3000), "refers_to": "r9" if k == "revisit" else None}
            for i, k in enumerate(["response", "revisit", "response", "warcinfo"])]
    packed = b"".join(warc.member(warc.record(r)) for r in made)
    import gzip
    foreign = b"".join(gzip.compress(warc.record(r)) for r in made)
    plain = b"".join(warc.record(r) for r in made)
    for data, zipped in ((packed, True), (foreign, True), (plain, False)):
        file = pa.BufferReader(data)
        found = list(warc.records(file, zipped, True, lambda f: f["record_type"] == "response"))
        assert [(f["record_id"], f["payload_length"]) for f in found] == [("r0", 0), ("r2", 6000)]
        found = list(warc.records(file, zipped, False, lambda f: True))
        assert [(f["record_id"], f["http_length"]) for f in found] == [(f"r{i}", 3000 * i) for i in range(4)]
        assert all("payload" not in f for f in found)


def test_header_predicates_are_taken_by_the_reader(spark, tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan
    from pyspark.sql.types import StructType
    made = [warc.record({"record_type": k, "record_id": k, "payload": b"x"}) for k in ("response", "revisit", "response")]
    (tmp_path / "a.warc").write_bytes(b"".join(made))
    reader = warc.WarcReader(StructType.fromDDL("record_type string, payload_length long"), {"path": str(tmp_path)})
    other = GreaterThan(("offset",), 5)
    assert list(reader.pushFilters([EqualTo(("record_type",), "response"), other])) == [other]
    found = [r for part in reader.partitions() for batch in reader.read(part) for r in batch.to_pylist()]
    assert found == [{"record_type": "response", "payload_length": 1}] * 2


def whole_automaton(texts):
    """N-grams and automaton of texts that are one block and all train."""
    hashes, row = language_model.tokens(pa.array(texts))
    found = language_model.grams(hashes, row)
    keys, count = language_model.counts_of(hashes, row, np.ones(len(texts), bool), 0, 1)
    assert (keys == found.keys).all()
    assert (count == sum(np.bincount(at[at >= 0], minlength=len(keys)) for at in found.at)).all()
    starts = np.arange(len(found.keys))
    told, (total, distinct) = language_model._total(found.keys, starts, count)
    floor = total + language_model.ADD * (distinct + 1)
    context = language_model.arcs_of(found, told >> 1, floor)[2]
    sums = language_model.context_sums(found, told >> 1, (told & 1) > 0, floor)
    fail, _ = language_model._failing(found.keys, starts, *sums)
    return found, language_model.automaton(found, told >> 1, fail, floor), context, floor


def test_failure_arcs_leave_one_in_all():
    rng = random.Random(2)
    found, model, context, floor = whole_automaton([" ".join(rng.choice("abcdef") for _ in range(50)) for _ in range(40)])
    order = language_model.order_of(found.keys)
    p = 10 ** model.weight
    assert p[order == 1].sum() + language_model.ADD / floor == pytest.approx(1)
    last = {(k, place): at[i] for k, at in enumerate(found.at[:2]) for i, place in enumerate(found.at[k + 1]) if place >= 0}
    # Probabilities of all words after each state of one word, over words and the unseen one.
    for state in np.flatnonzero(order == 1):
        own = np.flatnonzero((context == state) & (order == 2))
        rest = 10 ** model.fail[state] * (1 - sum(p[last[0, k]] for k in own))
        assert p[own].sum() + rest == pytest.approx(1, abs=1e-6)


def test_blocks_are_whole_rows(spark, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK", 100)
    rows = [(i, "x" * (300 if i % 5 == 0 else 20), True) for i in range(50)]
    packed = language_model._packed(spark.createDataFrame(rows, "id long, text string, trains boolean").coalesce(1)).collect()
    assert len({r.block for r in packed}) == len(packed) > 10
    found = [language_model._rows(r.body) for r in packed]
    assert sorted(i for t in found for i in t.column("id").to_pylist()) == list(range(50))
    assert all(t.num_rows == 1 or r.size <= 100 for t, r in zip(found, packed))


def test_keys_that_tie_in_their_high_bits_are_ordered():
    keys = np.array([7, 5, 6, 5, 1 << 63, 4, 5], np.uint64)
    assert (language_model.sorting(keys) == np.argsort(keys, kind="stable")).all()
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    assert (language_model.sorting(keys) == np.argsort(keys, kind="stable")).all()


def test_packed_values_come_back():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    for values in (keys, np.arange(-5, 5), np.array([0.5, -3e300]), np.zeros(0, np.int64)):
        assert (language_model.unpack(language_model.pack(values), len(values), values.dtype.type) == values).all()


def test_a_source_of_one_row_many_times_meets_its_target(spark):
    rows = [(1, "a few words that are the same", "b")] * 4000 + [(i, "some other words " * (i % 5 + 1), "a") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    sized = stored(mixing.measured(docs), "test")
    found = mixing.mixed(sized, mixing.recipe(sized)).groupBy("source").agg(
        F.max("target").alias("target"), F.sum("taken").alias("taken"), F.max("copies").alias("most"), F.min("copies").alias("least"))
    target = {}
    for r in found.collect():
        target[r.target] = r.taken
        assert abs(r.taken - r.target) <= 8 and r.most - r.least <= 1
    # The mix itself gives as many rows of it.
    assert 7 * mixing.mix(docs).where("source = 'b'").count() == min(target.items())[1]


def test_loose_phrases(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "a b x c d e f g h i j"), (3, "a b c d e")], "id long, text string")
    tests = spark.createDataFrame([("t", "a b c d e f g h i j")], "item_id string, text string")
    found = {r.id: (r.n_hit, r["items"], r.near) for r in decontamination.contamination(docs, tests).collect()}
    assert found == {1: (10, ["t"], ["t"]), 2: (0, [], ["t"]), 3: (0, [], [])}


def test_tests_in_many_blocks(spark, folder, rows, monkeypatch):
    import brute
    monkeypatch.setattr(decontamination, "TEST_BYTES", 60)
    found = decontamination.op10_positional_index(spark, folder).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute.hits(rows, brute.benchmark(rows))))


def test_pages_of_other_layouts(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    trees = html_text.fit(pages)
    right = wrong = missed = 0
    for seed, row in enumerate(pages.orderBy("page_id").select("html").collect()):
        article, other = html_text._pieces(html_text.read_page(row.html))
        page = html_text.read_page(html_text.layout(article, other, random.Random(10_000 + seed)))
        keep = html_text.decoded(page, trees.odds(html_text.features(page)))
        for node, words in page.texts:
            right += len(words) * (keep[node] and page.nodes[node].keep is True)
            wrong += len(words) * (keep[node] and page.nodes[node].keep is not True)
            missed += len(words) * (not keep[node] and page.nodes[node].keep is True)
        # No kept node below a dropped one.
        assert all(keep[n.parent] for i, n in enumerate(page.nodes) if keep[i] and n.parent >= 0)
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97


def test_reader_on_pages_as_they_come():
    """Written out by hand: what a browser shows as blocks of these pages."""
    from subledger.llm.html_text import read_page
    pages = {
        "<p title=it's>Hello</p>": ["Hello"],
        "<p title=it\"s class=x>Hello<p>again": ["Hello", "again"],
        '<p title="a>b">x</p><!-- <p>no</p> --><?php x ?><!doctype html>y': ["x", "y"],
        "a < b and 3 <4 <b>bold</b> text": ["a < b and 3 <4 bold text"],
        "<p>cut off in a ta<b": ["cut off in a ta"],
        "<script>var a = '<p>no</p>'</script><style>p {}</style>x<textarea>no": ["x"],
        "<ul><li>one<li>two</ul></div>three": ["one", "two", "three"],
        "<p a='x'b=\"y\" c>z &amp; &lt;&#233;&eacute;": ["z & <éé"],
    }
    for source, texts in pages.items():
        assert [t for _, t in read_page(source).texts] == texts, source


@pytest.mark.parametrize("piece", ["<p ", '<p a="', "<div>", "<head>", "<!--", '<p a=">" ', "<li>", "<h1>", "</", "<b>", "<script", "</p>x"])
def test_broken_pages_are_read_in_time(piece):
    from subledger.llm.html_text import read_page
    start = time.perf_counter()
    read_page(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - start < 8


def test_pages_without_an_article_element_are_not_kept_whole(spark):
    words = "These are words of a story that goes on, and on, for quite a while until it ends. "
    page = ("<body><div class=menu><a href=1>Home</a> <a href=2>News</a></div><nav><a href=3>More</a></nav><div class=text>"
            + "".join(f"<p>{words * 3}{k}</p>" for k in range(6)) + "</div><footer>Nobody, 2024</footer></body>")
    from subledger.llm.html_text import fit, main_texts
    pages = spark.createDataFrame([(k, "u", page.replace("story", f"story{k}")) for k in range(12)] + [(99, "u", None)], "id long, url string, html string")
    trees = fit(pages)
    texts = {r.id: r.text for r in main_texts(pages, trees).collect()}
    assert texts[99] == "" and all("quite a while" in texts[k] and "Nobody" not in texts[k] and "News" not in texts[k] for k in range(12))
    bare = spark.createDataFrame([(1, "u", "<div><a>x</a></div>"), (2, "u", None)], "id long, url string, html string")
    assert fit(bare) is None and {r.text for r in main_texts(bare, None).collect()} == {""}


def test_payload_lengths_whatever_the_length_of_the_url(spark, tmp_path):
    rows = [(k, "http://a/" + "x" * n, "same payload") for k, n in enumerate(range(3500, 4200, 7))]
    pq_table = pa.table({"page_id": pa.array([r[0] for r in rows]), "url": [r[1] for r in rows], "html": [r[2] for r in rows]})
    pq.write_table(pq_table, f"{tmp_path}/pages.parquet")
    from subledger.llm.warc import op3_warc_round_trip
    found = op3_warc_round_trip(spark, str(tmp_path)).collect()
    assert len(found) == len(rows) and {r.payload_bytes for r in found} == {12}


def test_one_benchmark_item_repeated_many_times(spark):
    from subledger.llm.decontamination import contamination
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "other words")], "id long, text string")
    tests = spark.createDataFrame([("i", "alpha beta gamma")] * 10_000 + [("j", "other words")], "item_id string, text string")
    found = {r.id: (r.n_hit, list(r["items"])) for r in contamination(docs, tests).collect()}
    assert found == {1: (3, ["i"]), 2: (2, ["j"])}


def test_letters_of_the_vocabularys_unicode_version():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from subledger.llm import token_counts
    path = public_tokenizers.path(token_counts.VOCABULARY)
    count, library = token_counts.Counter(path).count, Tokenizer.from_file(path)
    odd = ["Ɤ", "Ƛ"] + [chr(0x30000 + c) for c in (0x2808, 0x285C, 0x2988, 0xD808, 0xE85C, 0xF988)]
    for letter in [*odd, "é", "Σ", "漢", "͸"]:
        text_ = f"a{letter}b {letter}1{letter} {letter}{letter}!"
        assert count(text_) == len(library.encode(text_, add_special_tokens=False).ids)
