"""The pipeline's stages, each against a plain version of its own input."""

import collections

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from subledger.llm.common import stored, table
from subledger.llm.quality import judged, text_statistics

NAMES = [name for name, _ in corpus_pipeline.STAGES]


def plain(rows):
    return [(r.doc_id, r.text, r.lang, r.source) for r in rows.collect()]


@pytest.fixture(scope="module")
def passed(spark, folder):
    """Input and output of every stage."""
    out, docs = {}, table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES:
        done = stored(stage(spark, docs, folder), "test")
        out[name] = (docs, done)
        docs = done
    return out


def test_columns_stay(passed):
    first = passed[NAMES[0]][0].columns
    assert all(passed[name][1].columns == first for name in NAMES[:-1])
    last = passed[NAMES[-1]][1]
    assert set(last.columns) == set(first) and dict(last.dtypes)["shard"] == "int" and dict(last.dtypes)["slot"] == "bigint"


def test_quality_rules_keep_what_is_judged_good(spark, passed):
    before, after = passed[NAMES[0]]
    good = judged(text_statistics(before.select("doc_id", "text", "lang", "source"))).where("kept")
    assert collections.Counter(plain(good)) == collections.Counter(plain(after))
    assert all(not brute.statistics(r[1])[-1] for r in plain(after))


def test_one_document_of_each_group_stays(passed):
    before, after = (plain(x) for x in passed[NAMES[1]])
    # Rows by number, as two documents may share an id; repeated rows are one document, with or without words.
    groups, distinct = collections.defaultdict(set), list(dict.fromkeys(before))
    for row, (_, group, _) in zip(distinct, brute.near([(k, *r[1:]) for k, r in enumerate(distinct)])):
        groups[group].add(row)
    assert len(after) == len(groups)
    assert all(sum(r in members for r in after) == 1 for members in groups.values())


def test_hit_documents_go(passed, rows):
    before, after = (plain(x) for x in passed[NAMES[2]])
    clean = [r for r, h in zip(before, brute.hits(before, brute.benchmark(rows))) if not h[2]]
    assert collections.Counter(clean) == collections.Counter(after)


def test_the_mix_meets_its_targets(passed):
    before, after = (plain(x) for x in passed[NAMES[3]])
    sizes = {r: len(brute.SPACE_WORDS.findall((r[1] or "").encode())) for r in before}
    held, taken = collections.Counter(), collections.Counter()
    for r in before:
        held[r[3]] += sizes[r]
    for r in after:
        taken[r[3]] += sizes[r]
    target = brute.targets(held)
    for source in held:
        assert abs(taken[source] - target[source]) <= max(n for r, n in sizes.items() if r[3] == source) / 2 + 1e-6
    # Every document of a source stands as often as the target holds it whole, or once more.
    rows, copies = collections.Counter(before), collections.Counter(after)
    assert set(copies) <= set(rows)
    for r, n in rows.items():
        whole = int(target[r[3]] / held[r[3]] + 1e-9) if held[r[3]] else 0
        assert whole * n <= copies[r] <= (whole + 1) * n


def test_shards_hold_all_rows(passed):
    before, after = passed[NAMES[4]]
    assert collections.Counter(plain(before)) == collections.Counter(plain(after))
    sizes = [r for r in after.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()]
    assert max(r.n for r in sizes) - min(r.n for r in sizes) <= 1
    assert all(r.n == r.d == r.m + 1 for r in sizes)


def test_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0
