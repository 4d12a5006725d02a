"""Periodic runs, hard negatives and SimHash groups against plain versions."""

import collections
import hashlib
import os
import random
import zlib
from fractions import Fraction

import brute
import duckdb
import numpy as np
import pytest
import xxhash

from subledger.llm import hard_negatives, simhash
from subledger.llm.hard_negatives import SQL, Index, multi_sequence, op12_multi_index_negatives
from subledger.llm.periodic_runs import op11_periodic_runs, periodic_runs, runs_of
from subledger.llm.simhash import op13_simhash_groups, simhash_groups


def plain_runs(words, repeats=4, shortest=6):
    """Every lag, every stretch."""
    found = []
    for p in range(1, len(words) // repeats + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            n = j - i + p
            if j > i and n >= max(shortest, repeats * p) and not any((i, n) == (a, b) and p % q == 0 for a, b, q in found):
                found.append((i, n, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def plain_op11(doc_id, text):
    words = brute.SPACE_WORDS.findall((text or "").encode())
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a, k = g % n, 3 + g % 8
            p = 1 + (n - a) // k
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for a, size, p in runs for i in range(a + p, a + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{a},{size},{p}\n" for a, size, p in runs)), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS_11 = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_equal_the_plain_version_on_repetitive_texts():
    rng = random.Random(7)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 5)):
            kinds, words = rng.choice([1, 2, 3, 20]), []
            while len(words) < rng.randint(0, 110):
                unit = [b"%d" % rng.randrange(kinds) for _ in range(rng.randint(1, 9))]
                words += (unit * 9)[:rng.randint(1, 8 * len(unit))]
            texts.append(words)
        assert runs_of(texts) == [plain_runs(words) for words in texts]


def test_runs_of_all_odd_texts(spark, folder, rows):
    found = collections.Counter(tuple(r) for r in op11_periodic_runs(spark, folder).select(*COLUMNS_11).collect())
    want = collections.Counter(plain_op11(r[0], r[1]) for r in rows if len(r[1] or "") < 20_000)
    assert want <= found and sum(found.values()) == len(rows)
    assert any(r[2] is not None for r in want)


def test_long_texts_are_scanned_whole(spark):
    rng = random.Random(3)
    unit = [f"w{rng.randrange(500)}" for _ in range(20_000)]
    words = [f"v{k}" for k in range(5000)] + unit * 4 + unit[:7] + ["end"] * 30_000
    r, = periodic_runs(spark.createDataFrame([(1, " ".join(words))], "id long, text string")).collect()
    assert [tuple(x) for x in r.runs] == [(5000, 80_007, 20_000), (85_007, 30_000, 1)]
    assert r.strongest.period == 1 and r.kept.split(" ") == words[:25_000] + ["end"]


def plain_fingerprint(text):
    words = brute.SPACE_WORDS.findall((text or "").encode().translate(brute.LOWER))
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=3):
    """Smallest id of each row's component, over all pairs."""
    some = sorted({fp for _, fp in prints})
    up = {fp: fp for fp in some}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, x in enumerate(some):
        for y in some[:i]:
            if (x ^ y).bit_count() <= distance:
                up[root(x)] = root(y)
    low = {}
    for key, fp in prints:
        if key is not None:
            low[root(fp)] = min(low.get(root(fp), key), key)
    return [low.get(root(fp)) for _, fp in prints]


def test_fingerprints_and_components(spark, folder, rows):
    found = collections.Counter(tuple(r) for r in op13_simhash_groups(spark, folder).collect())
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    want = collections.Counter((key, f"{fp:016x}", c) for (key, fp), c in zip(prints, plain_components(prints)))
    assert found == want
    assert any(key != c for key, _, c in want)


@pytest.mark.parametrize("parts", [2, 3, 4])
def test_every_link_is_found_whatever_the_partitions(spark, monkeypatch, parts):
    """Close and correlated fingerprints, a large ball of near copies, blocks of a few rows."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "TOGETHER", 64)
    rng = random.Random(parts)
    centres = [rng.getrandbits(64) & rng.choice([2 ** 64 - 1, 0x00FF00FFFFFF00FF]) for _ in range(60)] + [0, 2 ** 64 - 1]
    prints = []
    for c in centres:
        prints += [c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(6)]
    prints += [centres[0] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(150)]
    signed = [(fp - 2 ** 64 if fp >= 2 ** 63 else fp,) for fp in set(prints)]
    table = spark.createDataFrame(signed, "fp long")
    plan = simhash.make_plan(table, len(signed), parts=parts)
    assert sorted(b for p in plan.parts for b in p) == list(range(64))
    edges = simhash.link_forest(table, plan)
    assert edges.count() <= 40 * len(signed)
    root = {r.v: r.root for r in simhash.components(edges).collect()}
    mask = 2 ** 64 - 1
    want = plain_components([(k, fp & mask) for k, (fp,) in enumerate(signed)])
    got = collections.defaultdict(set)
    for k, (fp,) in enumerate(signed):
        got[root.get(fp, fp)].add(k)
    expected = collections.defaultdict(set)
    for k, c in enumerate(want):
        expected[c].add(k)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_thresholds_spend_the_whole_distance_and_avoid_crowded_values():
    fps = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63, 5000, dtype=np.int64)
    parts = [list(range(k, k + 16)) for k in range(0, 64, 16)]
    fps &= ~np.int64(0xFFFF)  # the first partition's value is everyone's
    plan = simhash.Plan(parts, 3)
    plan.learn(plan.halves_counted(fps), len(fps))
    chosen = plan.thresholds(simhash._bits(fps))
    assert ((chosen + 1).sum(axis=1) == 4).all() and (chosen[:, 0] == -1).all()


def test_equal_fingerprints_of_many_rows(spark):
    rows = [(k, "the very same words in every copy") for k in range(10_000)] + [(None, None)] * 3
    found = simhash_groups(spark.createDataFrame(rows, "id long, text string"))
    assert collections.Counter(r.component_id for r in found.collect()) == {0: 10_000, None: 3}


COLUMNS_12 = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, folder, monkeypatch, small):
    if small:  # many shelves, cells over several of them, several blocks of requests, first visits that see little
        for name, value in (("PROBE", 8), ("SHELF", 20), ("REQUESTS", 3), ("AT_ONCE", 2), ("CODES", 4)):
            monkeypatch.setattr(hard_negatives, name, value)
    found = collections.Counter(tuple(r) for r in op12_multi_index_negatives(spark, folder).select(*COLUMNS_12).collect())
    assert found == collections.Counter(brute.hard_negatives(brute.vectors()))


def test_hard_negatives_of_driver_rows_equal_the_sql(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("driver tables absent")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = collections.Counter(con.sql(f"SELECT {', '.join(COLUMNS_12)} FROM ({SQL})").fetchall())
    assert collections.Counter(tuple(r) for r in op12_multi_index_negatives(spark, folder).select(*COLUMNS_12).collect()) == want


def test_cells_come_by_falling_sum_and_bounds_hold():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=9), rng.normal(size=7)
    found = list(multi_sequence(a, b))
    assert sorted((i, j) for _, i, j in found) == [(i, j) for i in range(9) for j in range(7)]
    assert [s for s, _, _ in found] == sorted((s for s, _, _ in found), reverse=True)
    x = np.floor(rng.normal(size=(3000, 10)) * 256)
    index = Index(x[:500])
    cell, (e1, e2) = index.assign(x)
    index.learn([(c, (cell == c).sum(), e1[cell == c].max(), e2[cell == c].max()) for c in np.unique(cell)])
    for anchor in x[:20]:
        scores = x @ anchor
        for least in np.quantile(scores, [0.5, 0.99]):
            seen = index.visits(anchor, -np.inf, -np.inf, np.inf, True) + index.visits(anchor, least, -np.inf, np.inf, False)
            assert len(seen) == len(set(seen)) and set(cell[scores >= least]) <= set(seen)


def test_large_components_are_exact():
    a = np.array([[2.0 ** 40 + 1, 3.0]])
    assert hard_negatives._product(a, a)[0, 0] == (2 ** 40 + 1) ** 2 + 9
