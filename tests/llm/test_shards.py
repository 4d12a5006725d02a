"""Sizes that op8 deals its contexts by."""

import glob
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from subledger.llm import suffix_dedup as sd
from subledger.llm import text
from subledger.session import shared_folder


def test_an_anchor_is_cut_only_where_it_overfills_a_shard():
    largest = sd.LIMIT * (sd.RUN + sd.WINDOW - 1)
    assert sd.SHARD_BYTES / 2 < largest <= sd.SHARD_BYTES


def test_classes_stay_within_an_anchor():
    rng = random.Random(4)
    for _ in range(60):
        base = [rng.choice(b"ab") for _ in range(40)]
        parts, group = [], []
        for g in range(rng.randrange(1, 5)):
            for _ in range(rng.randrange(1, 4)):
                one = base[rng.randrange(5):rng.randrange(20, 40)]
                one[rng.randrange(len(one))] = rng.choice(b"abc")
                parts.append(bytes(one))
                group.append(g)
        data, bounds = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
        order, _ = sd.suffix_array(data, bounds, np.array(group))
        want = sorted((g, p[k:], b + k) for g, p, b in zip(group, parts, bounds.tolist()) for k in range(len(p)))
        assert order.tolist() == [at for *_, at in want]
        at, of, classes = sd.window_classes(data, bounds, 8, np.array(group))
        windows = [(group[c], data[a:a + 8].tobytes()) for a, c in zip(at.tolist(), of.tolist())]
        assert len(set(windows)) == len(set(classes.tolist())) == len(set(zip(windows, classes.tolist())))


@pytest.mark.parametrize("size", [1, 7, 100])
def test_anchors_do_not_depend_on_stretches(monkeypatch, size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("ab") for _ in range(n)) for n in (0, 49, 50, 51, 120, 300, 3, 77)]
    block = next(text.blocks(pa.array(texts)))
    whole = sd.anchor_runs(block)
    monkeypatch.setattr(sd, "STRETCH", size)
    assert all((a == b).all() for a, b in zip(whole, sd.anchor_runs(block)))
    covered = {(row, at + k) for row, at, n in zip(*(x.tolist() for x in whole[1:4])) for k in range(n)}
    assert covered == {(row, int(block.bounds[row]) + k) for row, t in enumerate(texts) for k in range(len(t) - 49)}


def test_contexts_take_little_room(spark):
    rows = [(k, "".join(random.Random(k // 2).choices("abcdefgh ", k=400)), k) for k in range(20)]
    before = set(glob.glob(f"{shared_folder(spark)}/contexts-*"))
    found = sd.repeated_spans(spark.createDataFrame(rows, "id long, text string, key long"))
    assert {r.key for r in found.collect()} == set(range(1, 20, 2))
    folder, = set(glob.glob(f"{shared_folder(spark)}/contexts-*")) - before
    for file in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(file)
        assert meta.schema_arrow.field("h").type == pa.int32()
        assert {g.column(k).compression for g in map(meta.metadata.row_group, range(meta.num_row_groups)) for k in range(8)} <= {"ZSTD"}


def test_texts_side_by_side_keep_their_own_spans(spark):
    one = "".join(random.Random(1).choices("abcdefgh ", k=120))
    rows = [(1, one), (2, one), (3, one), (4, "é" + one[:60] + "!" + one[20:90]), (5, None), (6, "")]
    found = {r.id: r for r in sd.without_repeats(spark.createDataFrame(rows, "id long, text string").coalesce(1)).collect()}
    assert {k: [tuple(s) for s in r.spans] for k, r in found.items()} == {
        1: [], 2: [(0, 120)], 3: [(0, 120)], 4: [(2, 62), (63, 133)], 5: [], 6: []}
    assert {k: bytes(r.kept).decode() for k, r in found.items()} == {1: one, 2: "", 3: "", 4: "é!", 5: "", 6: ""}
