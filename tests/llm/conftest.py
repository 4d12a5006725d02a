import os

import brute
import pyarrow as pa
import pyarrow.parquet as pq
import pytest


def write(folder, rows, items, pages, vectors):
    os.makedirs(folder, exist_ok=True)
    columns = list(zip(*rows)) if rows else [[]] * 4
    docs = {"doc_id": pa.array(columns[0], pa.int64()), "text": pa.array(columns[1], pa.string()),
            "lang": pa.array(columns[2], pa.string()), "source": pa.array(columns[3], pa.string()),
            "n_chars": pa.array([None] * len(rows), pa.int64())}
    # Names that operators use themselves.
    for name in ("shard", "slot", "size", "kept", "key", "row", "id", "class_id", "copies", "rank"):
        docs[name] = pa.array(["x"] * len(rows), pa.string())
    pq.write_table(pa.table(docs), f"{folder}/documents.parquet")
    columns = list(zip(*items)) if items else [[]] * 2
    pq.write_table(pa.table({"item_id": pa.array(columns[0], pa.string()), "text": pa.array(columns[1], pa.string())}),
                   f"{folder}/benchmark.parquet")
    columns = list(zip(*pages)) if pages else [[]] * 3
    pq.write_table(pa.table({"page_id": pa.array(columns[0], pa.int64()), "url": pa.array(columns[1], pa.string()),
                             "html": pa.array(columns[2], pa.string()), "payload": pa.array(["x"] * len(pages), pa.string())}),
                   f"{folder}/pages.parquet")
    columns = list(zip(*vectors)) if vectors else [[]] * 3
    pq.write_table(pa.table({"vec_id": pa.array(columns[0], pa.int64()), "embedding": pa.array(columns[1], pa.list_(pa.float32())),
                             "label": pa.array(columns[2], pa.int32()), "score": pa.array(["x"] * len(vectors), pa.string())}),
                   f"{folder}/embeddings.parquet")
    return str(folder)


PAGES = [
    [1, "http://a/1", "<html><body><nav><ul><li><a href=1>Home</a></li></ul></nav><article><h1>A title</h1><p>Some words &amp; more,\n of a "
     "story that goes on for a while.<p>Another   part of it, with a number of words.</article><footer>&copy; nobody</footer>"],
    [2, "http://a/2", None], [3, None, ""], [4, "http://a/4\r\nX: y", "plain text, no element"],
    [5, "http://a/5", "<p>same</p>"], [6, "http://a/6", "<p>same</p>"], [7, "http://a/7", "<p>same</p>"], [7, "http://a/7", "<p>same</p>"],
    [None, "http://a/8", "<p>same</p>"], [9, "http://a/9", "<article><p>cut off in a ta<b"],
    [10, "u", "<body><article><h1>Long</h1>" + "<p>Many words stand here, and they go on and on.</p>" * 3000 + "</article></body>"],
]


@pytest.fixture(scope="session")
def rows():
    return brute.corpus()


@pytest.fixture(scope="session")
def folder(rows, tmp_path_factory):
    return write(tmp_path_factory.mktemp("corpus"), rows, brute.benchmark(rows), PAGES, brute.vectors())


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return write(tmp_path_factory.mktemp("empty"), [], [], [], [])
