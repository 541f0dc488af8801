"""Graph search against all products; archives by exact round trips."""

import gzip
import hashlib
import io
import zlib
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from threadloom.llm import hnsw, warc


def vectors(n, dims=16, seed=1):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(8, dims))
    return (centres[rnd.integers(0, 8, n)] + rnd.normal(size=(n, dims)) * 0.7).astype(np.float32)


def exact(ids, x, query, k):
    scores = x.astype(float) @ x[query].astype(float)
    order = sorted((-s, i) for s, i in zip(scores, ids) if i != ids[query])
    return [i for _, i in order[:k]]


@pytest.mark.parametrize("shard_nodes", [10_000, 700])
def test_recall(spark, shard_nodes):
    x = vectors(2500)
    ids = list(range(2500))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = {}
    for r in hnsw.nearest(df, lambda i: i % 50 == 0, k=10, shard_nodes=shard_nodes).collect():
        assert abs(r["score"] - float(x[r["query_id"]].astype(float) @ x[r["vec_id"]].astype(float))) < 1e-9
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert all(sorted(v) == list(range(1, 11)) for v in got.values())
    hits = sum(len(set(got[q].values()) & set(exact(ids, x, q, 10))) for q in range(0, 2500, 50))
    assert len(got) == 50 and hits >= 0.9 * 500


def test_odd_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(0, one), (20, one), (1, one), (2, one), (3, [0.5, 0.0, 0.0]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [float("nan"), 1.0, 0.0]),
            (7, [float("inf"), 0.0, 0.0]), (8, [None, 1.0, 0.0]), (9, []), (None, one), (40, [0.0, 0.0, 0.0]), (10, [1.0, 2.0]), (2, one)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit("clash"), "vector": F.lit(0), "shard": F.lit(1)})
    got = sorted(tuple(r) for r in hnsw.nearest(df, lambda i: i % 20 == 0, k=4).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 2, 1.0), (0, 4, 20, 1.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 2, 1.0), (20, 4, 2, 1.0)]


def test_equal_vectors_in_number(spark):
    rows = [(i, [1.0, 1.0]) for i in range(300)] + [(1000 + i, [1.0, i / 100]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = hnsw.nearest(df, lambda i: i == 7, k=5).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [0, 1, 2, 3, 4]


def test_no_vectors(spark):
    assert hnsw.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), lambda i: i % 20 == 0).count() == 0


LONG = "<p>équal payload</p>\r\n\r\nWARC/1.1\r\n" * 60
PAGES = [
    (1, "http://a/x y\r\nEvil: 1", LONG), (2, "http://b/", LONG), (9, None, LONG), (9, "", LONG), (3, "u", "short"), (4, "u", "short"), (5, "u", None),
    (6, "u", ""), (None, "http://n", LONG), (None, "http://m", "z" * 1000), (7, "é://ü", "x" * 200_000), (8, "u", "y" * 999), (10, "u", "y" * 999),
]


def plain_records():
    latest = {}
    for page, _, html in PAGES:
        if len((html or "").encode()) >= 1000 and page is not None:
            latest[html] = max(page, latest.get(html, page))
    out = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        refers = latest.get(html) if len(data) >= 1000 and latest.get(html) != page else None
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("file_bytes", [16 << 20, 5000])
def test_archives_round_trip(spark, tmp_path, file_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({"payload_bytes": F.lit("clash"), "latest": F.lit(1)})
    got = warc.archive_pages(pages, f"file://{tmp_path}/w", file_bytes=file_bytes).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == plain_records()
    assert {r["html"] for r in got if r["record_type"] == "response"} == {h or "" for _, _, h in PAGES}
    warc.write_monolithic(pages.select("page_id", "url", "html"), f"file://{tmp_path}/m", file_bytes)
    whole = sorted(Path(tmp_path, "m").glob("*.gz"))
    parts = sorted(Path(tmp_path, "w/normalised").glob("*.warc.gz"))
    assert not list(Path(tmp_path, "w/monolithic").glob("*.gz"))
    for p in parts:
        beside = pq.read_table(f"{p}{warc.INDEX_SUFFIX}").to_pylist()
        assert [r["record_no"] for r in beside] == list(range(len(beside)))
        assert all(gzip.decompress(p.read_bytes()[r["offset"] : r["offset"] + r["length"]]).startswith(b"WARC/1.1\r\n") for r in beside)
    assert sum(len(gzip.decompress(p.read_bytes())) for p in whole) == sum(len(gzip.decompress(p.read_bytes())) for p in parts)
    members = 0
    for p in parts:
        data = p.read_bytes()
        while data:
            inflate = zlib.decompressobj(31)
            assert inflate.decompress(data).startswith(b"WARC/1.1\r\n")
            data, members = inflate.unused_data, members + 1
    assert members == len(PAGES)


def test_a_cut_stream_is_an_error():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert list(warc.records_of(io.BytesIO(gzip.compress(record + record)))) == [record, record]
    assert list(warc.records_of(io.BytesIO(gzip.compress(record) + gzip.compress(record)))) == [record, record]
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(gzip.compress(record[:-6]))))


def test_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(none, f"file://{tmp_path}/w").count() == 0


def test_ties_beyond_the_breadth_go_to_the_smaller_ids(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [0.5, ((i * 7919) % 400) / 400]) for i in range(1, 400)]
    got = hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda v: v == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == list(range(1, 21)) and {r["score"] for r in got} == {0.5}


def test_scores_of_double_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1 / 3, 1.0]), (2, [-1e300, 0.0]), (3, [1e-300, 5.0])]
    got = hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda v: v == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 1 / 3), (3, 1e-300), (2, -1e300)]
