"""Steps whose time, memory or shuffled rows must not outgrow the input."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from threadloom.config import NmfConfig, VocabConfig
from threadloom.llm import substring_dedup as sd
from threadloom.operators import features as feat, models, topics as tp

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_document_weights_in_padded_blocks():
    rng = np.random.default_rng(5)
    sizes = [0, 1, 300, 7, 7, 0, 40]
    h = rng.random((4, 500))
    batch = pd.DataFrame(
        {
            "indices": [np.sort(rng.choice(500, n, replace=False)).astype(np.int32) for n in sizes],
            "values": [rng.random(n) for n in sizes],
        }
    )
    config = NmfConfig(k=4, alpha_w=0.01)
    w, rows, cols, vals, model = tp._doc_weights(batch, h, config, 6)
    for d, (indices, values) in enumerate(zip(batch["indices"], batch["values"])):
        want = np.full(4, 0.25)
        for _ in range(6):
            numer = h[:, indices] @ (values / (want @ h[:, indices] + tp.EPS))
            want = want * numer / (h.sum(axis=1) + 0.01 * 0.7 * 500 + 0.01 * 0.3 * 500 * want + tp.EPS)
        assert w[d] == pytest.approx(want, rel=1e-9)
        assert model[rows == d] == pytest.approx(want @ h[:, indices] + tp.EPS, rel=1e-9)
        assert cols[rows == d].tolist() == indices.tolist() and vals[rows == d].tolist() == values.tolist()


def test_documents_are_packed_once_in_even_parts(spark, monkeypatch):
    rng = np.random.default_rng(3)
    docs = [(sorted(rng.choice(30, int(n), replace=False).tolist()), rng.random(int(n)).tolist()) for n in rng.integers(0, 12, 90)] + [([], [])]
    rows = spark.createDataFrame(docs, "indices array<int>, values array<double>")
    cells = sum(len(i) for i, _ in docs)
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(tp, "CELL_PART", 40)
    monkeypatch.setattr(tp, "CELL_ROW", 9)
    packed = tp.packed_documents(rows, cells)
    parts = packed.rdd.getNumPartitions()
    assert parts % cores == 0 and parts * 40 >= cells > (parts - cores) * 40
    got = []
    for r in packed.collect():
        sizes, cols, vals = (np.frombuffer(bytes(b), d) for b, d in zip(r, ("i4", "i4", "f8")))
        assert len(sizes) == 1 or sizes.sum() <= 9
        for a, n in zip(np.cumsum(sizes) - sizes, sizes):
            got.append((cols[a : a + n].tolist(), vals[a : a + n].tolist()))
    assert sorted(got) == sorted(docs)
    config = NmfConfig(k=3, max_iter=4, tol=0.0)
    h, history = tp.fit_nmf(rows, 30, config)
    want = tp._start_topics(30, sum(sum(v) for _, v in docs) / (len(docs) * 30), config)
    batch = pd.DataFrame({"indices": [np.array(i, dtype=np.int32) for i, _ in docs], "values": [np.array(v) for _, v in docs]})
    for _ in range(4):
        w, at, cols, vals, model = tp._doc_weights(batch, want, config, config.inner_steps)
        numer = np.zeros_like(want)
        for t in range(3):
            numer[t] = np.bincount(cols, weights=w[at, t] * vals / model, minlength=30)
        scale = config.alpha_h * len(docs)
        want = want * numer / (w.sum(axis=0)[:, None] + 0.7 * scale + 0.3 * scale * want + tp.EPS)
    assert h == pytest.approx(want, rel=1e-9, abs=1e-300) and len(history) == 4


def test_vectors_of_fitted_documents_come_from_the_counts_of_the_fit(spark):
    words = ["red", "blue", "green", "grey", "pink"]
    rows = [(i, [words[(i + j * j) % 5] for j in range(i % 7)]) for i in range(20)] + [(3, ["red", "red"]), (None, ["blue"])]
    docs = spark.createDataFrame(rows, "doc_id long, toks array<string>")
    vocab = VocabConfig(1, 2, 2, 1.0, 50)
    model = models.fit_topics(docs, "doc_id", "toks", None, vocab, NmfConfig(k=2, max_iter=3))
    other = spark.createDataFrame([(i,) for i in (1, 3, 3, 4, 5, 5, 5, 99, None)], "doc_id long")

    def cells(df):
        return sorted((r["doc_id"], r["indices"], [round(x, 12) for x in r["values"]]) for r in df.collect())

    def made(df):
        terms = feat.model_terms(df, "doc_id", "toks", None, vocab)
        return feat.tfidf_rows(feat.tfidf(terms, model.vocab, "doc_id"), "doc_id")

    known = models.joined_rows(model, other, "doc_id")
    assert cells(known) == cells(made(docs.join(other, "doc_id")))
    assert cells(model.doc_rows.where("doc_id is not null")) == cells(made(docs.where("doc_id is not null")))
    vectors = models.document_vectors(docs, "doc_id", "toks", model, vocab, NmfConfig(k=2), known=model.doc_rows)
    assert "Generate" not in plan_of(vectors) and vectors.count() == len(rows)


def test_blocks_cover_documents_once_and_stay_small():
    sizes = np.array([0] * 50 + [3] * 400 + [20_000, 5, 900])
    order = np.argsort(sizes, kind="stable")
    blocks = list(tp._blocks(order, sizes, 1000))
    assert np.concatenate(blocks).tolist() == order.tolist()
    assert all(len(b) == 1 or len(b) * sizes[b].max() <= 2000 for b in blocks)


def test_own_terms_are_dropped_by_look_up(spark):
    df = spark.createDataFrame([(1, "apple pear apple\n\nplum"), (2, None), (None, "apple")], "id int, text string")
    out = feat.process_text_tfidf(df, "id", "text", quantile=1.0)
    assert "array_contains" not in plan_of(out)
    got = {r["id"]: r["tokens"] for r in out.collect()}
    # terms equal to their stem go; a null id has no terms of its own
    assert got == {1: ["appl", "appl"], 2: [], None: ["appl"]}


def test_layouts_by_document_grow_with_the_text(spark, monkeypatch):
    df = spark.createDataFrame([(i, "aa bb cc\n\naa dd") for i in range(40)], "id int, text string")
    monkeypatch.setattr(feat, "TEXT_PART", 50)
    assert "hashpartitioning(id#" in physical(feat.auto_stop_by_doc(df, "id", "text"))
    assert ", 12), REPARTITION_BY_NUM" in physical(feat.auto_stop_by_doc(df, "id", "text"))
    monkeypatch.setattr(tp, "TOKEN_PART", 20)
    docs = df.select("id", F.split("text", r"\s+").alias("toks"))
    top = spark.createDataFrame([(0, 1, "aa"), (0, 2, "bb")], "topic int, rank int, term string")
    assert ", 10), REPARTITION_BY_NUM" in physical(tp.window_masks(docs, "id", "toks", top, 3))


def test_tfidf_counts_terms_once(spark):
    assert "regexp_extract_all" not in plan_of(entry.queries()["tfidf"](spark, FOLDER)).split("GlobalLimit")[0]


def test_ngrams_are_built_once_and_sorted_without_a_comparator(spark):
    plan = plan_of(entry.queries()["ngrams"](spark, FOLDER))
    assert "array_sort" not in plan
    assert "zip_with" not in "".join(line for line in plan.splitlines() if "Filter" in line)


def test_lemmas_shuffle_lists_and_keep_repeated_ids(spark):
    df = spark.createDataFrame(
        [(1, ["are", "mice"]), (1, ["was"]), (2, []), (None, ["are"]), (3, None), (4, ["are", "x"])], "id int, toks array<string>"
    )
    table = spark.createDataFrame([("are", "v", "be"), ("mice", "n", "mouse")], "word string, pos string, lemma string")
    out = feat.lemmatize(df, "id", "toks", table)
    assert "Generate" not in plan_of(out)
    rows = sorted((r["id"] or 0, r["lemmas"]) for r in out.collect())
    both = ["be", "was", "mouse"]
    assert rows == [(0, []), (1, both), (1, both), (2, []), (3, []), (4, ["be", "x"])]


def test_least_places_are_those_of_argmin():
    rng = np.random.default_rng(9)
    for width in (1, 2, 5, 10, 13):
        values = rng.integers(0, 6, 200).astype(np.uint64)
        windows = np.lib.stride_tricks.sliding_window_view(values, width)
        assert sd.least_places(values, width).tolist() == (windows.argmin(axis=1) + np.arange(len(windows))).tolist()
        assert len(sd.least_places(values[:width], width)) == 1
