"""Counts of a bounded vocabulary beside counts of all n-grams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.config import VocabConfig
from threadloom.operators import counts, features as feat
from threadloom.session import materialize


def plain(docs, stops, config):
    terms = feat.model_terms(docs, "id", "toks", stops, config)
    return terms, feat.fit_vocab(terms, F.lit(docs.count()), config)


def weights(df):
    return sorted((r["id"] is None, r["id"] or 0, r["term"], r["term_id"], round(r["weight"], 12)) for r in df.collect())


def same(docs, stops, config):
    terms, want = plain(docs, stops, config)
    vocab, cells = feat.fit_terms(docs, "id", "toks", stops, config)
    assert sorted(map(tuple, vocab.collect())) == sorted(map(tuple, want.collect()))
    assert weights(feat.counted_tfidf(cells, vocab, "id")) == weights(feat.tfidf(terms, want, "id"))
    return vocab


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):  # parts differ in their words; ids come twice or are null; some have no words
        words = rng.zipf(1.4, int(rng.integers(0, 40))) % 60 + 20 * (i // 100)
        rows.append((None if i % 41 == 0 else i % 350, None if i % 37 == 0 else [f"w{w}" for w in words]))
    return materialize(spark.createDataFrame(rows, "id long, toks array<string>").coalesce(4), "test-docs")


@pytest.mark.parametrize(
    "config",
    [
        VocabConfig(1, 2, 3, 0.9, 30), VocabConfig(1, 2, 2, 0.02, 25), VocabConfig(1, 1, 0.01, 1.0, 12), VocabConfig(2, 2, 1, 1.0, 5000),
        VocabConfig(1, 3, 2, 1.0, 40), VocabConfig(1, 2, 500, 1.0, 10),
    ],
)
def test_vocabulary_and_counts_are_those_of_all_ngrams(docs, config):
    same(docs, ["w1", "w25"], config)


def test_tokens_that_hold_blanks_or_nothing_are_counted_too(spark):
    rows = [(1, ["a b", "c"]), (2, ["a", "b c"]), (3, ["a", "b", None, "c"]), (3, []), (4, ["a b"]), (None, ["a", "b"])]
    same(spark.createDataFrame(rows, "id long, toks array<string>").where("id is null or id <> 3"), None, VocabConfig(1, 2, 1, 1.0, 50))
    assert len(feat.fit_terms(spark.createDataFrame(rows, "id long, toks array<string>"), "id", "toks", None, VocabConfig(1, 2, 2, 1.0, 50))) == 2


def test_terms_spread_over_all_tasks_are_found(docs, monkeypatch):
    passes, used = [], counts._used
    monkeypatch.setattr(counts, "_used", lambda d, c, share=None: passes.append(share) or used(d, c, share))
    monkeypatch.setattr(counts, "NAMED", 1)
    monkeypatch.setattr(counts, "HELD", 50)
    same(docs, None, VocabConfig(1, 2, 1, 1.0, 20))
    assert any(passes), "a bound of the tasks over the least wanted asks for the second pass"


def test_a_vocabulary_that_is_not_full_asks_for_more_candidates(spark, monkeypatch):
    rows = [(i, ["x", "y", "z"] * 9 + [f"r{i % 40}"]) for i in range(200)]  # the most used terms are in too many documents
    asked, found = [], counts._candidates
    monkeypatch.setattr(counts, "_candidates", lambda *a: asked.append(a[-1]) or found(*a))
    docs = materialize(spark.createDataFrame(rows, "id long, toks array<string>"), "test-docs")
    assert same(docs, None, VocabConfig(1, 2, 1, 0.5, 4)).count() == 4
    assert len(asked) > 1


def test_only_counts_of_the_vocabulary_are_written(docs, monkeypatch):
    written = []
    monkeypatch.setattr(feat, "materialize", lambda df, label: written.append(label) or materialize(df, label))
    feat.fit_terms(docs, "id", "toks", None, VocabConfig(1, 2, 2, 1.0, 20))
    assert "doc-terms" not in written
