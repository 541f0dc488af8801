import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.config import NmfConfig, VocabConfig
from threadloom.operators import features as feat, models, topics as tp

LOOSE = VocabConfig(ngram_lo=1, ngram_hi=1, min_df=1, max_df=1.0, max_features=100)


def tokens(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "id int, toks array<string>")


def test_tfidf(spark):
    docs = tokens(spark, [["x", "x", "y"], ["y"]])
    terms = feat.model_terms(docs, "id", "toks", None, LOOSE)
    vocab = feat.fit_vocab(terms, F.lit(2), LOOSE)
    got = {(r["id"], r["term"]): r["weight"] for r in feat.tfidf(terms, vocab, "id").collect()}
    assert got[(0, "x")] == pytest.approx(0.921907, abs=1e-6)
    assert got[(0, "y")] == pytest.approx(0.387411, abs=1e-6)
    assert got[(1, "y")] == pytest.approx(1.0)


def test_tfidf_shuffles_documents_once(spark):
    docs = tokens(spark, [["x", "y"], ["y", "z"]])
    terms = feat.model_terms(docs, "id", "toks", None, LOOSE)
    vocab = spark.createDataFrame([("x", 0, 1.0), ("y", 1, 1.0)], "term string, term_id int, idf double")
    rows = feat.tfidf_rows(feat.tfidf(terms, vocab, "id"), "id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_vocabulary_bounds(spark):
    docs = tokens(spark, [["a", "b"], ["a", "b", "c"], ["a", "c", "c"], ["a"]])
    terms = feat.doc_terms(docs, "id", "toks")
    config = VocabConfig(min_df=2, max_df=0.75, max_features=1)
    got = feat.fit_vocab(terms, F.lit(4), config).collect()
    assert [r["term"] for r in got] == ["c"], "a is too frequent, c is used more than b"


def test_npmi(spark):
    docs = tokens(spark, [["a", "b"], ["a", "b"], ["a"], ["c"]])
    top = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (0, 3, "c")], "topic int, rank int, term string")
    row = tp.coherence_npmi(docs, "id", "toks", top).first()
    assert row["npmi"] == pytest.approx(0.415037, abs=1e-6)
    assert row["n_pairs"] == 1


def test_window_masks_match_listed_windows(spark):
    rng = np.random.default_rng(3)
    rows = [[str(w) for w in rng.choice(list("abcxyz"), size=n)] for n in (3, 9, 25, 60, 0)]
    docs = tokens(spark, rows)
    top = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (1, 1, "b"), (1, 2, "c")], "topic int, rank int, term string")
    size = 7
    want: dict[tuple[int, int], int] = {}
    words = {0: ["a", "b"], 1: ["b", "c"]}
    for row in rows:
        if not row:
            continue
        for s in range(max(len(row) - size, 0) + 1):
            window = set(row[s : s + size])
            for topic, ws in words.items():
                mask = sum(1 << i for i, w in enumerate(ws) if w in window)
                if mask:
                    want[(topic, mask)] = want.get((topic, mask), 0) + 1
    got = {(r["topic"], r["masks"][0]): r["n"] for r in tp.window_masks(docs, "id", "toks", top, size).collect()}
    assert got == want


def test_nmf_lowers_the_objective_and_finds_planted_topics(spark):
    rows = [["cat", "dog", "pet"] * 3 if i % 2 else ["car", "road", "bus"] * 3 for i in range(40)]
    docs = tokens(spark, rows)
    config = NmfConfig(k=2, alpha_h=0.0, max_iter=25, inner_steps=20, tol=0.0)
    model = models.fit_topics(docs, "id", "toks", None, LOOSE, config, top_n=3)
    assert (model.matrix >= 0).all()
    drops = np.diff(model.history)
    assert (drops <= 1e-6 * abs(model.history[0])).all()
    words = {frozenset(r["term"] for r in model.top.where(F.col("topic") == k).collect()) for k in range(2)}
    assert words == {frozenset({"cat", "dog", "pet"}), frozenset({"car", "road", "bus"})}
    again = models.fit_topics(docs, "id", "toks", None, LOOSE, config, top_n=3)
    assert np.allclose(again.matrix, model.matrix)
    vectors = models.document_vectors(docs, "id", "toks", model, LOOSE, config)
    assigned = tp.assign_topics(vectors, model.names)
    assert assigned.groupBy("topic").count().select("count").distinct().first()[0] == 20
    purity = tp.purity(vectors, threshold=0.4).first()["purity"]
    assert 0.0 <= purity <= 1.0


def test_topic_similarity_includes_disjoint_pairs(spark):
    table = spark.createDataFrame([(0, "a", 1.0), (1, "a", 2.0), (1, "b", 0.0), (2, "z", 1.0)], "topic int, term string, weight double")
    got = {(r["i"], r["j"]): r["sim"] for r in tp.topic_similarity(table).collect()}
    assert got == {(0, 1): pytest.approx(1.0), (0, 2): 0.0, (1, 2): 0.0}
    assert tp.mean_topic_cosine(table).first()[0] == pytest.approx(1 / 3)
    assert tp.mean_topic_cosine(table.where("topic = 0")).first()[0] == 0.0


def test_purity_of_scalars(spark):
    df = spark.createDataFrame([(0.9,), (0.1,), (float("nan"),), (0.4,)], "p double")
    assert tp.purity(df, "p").first()[0] == 0.5


def test_auto_stop_quantile(spark):
    text = "aa bb\n\naa cc"
    df = spark.createDataFrame([(1, text)], "id int, text string")
    rows = feat.auto_stop_by_doc(df, "id", "text").collect()
    assert [(r["term"], r["idf"]) for r in rows] == [("aa", pytest.approx(1.0))]
    corpus = feat.auto_stop_corpus(spark.createDataFrame([("aa bb",), ("aa cc",)], "text string"), "text").collect()
    assert [r["term"] for r in corpus] == ["aa"]


def test_process_text_variants(spark):
    df = spark.createDataFrame([(1, "The people aren't running 5km, zebra zebra")], "id int, text string")
    base = feat.process_text(df, "text", ["zebra"]).first()["tokens"]
    assert base == ["run", "km", "zebra", "zebra"], "extra words are ignored here"
    switched = feat.process_text_switch(df, "id", "text", False, ["zebra"]).first()["tokens"]
    assert switched == ["run", "km"]


def test_lemmatize(spark):
    df = tokens(spark, [["was", "mice", "ok"], []])
    table = spark.createDataFrame([("was", "v", "be"), ("mice", "n", "mouse"), ("was", "n", "wa")], "word string, pos string, lemma string")
    got = {r["id"]: r["lemmas"] for r in feat.lemmatize(df, "id", "toks", table).collect()}
    assert got == {0: ["be", "mouse", "ok"], 1: []}
    assert feat.lemmatize(df, "id", "toks").first()["lemmas"] == ["was", "mice", "ok"]


def test_language_detection(spark):
    train = spark.createDataFrame([("the house and the garden", "en"), ("das haus und der garten", "de")], "text string, lang string")
    profiles = feat.language_profiles(train, "text", "lang")
    df = spark.createDataFrame([(1, "the garden"), (2, "der garten"), (3, "123")], "id int, text string")
    got = {r["id"]: r["detected"] for r in feat.detect_lang(df, "id", "text", profiles).collect()}
    assert got == {1: "en", 2: "de"}


def test_language_column_equals_the_joined_form(spark):
    train = spark.createDataFrame(
        [("the house and the garden a b", "en"), ("das haus und der garten", "de"), ("la maison et le jardin à", "fr")], "text string, lang string"
    )
    profiles = feat.language_profiles(train, "text", "lang", 20)
    texts = [None, "", "123", "A b", "a", "the der", "garten haus", "le  jardin\n\tÀ", "zzz", "DAS-und.THE and the " * 500, "maison", "maison"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    joined = {r["id"]: r["detected"] for r in feat.detect_lang(df, "id", "text", profiles).collect()}
    column = feat.lang_column("text", feat.pack_profiles(profiles))
    got = {r["id"]: r["l"] for r in df.select("id", column.alias("l")).collect()}
    assert {i: l for i, l in got.items() if l} == joined and set(joined.values()) == {"en", "de", "fr"}
    tagged = feat.tag_languages(df, feat.pack_profiles(profiles), {"text": "said"})
    assert {r["id"] for r in tagged.where("said IS NULL").collect()} == {0, 1, 2, 4, 8}
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    empty = feat.pack_profiles(profiles.limit(0))
    assert df.select(feat.lang_column("text", empty).alias("l")).where("l IS NOT NULL").count() == 0


def test_c_tfidf_by_hand(spark):
    df = spark.createDataFrame([(0, ["a", "a", "b"]), (1, ["b"])], "topic int, toks array<string>")
    got = {(r["topic"], r["term"]): r["weight"] for r in tp.c_tfidf(df, "topic", "toks").collect()}
    assert got[(0, "a")] == pytest.approx(2 / 3 * math.log(1 + 2 / 2))
    assert got[(1, "b")] == pytest.approx(math.log(1 + 2 / 2))


def test_clusters(spark):
    rows = [(i, [float(i % 2) * 10 + (i % 5) * 0.01, 0.0, 1.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    out = tp.cluster_embeddings(df, "v", k=2, components=2, threshold=5.0)
    assert out.where("topic = -1").count() == 0
    assert sorted(r["count"] for r in out.groupBy("topic").count().collect()) == [20, 20]
    assert out.where("prob < 0.5").count() == 0


def test_long_word_lists_have_no_limit(spark):
    """80 words a topic: pair counts by document and by window equal a plain count."""
    import random

    rnd = random.Random(1)
    words = [f"w{i:02d}" for i in range(80)]
    texts = [[rnd.choice([*words, "x", "y"]) for _ in range(rnd.randrange(1, 200))] for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, toks array<string>")
    top = spark.createDataFrame([(0, w, i + 1) for i, w in enumerate(words)], "topic int, term string, rank int")
    got = {(r["w1"], r["w2"]): r["n"] for r in tp.cooccurrence(docs, "doc_id", "toks", top, n_words=80).collect()}
    sets = [set(x) for x in texts]
    assert got == {(a, b): sum(a in s and b in s for s in sets) for i, a in enumerate(words) for b in words[i:]}
    windows = [set(x[i : i + 30]) for x in texts for i in range(max(1, len(x) - 29))]
    cells = tp._masks_to_pairs(tp.window_masks(docs, "doc_id", "toks", top, window=30, n_words=80), top)
    got = {(r["w1"], r["w2"]): r["n"] for r in cells.collect()}
    assert got == {(a, b): sum(a in s and b in s for s in windows) for i, a in enumerate(words) for b in words[i:]}
    with pytest.raises(Exception, match="more than 62 words"):
        tp.cooccurrence(docs, "doc_id", "toks", top).collect()


def test_penalty_grows_with_the_documents(spark):
    """One update from the start matrix, worked out with plain arrays."""
    x = np.array([[1.0, 0.0, 2.0], [0.0, 3.0, 1.0], [2.0, 1.0, 0.0]])
    rows = spark.createDataFrame(
        [([int(j) for j in np.flatnonzero(r)], [float(v) for v in r[r > 0]]) for r in x], "indices array<int>, values array<double>"
    )
    config = NmfConfig(k=2, alpha_h=0.1, l1_ratio=0.7, max_iter=1, inner_steps=3)
    for n_docs in (None, 5):  # two documents more that hold no term
        scale = n_docs or 3
        h = tp._start_topics(3, x.sum() / (scale * 3), config)
        w = np.full((3, 2), 0.5)
        for _ in range(3):
            w = w * ((x / (w @ h)) @ h.T) / h.sum(axis=1)
        want = h * (w.T @ (x / (w @ h))) / (w.sum(axis=0)[:, None] + scale * (0.07 + 0.03 * h))
        got, _ = tp.fit_nmf(rows, 3, config, n_docs)
        assert np.allclose(got, want, rtol=1e-6)


def test_documents_without_known_terms_stay(spark):
    docs = tokens(spark, [["a", "b"], ["a", "c"], ["b", "c"], ["zz"], []])
    config = NmfConfig(k=2, max_iter=3, inner_steps=3, alpha_h=0.0)
    model = models.fit_topics(docs.where("id < 3"), "id", "toks", None, LOOSE, config)
    vectors = models.document_vectors(docs, "id", "toks", model, LOOSE, config)
    got = {r["id"]: (r["topic"], r["conf"]) for r in tp.assign_topics(vectors.select("id", "topics"), model.names).collect()}
    assert len(got) == 5 and got[3] == got[4] == (0, 0.0)
