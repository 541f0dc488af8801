import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from threadloom.functions.numeric import ranked_by_hash, running_totals
from threadloom.operators import emotion as emo, evaluate as ev, labels as lb, sampling as sp


@pytest.fixture(scope="module")
def lexicon(spark):
    rows = [("scared", "fear", "1"), ("scared", "negative", "1"), ("Happy ", "joy", "1"), ("happy", "positive", "1"), ("happy", "fear", "0")]
    return emo.build_lexicon(spark.createDataFrame(rows, "word string, emotion string, score string"))


def test_emotion_scores(spark, lexicon):
    df = spark.createDataFrame([("d", "I am very scared, not happy"), ("e", ""), ("n", "hello")], "post_id string, text string")
    got = {r["post_id"]: r for r in emo.score_emotions(df, lexicon, "post_id").collect()}
    d = got["d"]
    assert d["raw"] == pytest.approx(3.0)
    assert d["norm"] == pytest.approx(0.852277, abs=1e-6)
    assert d["label"] == 4
    assert (d["emo_counts"]["fear"], d["emo_counts"]["negative"], d["emo_counts"]["joy"]) == (2, 2, 0)
    assert (got["e"]["norm"], got["e"]["label"]) == (0.0, 0)
    assert (got["n"]["norm"], got["n"]["label"]) == (0.5, 2)


def test_window_is_three_tokens(spark, lexicon):
    df = spark.createDataFrame([("a", "not x y scared"), ("b", "not x y z scared"), ("c", "no not very so scared")], "post_id string, text string")
    got = {r["post_id"]: r["w_fear"] for r in emo.emotion_weights(df, lexicon, "post_id", F.regexp_extract_all("text", F.lit("[a-z]+"), F.lit(0))).collect()}
    assert got == {"a": -1.0, "b": 1.0, "c": -1.5}


def test_top_emotions_ties_keep_list_order(one):
    counts = F.create_map(*[F.lit(x) for kv in {e: 0 for e in emo.ref.EMOTIONS}.items() for x in kv])
    counts = F.map_zip_with(counts, F.create_map(F.lit("trust"), F.lit(2), F.lit("fear"), F.lit(2), F.lit("joy"), F.lit(5)), lambda k, a, b: F.coalesce(b, a))
    got = one(emo.top_emotions(counts))
    assert [r["emotion"] for r in got] == ["joy", "fear", "trust"]


def test_measures(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "label int, score double")
    row = ev.measure(df).first()
    assert row["auc"] == pytest.approx(0.625)
    assert row["ap"] == pytest.approx(0.583333, abs=1e-6)
    best = ev.best_threshold(df).first()
    assert (best["threshold"], round(best["f1"], 6)) == (0.4, 0.8)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=4, max_size=60))
def test_auc_matches_pairs_and_flips(spark, rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    df = spark.createDataFrame([(y, s / 20) for y, s in rows], "label int, score double")
    got = ev.roc_auc(df).first()["auc"]
    if not pos or not neg:
        assert got is None
        return
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(want)
    flipped = ev.roc_auc(df.withColumn("label", 1 - F.col("label"))).first()["auc"]
    assert flipped == pytest.approx(1 - want)


def test_running_totals_on_skewed_values(spark):
    values = [(10.0 ** -(i % 50), i % 7) for i in range(500)]
    df = spark.createDataFrame(values, "v double, n int").groupBy("v").agg(F.sum("n").alias("n"))
    got = {r["v"]: r["t"] for r in running_totals(df, "v", {"n": "t"}).collect()}
    total, want = 0, {}
    sums = {r["v"]: r["n"] for r in df.collect()}
    for v in sorted(sums, reverse=True):
        total += sums[v]
        want[v] = total
    assert got == want


def test_hash_ranks_are_complete(spark):
    df = spark.range(2000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.col("id").alias("doc"))
    ranks = ranked_by_hash(df, ["g"], "doc", 7).groupBy("g").agg(
        F.count_distinct("rank").alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"), F.max("rank_of").alias("of")
    ).collect()
    for r in ranks:
        assert r["lo"] == 1 and r["n"] == r["hi"] == r["of"]


def test_quota_sample(spark):
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") < 30, "a").otherwise("b").alias("g"))
    got = {r["g"]: r["count"] for r in sp.quota_sample(df, "id", "g", 50, 5).groupBy("g").count().collect()}
    assert got == {"a": 17, "b": 33}
    with pytest.raises(ValueError):
        sp.quota_sample(df.where("id < 0"), "id", "g", 50, 5)


def test_split_and_folds_are_balanced(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    split = sp.stratified_split(df, "id", "y", {"train": 0.6, "cal": 0.2, "test": 0.2})
    got = {(r["split"], r["y"]): r["count"] for r in split.groupBy("split", "y").count().collect()}
    assert got == {("train", 0): 240, ("cal", 0): 80, ("test", 0): 80, ("train", 1): 60, ("cal", 1): 20, ("test", 1): 20}
    sizes = sp.folds(df, "id", "y").groupBy("repeat", "fold").count().collect()
    assert len(sizes) == 10 and {r["count"] for r in sizes} == {100}


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    got = {r["y"]: r["weight"] for r in sp.class_weights(df, "y").collect()}
    assert got == {0: pytest.approx(4 / 6), 1: pytest.approx(2.0)}


def test_bootstrap_is_repeatable_and_near(spark):
    df = spark.range(300).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("label"), ((F.col("id") * 37 % 100) / 100 + F.when(F.col("id") % 3 == 0, 0.2).otherwise(0.0)).alias("score"))
    a = {r["metric"]: (r["mean"], r["lo"], r["hi"]) for r in ev.bootstrap_ci(df, "id", n_boot=200).collect()}
    b = {r["metric"]: (r["mean"], r["lo"], r["hi"]) for r in ev.bootstrap_ci(df, "id", n_boot=200).collect()}
    assert a["auc"] == pytest.approx(b["auc"]) and a["ap"] == pytest.approx(b["ap"])
    auc = ev.roc_auc(df).first()["auc"]
    mean, lo, hi = a["auc"]
    assert lo < auc < hi and abs(mean - auc) < 0.02


def test_parse_response(spark):
    raws = ['```json\n{"category": "ANXIETY", "severity": 4, "confidence": 0.9}\n```', "oops", "{}", '```\n{"category": "X"}\n```', "[1]",
            '{"category": null, "severity": 3.7}']
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    got = [(r["ai_category"], r["ai_severity"], r["ai_confidence"]) for r in lb.parse_response(df).orderBy("i").collect()]
    assert got == [("ANXIETY", 4, 0.9), ("ERROR", 0, 0.0), ("ERROR", 0, 0.0), ("X", 0, 0.0), ("ERROR", 0, 0.0), (None, 3.7, 0.0)]


def test_combined_prefers_hand(spark):
    hand = spark.createDataFrame([("p1", 0)], "post_id string, label int")
    ai = spark.createDataFrame([("p1", 1), ("p2", 1)], "post_id string, label int")
    assert {r["post_id"]: r["label"] for r in lb.combined(hand, ai).collect()} == {"p1": 0, "p2": 1}


def test_label_rules(spark):
    hand = spark.createDataFrame([("a", "4"), ("b", "3.9"), ("c", "n/a"), ("d", None)], "post_id string, anxiety_rating string")
    assert {r["post_id"]: r["label"] for r in lb.hand_labels(hand).collect()} == {"a": 1, "b": 0, "c": 0, "d": 0}
    ai = spark.createDataFrame(
        [("a", "Panic", "4", "0.5"), ("b", "ANXIETY", "5", "bad"), ("c", "OTHER", "5", "1"), ("d", "NOT_ANXIETY", "4", "0.9")],
        "post_id string, ai_category string, ai_severity string, ai_confidence string",
    )
    assert {r["post_id"]: r["label"] for r in lb.ai_labels(ai).collect()} == {"a": 1, "b": 0, "c": 0, "d": 1}


def test_prompt_budget(spark):
    df = spark.createDataFrame([("g", "t" * 300, "x" * 5000)], "subreddit string, title string, text_all string")
    long = lb.build_prompt(df).first()["prompt"]
    short = lb.build_prompt(df, max_tokens=100).first()["prompt"]
    assert long.count("t" * 200) == 1 and "t" * 201 not in long
    assert len(long) - len(short) == 500


def test_nll_of_impossible_class(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (0, [0.5, 0.5])], "label int, probs array<double>")
    got = sorted(r["nll"] for r in ev.nll(df).collect())
    assert got[0] == pytest.approx(math.log(2)) and math.isinf(got[1])


def test_a_large_lexicon_gives_the_same_scores(spark, monkeypatch):
    from threadloom.operators import emotion

    lexicon = emotion.build_lexicon(spark.createDataFrame([("the", "fear", "1"), ("happy", "joy", "1")], "word string, emotion string, score string"))
    docs = spark.createDataFrame([(1, "the very happy the"), (2, ""), (3, "nothing here"), (4, "not the")], "id int, text string")

    def scores():
        return sorted(map(tuple, emotion.score_emotions(docs, lexicon, "id").select("id", "n_tokens", "raw", "norm").collect()))

    broadcast = scores()
    monkeypatch.setattr(emotion, "BROADCAST_ROWS", 0)
    assert scores() == broadcast and len(broadcast) == 4
    keys = emotion.matches(docs, lexicon, "id", emotion.alpha_tokens("text")).where("word = ''")
    assert keys.where("pos >= 0").isEmpty()


def test_bootstrap_equals_plain_weights(spark):
    """Each replicate against weighted measures over all rows, whatever the ranges and blocks."""
    import numpy as np

    df = spark.range(60).select(F.col("id"), (F.col("id") * 7 % 5 < 2).cast("int").alias("label"), (F.col("id") * 13 % 17 / 17.0).alias("score"))
    rows = df.select(F.xxhash64("id").alias("h"), "label", "score").collect()
    w = ev.poisson_weights(np.array([r["h"] for r in rows]), 40, 42)
    assert 0.9 < w.mean() < 1.1
    y, s = np.array([r["label"] for r in rows]), np.array([r["score"] for r in rows])
    want = {}
    for b in range(40):
        wp, wn = w[:, b] * (y == 1), w[:, b] * (y == 0)
        won = sum(wp[i] * wn[j] * ((s[i] > s[j]) + 0.5 * (s[i] == s[j])) for i in range(60) for j in range(60))
        ap = sum(wp[s == t].sum() / wp.sum() * wp[s >= t].sum() / max((wp + wn)[s >= t].sum(), 1) for t in set(s))
        want[b + 1] = (won / (wp.sum() * wn.sum()), ap)
    for parts, block in ((1, 2000), (4, 3)):
        got = {r["replicate"]: (r["auc"], r["ap"]) for r in ev.bootstrap(df, "id", n_boot=40, parts=parts, block=block).collect()}
        assert all(got[k] == pytest.approx(want[k]) for k in want) and len(got) == 40
