import pytest
from pyspark.sql import functions as F

from threadloom.config import PullConfig
from threadloom.operators import merge, posts as po, profile
from threadloom.plans import corpus

POST = "post_id string, subreddit string, created_utc double, title string, selftext string, num_comments bigint, over_18 boolean, removed_by_category string"
COMMENT = "comment_id string, link_id string, parent_id string, body string, created_utc double, score bigint, depth int"


def make_posts(spark, rows):
    return spark.createDataFrame(rows, POST)


def make_comments(spark, rows):
    return spark.createDataFrame(rows, COMMENT)


def test_clean_merge(spark):
    posts = make_posts(spark, [
        ("p1", "a", 10.0, "One two three", "four five six seven", 3, False, None),
        ("p2", "a", 5.0, "ONE two three", "four five six  seven", 0, False, None),
        ("p3", "a", 1.0, "[removed]", "[deleted]", 0, False, None),
        ("p4", "b", 1.0, "short", "text", 0, False, None),
        ("p5", "b", 1.0, None, "eight words are here to keep this one", 2, False, None),
    ])
    comments = make_comments(spark, [
        ("c1", "p5", "p5", "low", 1.0, 1, 0), ("c2", "p5", "p5", "HIGH u/x", 1.0, 9, 0),
        ("c3", "p5", "c2", "deep", 1.0, 50, 1), ("c4", "p5", "p5", "[removed]", 1.0, 99, 0),
    ])
    rows = {r["post_id"]: r for r in corpus.clean_merge(posts, comments).collect()}
    assert set(rows) == {"p2", "p5"}, "the earlier copy stays"
    assert rows["p5"]["comments_concat"] == "high <cmt> low"
    assert rows["p5"]["comment_count"] == 3
    assert rows["p5"]["text_all"] == "eight words are here to keep this one\n\nhigh <cmt> low"
    assert rows["p2"]["text_main"] == "one two three\n\nfour five six seven"
    assert rows["p5"]["comments_missing"] == 0


def test_default_backfill_cannot_add_comments(spark):
    base = spark.createDataFrame(
        [("p1", 3, 0, "", "main", "main"), ("p2", 3, 1, "", "main", "main")],
        "post_id string, num_comments bigint, comment_count int, comments_concat string, text_main string, text_all string",
    )
    comments = spark.createDataFrame([("p2", "c1", 5, "found")], "post_id string, comment_id string, score bigint, body_clean string")
    rows = {r["post_id"]: r for r in merge.backfill(base, comments).collect()}
    assert (rows["p1"]["comments_concat"], rows["p1"]["text_all"]) == ("", "main")
    assert rows["p2"]["text_all"] == "main"
    by_text = {r["post_id"]: r for r in merge.backfill(base, comments, by_text=True).collect()}
    assert by_text["p2"]["text_all"] == "main\n\nfound"
    assert po.flag_missing(base).where("comments_missing = 1").count() == 1


def test_dedupe_is_idempotent(spark):
    df = spark.createDataFrame([(i, f"t{i % 3}", i % 5) for i in range(30)], "post_id int, text_all string, created_dt int")
    once = merge.dedupe_first(df)
    assert once.count() == 3
    assert sorted(merge.dedupe_first(once).collect()) == sorted(once.collect())


def test_tree_prunes_below_a_removed_comment(spark):
    tree = make_comments(spark, [
        ("a", "p", "p", "x", 1.0, 1, 0), ("b", "p", "a", "[removed]", 1.0, 1, 1), ("c", "p", "b", "y", 1.0, 1, 2),
        ("d", "p", "a", "z", 1.0, 1, 1), ("e", "p", "d", "z", 1.0, 1, 2),
    ])
    got = {r["comment_id"]: r["depth"] for r in merge.flatten_tree(tree).collect()}
    assert got == {"a": 0, "d": 1, "e": 2}


def thread(spark, rows):
    """(id, parent) rows of one thread ``p``."""
    return make_comments(spark, [(i, "p", up, "x", 1.0, 1, 0) for i, up in rows])


def test_a_deep_thread_takes_logarithmic_rounds(spark, monkeypatch):
    written = []
    keep = merge.materialize
    monkeypatch.setattr(merge, "materialize", lambda df, label: written.append(label) or keep(df, label))
    chain = [("c0", "p")] + [(f"c{i}", f"c{i - 1}") for i in range(1, 1000)]
    got = {r["comment_id"]: r["depth"] for r in merge.flatten_tree(thread(spark, chain)).collect()}
    assert got == {f"c{i}": i for i in range(1000)}
    assert written.count("tree-round") == 10, "log2 of 999, rounded up"


def test_hubs_circles_repeats_and_nulls_in_a_thread(spark):
    rows = [("h", "p"), ("x", "y"), ("y", "x"), ("s", "s"), ("below", "x"), ("lost", "absent"), (None, "p"), ("n", None)]
    rows += [(f"r{i}", "h") for i in range(50)] + [("r7", "h")] + [(f"q{i}", f"r{i}") for i in range(50)]
    wanted = {"h": 0} | {f"r{i}": 1 for i in range(50)} | {f"q{i}": 2 for i in range(50)}
    for hub in (1, 8, 1000):
        got = [(r["comment_id"], r["depth"]) for r in merge.flatten_tree(thread(spark, rows), hub).collect()]
        assert sorted(got) == sorted(wanted.items()), hub
    assert merge.flatten_tree(thread(spark, rows).limit(0)).count() == 0


def test_top_comments_filter_language_before_the_cut(spark):
    rows = [(f"c{i}", "p", "p", "bonjour tout le monde" if i % 2 else "good morning to all", float(i), i, 0) for i in range(8)]
    tagged = make_comments(spark, rows).withColumn("said", F.when(F.col("body").startswith("good"), "en").otherwise("fr"))
    assert [r["comment_id"] for r in merge.top_comments(tagged, 3, lang="said").orderBy("rank").collect()] == ["c6", "c4", "c2"]


def test_top_n_beyond_the_pruned_limit(spark):
    df = spark.range(3000).select(F.lit("hot").alias("g"), F.col("id"))
    got = merge.top_n_per_group(df, ["g"], [F.col("id").desc()], 1500, salts=8)
    assert got.count() == 1500
    assert got.agg(F.min("id")).first()[0] == 1500


def test_map_side_rank_limit_is_planned(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = merge.top_n_per_group(df, ["g"], [F.col("id")], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, "ranks are cut before the shuffle too"


def test_filter_reason_counts_once(spark):
    day = 86400.0
    rows = [
        ("old", "a", 0.0, "t", "x" * 9, 0, True, "mod"), ("adult", "a", 400 * day, "title", "text", 0, True, "mod"),
        ("gone", "a", 400 * day, "title", "text", 0, False, "mod"), ("fr", "a", 400 * day, "titre", "texte", 0, False, None),
        ("tiny", "a", 400 * day, "ti", "", 0, False, None), ("ok", "a", 400 * day, "title", "", 0, False, None),
    ]
    posts = po.normalize_posts(make_posts(spark, rows)).withColumn(
        "title_lang", F.when(F.col("post_id") == "fr", "fr").otherwise("en")
    ).withColumn("selftext_lang", F.lit("fr"))
    end = F.timestamp_seconds(F.lit(410 * 86400))
    got = {r["post_id"]: r["reason"] for r in po.filter_reason(posts, end, PullConfig(months_back=1)).collect()}
    assert got == {"old": "time", "adult": "nsfw", "gone": "removed", "fr": "non_english", "tiny": "non_english", "ok": "kept"}


def test_parent_id_prefix_and_privacy(spark):
    posts = make_posts(spark, [("p", "a", 1.0, None, None, 0, False, None)]).withColumn("author", F.lit("x")).withColumn(
        "permalink", F.lit("/r/a/comments/p/")).withColumn("score", F.lit(1)).withColumn("upvote_ratio", F.lit(1.0))
    out = po.project_post(posts)
    assert "author" not in out.columns
    assert out.first()["url"].endswith("/r/a/comments/p/")
    com = make_comments(spark, [("c", "p", "t1_abc", "b", 1.0, 1, 0)])
    assert po.project_comment(com).first()["parent_id"] == "abc"


def test_first_present(spark):
    df = spark.createDataFrame([("a",)], "text_main string")
    assert po.first_present(df, ["text_all", "text_main"]) == "text_main"
    with pytest.raises(ValueError):
        po.first_present(df, ["nothing"])


def test_histogram_closes_the_right_end(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "v double")
    got = {r["bin"]: r["n"] for r in profile.histogram(df, "v", 5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    flat = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert profile.histogram(flat, "v", 5).first()["n"] == 2


def test_crosstab_order(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "y"), ("b", "x")], "r string, c string")
    out = profile.crosstab(df, "r", "c")
    assert [r["r"] for r in out.collect()] == ["b", "a"]
    assert out.where("r = 'a'").first()["y"] == 0
