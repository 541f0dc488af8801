"""Queries that write tables and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.config import PullConfig
from threadloom.operators import merge
from threadloom.plans.catalog_emotion import LEXICON
from threadloom.plans.catalog_tokens import quoted
from threadloom.plans.registry import query
from threadloom.plans.tables import COMMENTS, POSTS, with_ctes
from threadloom.session import path_exists, scratch_path
from threadloom.sources import readers, writers

POST_COLUMNS = [c.split(" ")[0] for c in schemas.POSTS.split(", ")]
SEEN = "SELECT post_id, subreddit, md5(title) AS title_md5, md5(selftext) AS text_md5, score, over_18, removed_by_category FROM posts"


def seen(df):
    return df.select(
        "post_id", "subreddit", F.md5("title").alias("title_md5"), F.md5("selftext").alias("text_md5"),
        "score", "over_18", "removed_by_category",
    )


@query("roundtrip_jsonl", with_ctes(POSTS, SEEN))
def roundtrip_jsonl(t):
    path = scratch_path(t.spark, "posts-jsonl")
    writers.write_jsonl(t.posts().select(POST_COLUMNS), path)
    return seen(readers.read_jsonl(t.spark, path, schemas.POSTS))


@query("head_jsonl", "SELECT 25 AS n_rows, 25 AS n_known")
def head_jsonl(t):
    """Twenty-five rows, all of them known posts."""
    path = scratch_path(t.spark, "posts-head")
    writers.write_jsonl(t.posts().select(POST_COLUMNS), path)
    head = readers.head_jsonl(t.spark, path, 25, schemas.POSTS).select("post_id")
    known = t.posts().select("post_id", F.lit(1).alias("known"))
    return head.join(known, "post_id", "left").agg(
        F.count(F.lit(1)).cast("int").alias("n_rows"), F.count("known").cast("int").alias("n_known")
    )


@query("roundtrip_parquet", with_ctes(POSTS, SEEN))
def roundtrip_parquet(t):
    path = scratch_path(t.spark, "posts-parquet")
    writers.write_parquet(t.posts(), path, POST_COLUMNS, partition_by=["subreddit"])
    return seen(readers.read_parquet(t.spark, path, schemas.POSTS))


@query("roundtrip_csv", with_ctes(POSTS, SEEN))
def roundtrip_csv(t):
    path = scratch_path(t.spark, "posts-csv")
    writers.write_csv(t.posts().select(POST_COLUMNS), path)
    return seen(readers.read_csv(t.spark, path, schemas.POSTS))


@query("scan_any", with_ctes(POSTS, SEEN))
def scan_any(t):
    """Parquet to CSV by the converter, read back by extension."""
    base = scratch_path(t.spark, "convert")
    writers.write_parquet(t.posts(), f"{base}/posts.parquet", POST_COLUMNS)
    writers.convert(t.spark, f"{base}/posts.parquet", f"{base}/posts.csv")
    return seen(readers.read_any(t.spark, f"{base}/posts.csv", schemas.POSTS))


@query(
    "scan_preferred",
    with_ctes(POSTS, "SELECT 'enriched' AS source, count(*) AS n, count(*) AS n_scores FROM posts UNION ALL SELECT 'base', count(*), 0 FROM posts"),
)
def scan_preferred(t):
    """The enriched table once it is written, the base table before that."""
    base = scratch_path(t.spark, "preferred")
    writers.write_parquet(t.posts(), f"{base}/base", POST_COLUMNS)
    before, _ = readers.read_preferred(t.spark, f"{base}/enriched", f"{base}/base")
    writers.write_parquet(t.posts().withColumn("anxiety_score", F.lit(0.5)), f"{base}/enriched")
    after, _ = readers.read_preferred(t.spark, f"{base}/enriched", f"{base}/base")

    def count(name, df):
        return df.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("n"), F.count("anxiety_score").alias("n_scores"))

    return count("enriched", after).unionByName(count("base", before))


_LEX = "lex(word, emotion, score) AS (VALUES " + ", ".join(f"({quoted(w)}, {quoted(e)}, {quoted(s)})" for w, e, s in LEXICON) + ")"


@query(
    "lexicon_scan",
    with_ctes(
        _LEX,
        "k AS (SELECT lower(word) AS word, string_agg(emotion, ' ' ORDER BY emotion) AS emotions FROM lex WHERE score = '1' AND emotion <> 'other' GROUP BY lower(word))",
        "n AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)",
        "SELECT word, emotions, count(*) AS n FROM n JOIN k USING (word) GROUP BY word, emotions",
    ),
)
def lexicon_scan(t):
    """Occurrences of the words of a lexicon read from its file."""
    path = scratch_path(t.spark, "lexicon")
    rows = t.spark.createDataFrame(LEXICON, schemas.LEXICON)
    rows.write.option("sep", "\t").csv(path)
    lex = readers.read_lexicon(t.spark, path).select("word", F.array_join(F.array_sort("emotions"), " ").alias("emotions"))
    words = t.read("documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return words.join(F.broadcast(lex), "word").groupBy("word", "emotions").agg(F.count(F.lit(1)).alias("n"))


@query(
    "metrics_sink",
    """SELECT 'range' AS section, 'min_value' AS metric, CAST(min(o_custkey) AS VARCHAR) AS value FROM orders
    UNION ALL SELECT 'range', 'max_value', CAST(max(o_custkey) AS VARCHAR) FROM orders
    UNION ALL SELECT 'range', 'n_outside', CAST(count(*) FILTER (WHERE o_custkey < 10 OR o_custkey > 500) AS VARCHAR) FROM orders""",
)
def metrics_sink(t):
    from threadloom.operators.posts import assert_range

    path = scratch_path(t.spark, "metrics")
    writers.write_metrics(writers.metrics_frame(assert_range(t.read("orders"), "o_custkey", 10, 500), "range"), path)
    return readers.read_jsonl(t.spark, path, schemas.METRICS)


@query(
    "post_docs",
    with_ctes(
        POSTS, COMMENTS,
        """top AS (SELECT link_id, string_agg(body, chr(10) || chr(10) ORDER BY rank) AS txt, count(*) AS n FROM (
          SELECT link_id, body, row_number() OVER (PARTITION BY link_id ORDER BY score DESC, comment_id) AS rank
          FROM comments WHERE length(body) >= 10 AND body NOT IN ('[deleted]', '[removed]')) WHERE rank <= 3 GROUP BY link_id)""",
        """SELECT 'doc_' || post_id AS doc_id, md5(concat_ws(chr(10) || chr(10), nullif(title, ''), nullif(selftext, ''), nullif(txt, ''))) AS text_md5,
          CAST(coalesce(n, 0) AS INTEGER) AS n_comments FROM posts LEFT JOIN top ON link_id = post_id""",
    ),
)
def post_docs(t):
    path = scratch_path(t.spark, "post-docs")
    docs = writers.post_docs(t.posts(), merge.top_comments(t.comments(), PullConfig().top_k))
    writers.write_jsonl(docs, path)
    schema = "doc_id string, text string, submission_id string, metadata struct<subreddit:string,created_utc:double,score:bigint,n_comments:int>"
    return readers.read_jsonl(t.spark, path, schema).select("doc_id", F.md5("text").alias("text_md5"), "metadata.n_comments")


@query("append_batches", with_ctes(POSTS, "SELECT post_id, subreddit FROM posts"))
def append_batches(t):
    """Two runs over the same rows leave each row once."""
    path = scratch_path(t.spark, "batches")
    rows = t.posts().select("post_id", "subreddit")
    writers.append_batches(rows, path, "post_id", 3)
    writers.append_batches(rows, path, "post_id", 3)
    assert path_exists(t.spark, path)
    return readers.read_parquet(t.spark, path).select("post_id", "subreddit")


