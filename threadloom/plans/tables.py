"""The given tables as posts, comments and labels, in Spark and in SQL.

Both sides derive the same columns from the same tables, so a query and its SQL
twin start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.operators import features as feat

EPOCH = 1704067200
YEAR = 31536000


class Tables:
    """The parquet tables of one folder, plus the frames derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def texts(self) -> DataFrame:
        """``documents``, as the scan's splits deal them.

        The setting ``spark.threadloom.textPartitions`` spreads them over that many
        parts first: of use where a small file holds all rows in one row group, as in
        the benchmark, and a needless shuffle elsewhere.
        """
        docs = self.read("documents")
        spread = self.spark.conf.get("spark.threadloom.textPartitions", None)
        return docs.repartition(int(spread)) if spread else docs

    def posts(self) -> DataFrame:
        """``documents`` as posts: some deleted, removed or adult by id."""
        i = F.col("doc_id")
        return self.texts().select(
            i.cast("string").alias("post_id"),
            F.col("source").alias("subreddit"),
            (F.lit(EPOCH) + (i * 1048573) % YEAR).cast("double").alias("created_utc"),
            F.when((i % 17).isin(3, 4), "[removed]")
            .otherwise(F.split_part("text", F.lit("\n"), F.lit(1)))
            .alias("title"),
            F.when(i % 17 == 3, "[deleted]").otherwise(F.col("text")).alias("selftext"),
            F.lit(None).cast("string").alias("url"),
            F.concat(F.lit("/r/"), "source", F.lit("/comments/"), i.cast("string"), F.lit("/")).alias("permalink"),
            F.col("n_chars").alias("score"),
            (i % 4).alias("num_comments"),
            ((i % 101) / 100.0).alias("upvote_ratio"),
            (i % 11 == 0).alias("over_18"),
            F.when(i % 13 == 0, "moderator").alias("removed_by_category"),
            F.col("lang"),
        )

    def comments(self) -> DataFrame:
        """``conversations`` as comments: three top-level turns, then replies."""
        c, t = F.col("conv_id"), F.col("turn")
        post = c.cast("string")
        return self.read("conversations").select(
            F.concat(post, F.lit("c"), t.cast("string")).alias("comment_id"),
            post.alias("link_id"),
            F.when(t < 3, F.concat(F.lit("t3_"), post))
            .otherwise(F.concat(F.lit("t1_"), post, F.lit("c"), (t - 3).cast("string")))
            .alias("parent_id"),
            F.when((c % 7 == 5) & (t == 1), "[removed]").otherwise(F.col("text")).alias("body"),
            (F.lit(EPOCH) + (c * 1048573) % YEAR + 60 * (t + 1)).cast("double").alias("created_utc"),
            F.length("text").cast("bigint").alias("score"),
            F.floor(t / 3).cast("int").alias("depth"),
            F.col("role"),
        )

    def hand(self) -> DataFrame:
        """``labels`` as ratings by hand."""
        i = F.col("doc_id")
        rating = F.when(i % 23 == 0, "n/a").otherwise(
            F.when(F.col("toxic") == 1, 3 + i % 3).otherwise(i % 5).cast("string")
        )
        docs = self.read("documents").select("doc_id", "source")
        return (
            self.read("labels")
            .join(docs, "doc_id")
            .select(
                i.cast("string").alias("post_id"),
                F.col("source").alias("subreddit"),
                F.col("toxic").alias("anxiety_level"),
                rating.alias("anxiety_rating"),
            )
        )

    def ai(self) -> DataFrame:
        """``documents`` with answers derived from id and length.

        Stands for a set that is labelled in part, so a third has no answer; the
        queries on rows still to be labelled need it.
        """
        i, n = F.col("doc_id"), F.col("n_chars")
        return self.read("documents").where(i % 3 != 1).select(
            i.cast("string").alias("post_id"),
            F.col("source").alias("subreddit"),
            F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
            F.when(n % 5 < 2, "ANXIETY").when(n % 5 < 4, "NOT_ANXIETY").otherwise("PANIC").alias("ai_category"),
            F.when(i % 29 == 0, "high").otherwise((n % 6).cast("string")).alias("ai_severity"),
            ((n % 51 + 50) / 100.0).alias("ai_confidence"),
        )

    def scored(self) -> DataFrame:
        """Labels with a score derived from the text length; many ties."""
        docs = self.read("documents").select("doc_id", "n_chars")
        signal = (F.col("n_chars") * 37 + F.col("doc_id") * 11) % 100
        return (
            self.read("labels")
            .join(docs, "doc_id")
            .select("doc_id", F.col("toxic").alias("label"), ((signal * 0.7 + F.col("toxic") * 25) / 100.0).alias("_s"))
            .select("doc_id", "label", F.round("_s", 3).alias("score"))
        )

    def profiles(self) -> tuple[list[str], dict]:
        """Language profiles learnt from all ``documents``, packed for use as a column."""
        return feat.pack_profiles(feat.language_profiles(self.texts(), "text", "lang"))


# --- the same derivations for DuckDB ---------------------------------------

POSTS = f"""posts AS (
  SELECT CAST(doc_id AS VARCHAR) AS post_id, source AS subreddit,
    CAST({EPOCH} + (doc_id * 1048573) % {YEAR} AS DOUBLE) AS created_utc,
    CASE WHEN doc_id % 17 IN (3, 4) THEN '[removed]' ELSE split_part(text, chr(10), 1) END AS title,
    CASE WHEN doc_id % 17 = 3 THEN '[deleted]' ELSE text END AS selftext,
    '/r/' || source || '/comments/' || CAST(doc_id AS VARCHAR) || '/' AS permalink,
    n_chars AS score, doc_id % 4 AS num_comments, (doc_id % 101) / 100.0 AS upvote_ratio,
    doc_id % 11 = 0 AS over_18,
    CASE WHEN doc_id % 13 = 0 THEN 'moderator' END AS removed_by_category, lang
  FROM documents)"""

COMMENTS = f"""comments AS (
  SELECT CAST(conv_id AS VARCHAR) || 'c' || CAST(turn AS VARCHAR) AS comment_id,
    CAST(conv_id AS VARCHAR) AS link_id,
    CASE WHEN turn < 3 THEN 't3_' || CAST(conv_id AS VARCHAR)
      ELSE 't1_' || CAST(conv_id AS VARCHAR) || 'c' || CAST(turn - 3 AS VARCHAR) END AS parent_id,
    CASE WHEN conv_id % 7 = 5 AND turn = 1 THEN '[removed]' ELSE text END AS body,
    CAST({EPOCH} + (conv_id * 1048573) % {YEAR} + 60 * (turn + 1) AS DOUBLE) AS created_utc,
    length(text) AS score, CAST(turn // 3 AS INTEGER) AS depth, role
  FROM conversations)"""

HAND = """hand AS (
  SELECT CAST(l.doc_id AS VARCHAR) AS post_id, d.source AS subreddit, l.toxic AS anxiety_level,
    CASE WHEN l.doc_id % 23 = 0 THEN 'n/a'
      ELSE CAST(CASE WHEN l.toxic = 1 THEN 3 + l.doc_id % 3 ELSE l.doc_id % 5 END AS VARCHAR) END AS anxiety_rating
  FROM labels l JOIN documents d USING (doc_id))"""

AI = """ai AS (
  SELECT CAST(doc_id AS VARCHAR) AS post_id, source AS subreddit, split_part(text, chr(10), 1) AS title,
    CASE WHEN n_chars % 5 < 2 THEN 'ANXIETY' WHEN n_chars % 5 < 4 THEN 'NOT_ANXIETY' ELSE 'PANIC' END AS ai_category,
    CASE WHEN doc_id % 29 = 0 THEN 'high' ELSE CAST(n_chars % 6 AS VARCHAR) END AS ai_severity,
    (n_chars % 51 + 50) / 100.0 AS ai_confidence
  FROM documents WHERE doc_id % 3 <> 1)"""

SCORED = """scored AS (
  SELECT doc_id, toxic AS label,
    round((((n_chars * 37 + doc_id * 11) % 100) * 0.7::DOUBLE + toxic * 25) / 100.0::DOUBLE, 3) AS score
  FROM labels JOIN documents USING (doc_id))"""

#: The most frequent letter trigrams per language of ``documents``.
PROFILES = r"""pw AS (SELECT lang, ' ' || unnest(regexp_extract_all(lower(text), '\p{L}+')) || ' ' AS s FROM documents),
  pg AS (SELECT lang, unnest(list_transform(range(1, length(s) - 1), lambda i: substring(s, i, 3))) AS gram FROM pw),
  prof AS (SELECT lang, gram, rank FROM (
    SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram) AS rank FROM pg GROUP BY lang, gram) WHERE rank <= 300)"""


def detected(name: str, table: str, key: str, text: str, least: int = 3) -> str:
    """CTE ``name`` (k, l): the language with the most votes per row of ``table``."""
    return rf"""{name}_w AS (SELECT {key} AS k, ' ' || unnest(regexp_extract_all(lower({text}), '\p{{L}}+')) || ' ' AS s
    FROM {table} WHERE length(trim({text}, ' ')) >= {least}),
  {name}_g AS (SELECT k, unnest(list_transform(range(1, length(s) - 1), lambda i: substring(s, i, 3))) AS gram FROM {name}_w),
  {name}_v AS (SELECT k, lang AS l, sum((SELECT max(rank) + 1 FROM prof) - rank) AS score FROM {name}_g JOIN prof USING (gram) GROUP BY k, lang),
  {name} AS (SELECT k, l FROM {name}_v QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, l) = 1)"""


def with_ctes(*parts: str) -> str:
    """All but the last part are common table expressions."""
    *ctes, body = parts
    return "WITH " + ",\n".join(ctes) + "\n" + body


def with_recursive(*parts: str) -> str:
    return with_ctes(*parts).replace("WITH ", "WITH RECURSIVE ", 1)
