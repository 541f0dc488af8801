"""Queries on cleaning, filtering, merging and comment trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.config import PullConfig
from threadloom.functions import text as tx
from threadloom.operators import features as feat, merge, posts as po, profile
from threadloom.plans import corpus
from threadloom.plans.registry import query
from threadloom.plans.tables import COMMENTS, POSTS, PROFILES, detected, with_ctes, with_recursive

SPACE, NON_SPACE = tx.SPACE, tx.NON_SPACE
END_EPOCH = 1733011200


def sql_clean(c: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce({c}, '')), "
        rf"'http{NON_SPACE}+|www\.{NON_SPACE}+', ' ', 'g'), 'u/[A-Za-z0-9_-]+', ' ', 'g'), "
        f"'{SPACE}+', ' ', 'g'), ' ')"
    )


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_words(c: str) -> str:
    return f"regexp_extract_all({c}, '{NON_SPACE}+')"


LIVE_POSTS = f"""subs AS (
  SELECT *, make_timestamp(CAST(created_utc * 1000000 AS BIGINT)) AS created_dt,
    {sql_clean('title')} AS title_clean, {sql_clean('selftext')} AS selftext_clean
  FROM posts
  WHERE NOT (title IN ('[deleted]', '[removed]') AND selftext IN ('[deleted]', '[removed]')))"""

LIVE_COMMENTS = f"""coms AS (
  SELECT *, link_id AS post_id, {sql_clean('body')} AS body_clean
  FROM comments WHERE body NOT IN ('[deleted]', '[removed]'))"""

TOPK = """topk AS (
  SELECT post_id, string_agg(body_clean, ' <cmt> ' ORDER BY score DESC, comment_id) AS comments_concat
  FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY score DESC, comment_id) AS rn
        FROM coms WHERE depth = 0) WHERE rn <= 5 GROUP BY post_id)"""

COUNTS = """counts AS (
  SELECT post_id, CAST(count(comment_id) AS INTEGER) AS comment_count FROM coms GROUP BY post_id)"""

MERGED = f"""merged AS (
  SELECT s.*, coalesce(t.comments_concat, '') AS comments_concat, coalesce(c.comment_count, 0) AS comment_count
  FROM subs s LEFT JOIN topk t USING (post_id) LEFT JOIN counts c USING (post_id)),
composed AS (
  SELECT *, {sql_strip("title_clean || chr(10) || chr(10) || selftext_clean")} AS text_main FROM merged),
full_text AS (
  SELECT *, {sql_strip("text_main || chr(10) || chr(10) || comments_concat")} AS text_all FROM composed
  WHERE len({sql_words('text_main')}) >= 7),
corpus AS (
  SELECT *, CAST(coalesce(num_comments, 0) > 0 AND comment_count = 0 AS TINYINT) AS comments_missing
  FROM (SELECT *, row_number() OVER (PARTITION BY text_all ORDER BY created_dt, post_id) AS rn FROM full_text)
  WHERE rn = 1)"""

CORPUS = (POSTS, COMMENTS, LIVE_POSTS, LIVE_COMMENTS, TOPK, COUNTS, MERGED)


@query(
    "clean_merge",
    with_ctes(
        *CORPUS,
        """SELECT post_id, subreddit, comment_count, comments_missing, length(text_main) AS main_len,
          md5(text_all) AS text_md5, md5(comments_concat) AS comments_md5 FROM corpus""",
    ),
)
def clean_merge(t):
    out = corpus.clean_merge(t.posts(), t.comments())
    return out.select(
        "post_id", "subreddit", "comment_count", "comments_missing",
        F.length("text_main").cast("bigint").alias("main_len"),
        F.md5("text_all").alias("text_md5"), F.md5("comments_concat").alias("comments_md5"),
    )


@query(
    "normalize_posts",
    with_ctes(
        POSTS,
        """SELECT post_id, created_utc AS created_ts, strftime(make_timestamp(CAST(created_utc * 1000000 AS BIGINT)), '%Y-%m-%d') AS day,
          length(coalesce(title, '')) AS title_len FROM posts""",
    ),
)
def normalize_posts(t):
    return po.normalize_posts(t.posts()).select(
        "post_id", "created_ts", tx.format_day("created_dt").alias("day"),
        F.length("title").cast("bigint").alias("title_len"),
    )


@query(
    "normalize_comments",
    with_ctes(COMMENTS, "SELECT comment_id, link_id AS post_id, created_utc AS created_ts, md5(coalesce(body, '')) AS body_md5 FROM comments"),
)
def normalize_comments(t):
    return po.normalize_comments(t.comments()).select(
        "comment_id", "post_id", "created_ts", F.md5("body").alias("body_md5")
    )


@query(
    "live_rows",
    with_ctes(
        POSTS, COMMENTS,
        """SELECT 'posts' AS kind, count(*) AS n FROM posts WHERE NOT (title IN ('[deleted]', '[removed]') AND selftext IN ('[deleted]', '[removed]'))
        UNION ALL SELECT 'comments', count(*) FROM comments WHERE body NOT IN ('[deleted]', '[removed]')
        UNION ALL SELECT 'top_level', count(*) FROM comments WHERE body NOT IN ('[deleted]', '[removed]') AND depth = 0""",
    ),
)
def live_rows(t):
    live = po.drop_deleted(t.comments())
    parts = {"posts": po.drop_dead(t.posts()), "comments": live, "top_level": po.top_level(live)}
    frames = [df.agg(F.lit(k).alias("kind"), F.count(F.lit(1)).alias("n")) for k, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


REASONS = f"""reasons AS (
  SELECT *, CASE
    WHEN NOT (created_dt BETWEEN make_timestamp({END_EPOCH}::BIGINT * 1000000) - INTERVAL 9 MONTH AND make_timestamp({END_EPOCH}::BIGINT * 1000000)) THEN 'time'
    WHEN over_18 THEN 'nsfw'
    WHEN coalesce(removed_by_category, '') <> '' THEN 'removed'
    WHEN NOT ((length(trim(title, ' ')) >= 3 AND coalesce(tl.l = 'en', true)) OR (length(trim(selftext, ' ')) >= 3 AND coalesce(bl.l = 'en', true))) THEN 'non_english'
    ELSE 'kept' END AS reason
  FROM (SELECT *, make_timestamp(CAST(created_utc * 1000000 AS BIGINT)) AS created_dt FROM posts) p
  LEFT JOIN tl ON tl.k = post_id LEFT JOIN bl ON bl.k = post_id)"""
POST_LANGS = (PROFILES, detected("tl", "posts", "post_id", "title"), detected("bl", "posts", "post_id", "selftext"))
COMMENT_LANGS = (PROFILES, detected("cl", "comments", "comment_id", "body"))


def _tagged_posts(t):
    """Posts with the detected language of their title and of their body."""
    return feat.tag_languages(po.normalize_posts(t.posts()), t.profiles(), {"title": "title_lang", "selftext": "selftext_lang"})


def _reasons(t):
    return po.filter_reason(_tagged_posts(t), F.timestamp_seconds(F.lit(END_EPOCH)), PullConfig(months_back=9))


@query("filter_reasons", with_ctes(POSTS, *POST_LANGS, REASONS, "SELECT reason, count(*) AS n FROM reasons GROUP BY reason"))
def filter_reasons(t):
    return po.reason_counts(_reasons(t))


@query(
    "ingest_filters",
    with_ctes(POSTS, *POST_LANGS, REASONS, "SELECT post_id, subreddit FROM reasons WHERE reason = 'kept'"),
)
def ingest_filters(t):
    """The single filters one after the other keep the same posts."""
    posts = _tagged_posts(t)
    end = F.timestamp_seconds(F.lit(END_EPOCH))
    kept = po.english_only(po.drop_removed(po.drop_nsfw(po.in_window(posts, end, 9))))
    return kept.select("post_id", "subreddit")


@query(
    "comment_filter",
    with_ctes(
        COMMENTS,
        *COMMENT_LANGS,
        """SELECT comment_id, CASE WHEN body IN ('[deleted]', '[removed]') THEN 'removed'
          WHEN length(body) < 200 THEN 'short'
          WHEN NOT (length(trim(body, ' ')) >= 3 AND coalesce(l = 'en', true)) THEN 'non_english'
          ELSE 'kept' END AS reason FROM comments LEFT JOIN cl ON k = comment_id""",
    ),
)
def comment_filter(t):
    tagged = feat.tag_languages(t.comments(), t.profiles(), {"body": "lang"})
    return po.comment_reason(tagged, 200).select("comment_id", "reason")


@query(
    "time_window",
    with_ctes(
        POSTS,
        f"""SELECT post_id, CAST(created_utc AS BIGINT) AS epoch FROM posts
        WHERE make_timestamp(CAST(created_utc * 1000000 AS BIGINT)) BETWEEN
          make_timestamp({END_EPOCH}::BIGINT * 1000000) - INTERVAL 5 MONTH AND make_timestamp({END_EPOCH}::BIGINT * 1000000)""",
    ),
)
def time_window(t):
    posts = po.normalize_posts(t.posts())
    return po.in_window(posts, F.timestamp_seconds(F.lit(END_EPOCH)), 5).select(
        "post_id", F.col("created_ts").cast("bigint").alias("epoch")
    )


@query(
    "boilerplate",
    """SELECT doc_id FROM (SELECT doc_id, CASE WHEN doc_id % 37 = 1 THEN text || ' Call the National Hotline now' ELSE text END AS t FROM documents)
    WHERE NOT regexp_matches(t, '(?i)(automoderator|suicidewatch|national hotline|message/compose)')""",
)
def boilerplate(t):
    text = F.when(F.col("doc_id") % 37 == 1, F.concat("text", F.lit(" Call the National Hotline now"))).otherwise(F.col("text"))
    docs = t.read("documents").select("doc_id", text.alias("text_all"))
    return po.drop_boilerplate(docs).select("doc_id")


@query(
    "pick_text",
    """SELECT doc_id, length(coalesce(nullif(a, ''), nullif(b, ''), '')) AS text_len FROM (
      SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE text END AS a,
        CASE WHEN doc_id % 3 = 2 THEN split_part(text, ' ', 1) ELSE text END AS b FROM documents
      UNION ALL SELECT * FROM (VALUES (-1, NULL, NULL), (-2, '', ''), (-3, '', NULL)) AS edges(doc_id, a, b))""",
)
def pick_text(t):
    i = F.col("doc_id")
    docs = t.read("documents").select(
        i,
        F.when(i % 3 == 0, F.lit(None)).when(i % 3 == 1, "").otherwise(F.col("text")).alias("text_all"),
        F.when(i % 3 == 2, F.split_part("text", F.lit(" "), F.lit(1))).otherwise(F.col("text")).alias("text_main"),
    )
    edges = t.spark.createDataFrame([(-1, None, None), (-2, "", ""), (-3, "", None)], "doc_id long, text_all string, text_main string")
    return po.pick_text(docs.unionByName(edges), ["text_all", "text_main"]).select(
        "doc_id", F.length("text").cast("bigint").alias("text_len")
    )


@query(
    "compose_texts",
    with_ctes(
        *CORPUS,
        """SELECT post_id, md5(text_main) AS main_md5, md5(text_all) AS all_md5, md5(title || ' ' || selftext) AS full_md5 FROM full_text""",
    ),
)
def compose_texts(t):
    coms = corpus.clean_comments(t.comments())
    merged = merge.merge_comments(
        corpus.clean_posts(t.posts()), merge.topk_concat(po.top_level(coms)), merge.comment_counts(coms)
    )
    return po.min_tokens(po.compose(merged)).select(
        "post_id", F.md5("text_main").alias("main_md5"), F.md5("text_all").alias("all_md5"),
        F.md5("fulltext").alias("full_md5"),
    )


@query(
    "comments_missing",
    with_ctes(
        *CORPUS,
        """SELECT CAST(sum(comments_missing) AS BIGINT) AS n_missing,
          CAST(sum(CASE WHEN comments_missing = 1 AND length(comments_concat) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_missing_empty
        FROM corpus""",
    ),
)
def comments_missing(t):
    return po.missing_summary(corpus.clean_merge(t.posts(), t.comments()))


@query(
    "project_posts",
    with_ctes(
        POSTS,
        """SELECT post_id, subreddit, 'https://www.reddit.com' || permalink AS permalink, score, num_comments,
          round(CAST(upvote_ratio AS DOUBLE), 6) AS upvote_ratio, over_18 FROM posts""",
    ),
)
def project_posts(t):
    return po.project_post(t.posts()).select(
        "post_id", "subreddit", "permalink", "score", "num_comments",
        F.round("upvote_ratio", 6).alias("upvote_ratio"), "over_18",
    )


@query("project_comments", with_ctes(COMMENTS, "SELECT comment_id, split_part(parent_id, '_', 2) AS parent_id, depth FROM comments"))
def project_comments(t):
    return po.project_comment(t.comments()).select("comment_id", "parent_id", "depth")


@query(
    "score_range",
    "SELECT min(value) AS min_value, max(value) AS max_value, count(*) FILTER (WHERE value < 1 OR value > 90) AS n_outside FROM events",
)
def score_range(t):
    return po.assert_range(t.read("events"), "value", 1, 90)


@query("topk_concat", with_ctes(COMMENTS, LIVE_COMMENTS, TOPK, "SELECT post_id, md5(comments_concat) AS comments_md5, length(comments_concat) AS n FROM topk"))
def topk_concat(t):
    coms = po.top_level(corpus.clean_comments(t.comments()))
    return merge.topk_concat(coms).select(
        "post_id", F.md5("comments_concat").alias("comments_md5"), F.length("comments_concat").cast("bigint").alias("n")
    )


@query("comment_counts", with_ctes(COMMENTS, LIVE_COMMENTS, COUNTS, "SELECT * FROM counts"))
def comment_counts(t):
    return merge.comment_counts(corpus.clean_comments(t.comments()))


@query(
    "dedupe_first",
    """SELECT doc_id, created FROM (SELECT doc_id, doc_id * 7919 % 1000 AS created,
      row_number() OVER (PARTITION BY text ORDER BY doc_id * 7919 % 1000, doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def dedupe_first(t):
    docs = t.read("documents").select("doc_id", "text", (F.col("doc_id") * 7919 % 1000).alias("created"))
    return merge.dedupe_first(docs, "text", "created", "doc_id").select("doc_id", "created")


@query(
    "backfill",
    with_ctes(
        *CORPUS,
        """found AS (
          SELECT post_id, string_agg(body_clean, ' <cmt> ' ORDER BY score DESC, comment_id) AS comments_concat
          FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY score DESC, comment_id) AS rn FROM coms) WHERE rn <= 2 GROUP BY post_id)""",
        f"""SELECT c.post_id, c.comment_count, md5({sql_strip("text_main || chr(10) || chr(10) || coalesce(f.comments_concat, '')")}) AS text_md5
        FROM full_text c LEFT JOIN found f USING (post_id) WHERE c.comment_count > 0""",
    ),
)
def backfill(t):
    """Comments of any depth for posts whose text lost theirs."""
    coms = corpus.clean_comments(t.comments())
    merged = merge.merge_comments(
        corpus.clean_posts(t.posts()), merge.topk_concat(po.top_level(coms)), merge.comment_counts(coms)
    )
    emptied = po.min_tokens(po.compose(merged)).withColumn("comments_concat", F.lit(""))
    filled = merge.backfill(emptied, coms, 2, by_text=True)
    return filled.where("comment_count > 0").select(
        "post_id", "comment_count", F.md5("text_all").alias("text_md5")
    )


@query(
    "reply_counts",
    with_ctes(
        COMMENTS,
        "parents AS (SELECT comment_id, split_part(parent_id, '_', 2) AS parent_id FROM comments)",
        """SELECT a.comment_id, count(b.comment_id) AS n_replies FROM parents a LEFT JOIN parents b ON b.parent_id = a.comment_id GROUP BY a.comment_id""",
    ),
)
def reply_counts(t):
    return merge.reply_counts(po.project_comment(t.comments()))


@query(
    "tree_depth",
    with_recursive(
        COMMENTS,
        "live AS (SELECT comment_id, link_id, split_part(parent_id, '_', 2) AS parent_id FROM comments WHERE body NOT IN ('[deleted]', '[removed]'))",
        """tree AS (
          SELECT comment_id, link_id, 0 AS depth FROM live WHERE parent_id = link_id
          UNION ALL
          SELECT l.comment_id, l.link_id, t.depth + 1 FROM live l JOIN tree t ON l.parent_id = t.comment_id AND l.link_id = t.link_id)""",
        "SELECT comment_id, link_id, CAST(depth AS INTEGER) AS depth FROM tree",
    ),
)
def tree_depth(t):
    return merge.flatten_tree(po.project_comment(t.comments())).select("comment_id", "link_id", "depth")


@query(
    "top_comments",
    with_ctes(
        COMMENTS,
        *COMMENT_LANGS,
        """SELECT link_id, comment_id, CAST(rank AS INTEGER) AS rank FROM (
          SELECT link_id, comment_id, row_number() OVER (PARTITION BY link_id ORDER BY score DESC, comment_id) AS rank
          FROM comments LEFT JOIN cl ON k = comment_id
          WHERE length(body) >= 10 AND body NOT IN ('[deleted]', '[removed]') AND length(trim(body, ' ')) >= 3 AND coalesce(l = 'en', true)) WHERE rank <= 3""",
    ),
)
def top_comments(t):
    spoken = feat.lang_column("body", t.profiles())
    return merge.top_comments(t.comments(), lang=spoken).select("link_id", "comment_id", "rank")


@query(
    "newest_per_group",
    with_ctes(
        POSTS,
        """SELECT subreddit, post_id, CAST(rank AS INTEGER) AS rank FROM (
          SELECT subreddit, post_id, row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, post_id) AS rank FROM posts) WHERE rank <= 5""",
    ),
)
def newest_per_group(t):
    return merge.newest_n(po.normalize_posts(t.posts()), 5).select("subreddit", "post_id", "rank")


@query("head_rows", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 25")
def head_rows(t):
    return t.read("documents").select("doc_id", "lang").orderBy("doc_id").limit(25)


@query(
    "semi_join",
    "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT conv_id FROM conversations)",
)
def semi_join(t):
    ids = t.read("conversations").select(F.col("conv_id").alias("doc_id")).distinct()
    return merge.semi(t.read("documents").select("doc_id", "lang"), ids, "doc_id")


@query(
    "aligned_rows",
    "SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)",
)
def aligned_rows(t):
    return merge.zip_rows(
        t.read("documents").select("doc_id", "lang"), t.read("labels").select("doc_id", "quality"), "doc_id"
    )


@query(
    "run_parameters",
    with_ctes(
        *CORPUS,
        """SELECT 'params' AS section, 'keep_negations' AS metric, 'true' AS value
        UNION ALL SELECT 'params', 'remove_urls_usernames', 'true'
        UNION ALL SELECT 'params', 'comments_top_level_only', 'true'
        UNION ALL SELECT 'params', 'topk_comments', '5'
        UNION ALL SELECT 'params', 'length_floor_tokens', '7'
        UNION ALL SELECT 'date_range', 'date_min', (SELECT strftime(min(created_dt), '%Y-%m-%d %H:%M:%S') FROM corpus)
        UNION ALL SELECT 'date_range', 'date_max', (SELECT strftime(max(created_dt), '%Y-%m-%d %H:%M:%S') FROM corpus)""",
    ),
)
def run_parameters(t):
    return corpus.parameters(corpus.clean_merge(t.posts(), t.comments()))


# --- profiles ---------------------------------------------------------------


@query("value_counts", "SELECT lang, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 6) AS pct FROM documents GROUP BY lang")
def value_counts(t):
    return profile.value_counts(t.read("documents"), "lang").withColumn("pct", F.round("pct", 6))


_NULLED = "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS lang, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE source END AS source, n_chars FROM documents"


def _with_nulls(t):
    i = F.col("doc_id")
    return t.read("documents").select(
        i, F.when(i % 3 != 0, F.col("lang")).alias("lang"), F.when(i % 7 != 0, F.col("source")).alias("source"), "n_chars"
    )


@query(
    "null_profile",
    f"""WITH d AS ({_NULLED}), n AS (SELECT count(*) AS rows, count(*) - count(doc_id) AS a, count(*) - count(lang) AS b, count(*) - count(source) AS c, count(*) - count(n_chars) AS e FROM d)
    SELECT 'doc_id' AS "column", a AS n_null, round(a * 100.0 / rows, 2) AS pct_null FROM n
    UNION ALL SELECT 'lang', b, round(b * 100.0 / rows, 2) FROM n
    UNION ALL SELECT 'source', c, round(c * 100.0 / rows, 2) FROM n
    UNION ALL SELECT 'n_chars', e, round(e * 100.0 / rows, 2) FROM n""",
)
def null_profile(t):
    return profile.null_profile(_with_nulls(t))


@query(
    "dataset_profile",
    f"""WITH d AS ({_NULLED})
    SELECT 'rows' AS metric, count(*) AS value FROM d
    UNION ALL SELECT 'missing', 4 * count(*) - count(doc_id) - count(lang) - count(source) - count(n_chars) FROM d
    UNION ALL SELECT 'columns', 4 UNION ALL SELECT 'type:bigint', 2 UNION ALL SELECT 'type:string', 2""",
)
def dataset_profile(t):
    return profile.profile(_with_nulls(t))


@query(
    "linkage",
    with_ctes(
        POSTS, COMMENTS,
        """SELECT linked_posts, n_comments, n_posts, round(linked_posts * 100.0 / n_posts, 6) AS linked_pct,
          round(n_comments / n_posts, 6) AS comments_per_post FROM
          (SELECT count(DISTINCT replace('t3_' || link_id, 't3_', '')) AS linked_posts, count(*) AS n_comments, (SELECT count(*) FROM posts) AS n_posts FROM comments)""",
    ),
)
def linkage(t):
    coms = t.comments().withColumn("link_id", F.concat(F.lit("t3_"), "link_id"))
    return profile.linkage(t.posts(), coms).withColumn("linked_pct", F.round("linked_pct", 6)).withColumn(
        "comments_per_post", F.round("comments_per_post", 6)
    )


@query(
    "length_stats",
    with_ctes(
        POSTS,
        "lens AS (SELECT 'title' AS \"column\", length(title) AS n FROM posts UNION ALL SELECT 'selftext', length(selftext) FROM posts UNION ALL SELECT 'fulltext', length(title || ' ' || selftext) FROM posts)",
        'SELECT "column", round(avg(n), 6) AS mean_len, quantile_cont(n, 0.5)::DOUBLE AS median_len FROM lens GROUP BY "column"',
    ),
)
def length_stats(t):
    posts = t.posts().withColumn("fulltext", tx.compose_full(F.col("title"), F.col("selftext")))
    return profile.length_stats(posts, ["title", "selftext", "fulltext"]).withColumn("mean_len", F.round("mean_len", 6))


@query(
    "box_stats",
    """WITH q AS (SELECT source, count(*) AS n, min(n_chars)::DOUBLE AS min_value, quantile_cont(n_chars, 0.25)::DOUBLE AS q1,
        quantile_cont(n_chars, 0.5)::DOUBLE AS median, quantile_cont(n_chars, 0.75)::DOUBLE AS q3, max(n_chars)::DOUBLE AS max_value FROM documents GROUP BY source)
    SELECT q.source, n, min_value, q1, median, q3, max_value, min(d.n_chars) AS whisker_lo, max(d.n_chars) AS whisker_hi
    FROM q JOIN documents d ON d.source = q.source AND d.n_chars BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
    GROUP BY ALL""",
)
def box_stats(t):
    return profile.box_stats(t.read("documents"), "source", "n_chars")


@query(
    "histogram",
    """WITH s AS (SELECT min(value) AS lo, (max(value) - min(value)) / 40 AS w FROM events)
    SELECT CAST(least(floor((value - lo) / w), 39) AS INTEGER) AS bin, round(lo + least(floor((value - lo) / w), 39) * w, 6) AS left_edge, count(*) AS n
    FROM events, s GROUP BY ALL""",
)
def histogram(t):
    return profile.histogram(t.read("events"), "value", 40).withColumn("left_edge", F.round("left_edge", 6))


@query(
    "crosstab",
    """SELECT o_orderpriority,
      count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
      count(*) FILTER (WHERE o_orderstatus = 'P') AS "P", count(*) AS total FROM orders GROUP BY o_orderpriority""",
)
def crosstab(t):
    return profile.crosstab(t.read("orders"), "o_orderpriority", "o_orderstatus")


@query(
    "crosstab_totals",
    """SELECT source, lang, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY source) AS BIGINT) AS row_total,
      CAST(sum(count(*)) OVER (PARTITION BY lang) AS BIGINT) AS col_total FROM documents GROUP BY source, lang""",
)
def crosstab_totals(t):
    return profile.crosstab_long(t.read("documents"), "source", "lang").select("source", "lang", "n", "row_total", "col_total")


@query(
    "coverage",
    "SELECT CAST(floor(epoch(min(ts))) AS BIGINT) AS earliest, CAST(floor(epoch(max(ts))) AS BIGINT) AS latest FROM events",
)
def coverage(t):
    return profile.coverage(t.read("events").select(F.col("ts").cast("timestamp").alias("ts")), "ts").select(
        F.unix_seconds("earliest").alias("earliest"), F.unix_seconds("latest").alias("latest")
    )


@query(
    "quality_check",
    with_ctes(
        POSTS, COMMENTS,
        """SELECT n_posts, unique_posts, missing_title, missing_selftext, round(missing_title * 100.0 / n_posts, 6) AS missing_title_pct,
          round(missing_selftext * 100.0 / n_posts, 6) AS missing_selftext_pct, n_comments, unique_comments, missing_body,
          round(missing_body * 100.0 / n_comments, 6) AS missing_body_pct FROM
        (SELECT count(*) AS n_posts, count(DISTINCT post_id) AS unique_posts, count(*) FILTER (WHERE coalesce(title, '') = '') AS missing_title,
          count(*) FILTER (WHERE coalesce(selftext, '') = '') AS missing_selftext FROM posts),
        (SELECT count(*) AS n_comments, count(DISTINCT comment_id) AS unique_comments, count(*) FILTER (WHERE coalesce(body, '') = '') AS missing_body FROM comments)""",
    ),
)
def quality_check(t):
    out = profile.quality(t.posts(), t.comments())
    for c in ("missing_title_pct", "missing_selftext_pct", "missing_body_pct"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@query(
    "recent_counts",
    """SELECT event_type, count(*) AS n, round(count(*) / (10 * 86400.0), 9) AS per_second FROM events
    WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 10 DAY AND ts <= TIMESTAMP '2024-01-20 00:00:00' GROUP BY event_type""",
)
def recent_counts(t):
    end = F.timestamp_seconds(F.lit(1705708800))
    events = t.read("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return profile.recent_counts(events, end, 10, "event_type", "ts").withColumn("per_second", F.round("per_second", 9))


@query("distinct_groups", "SELECT DISTINCT source FROM documents")
def distinct_groups(t):
    return profile.distinct_groups(t.read("documents"), "source")


@query("top_groups", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10")
def top_groups(t):
    return profile.top_groups(t.read("orders"), "o_custkey")


@query(
    "word_counts",
    f"SELECT doc_id, len({sql_words('text')}) AS words, length(text) AS chars FROM documents",
)
def word_counts(t):
    return t.read("documents").select(
        "doc_id", tx.word_count("text").cast("bigint").alias("words"), tx.text_length("text").cast("bigint").alias("chars")
    )


@query(
    "datacard",
    with_ctes(
        POSTS,
        f"""m AS (SELECT count(*)::DOUBLE AS a, count(DISTINCT post_id)::DOUBLE AS b, min(created_utc) AS c, max(created_utc) AS d,
          (count(*) - count(post_id))::DOUBLE AS e, (count(*) - count(created_utc))::DOUBLE AS f, (count(*) - count(selftext))::DOUBLE AS g,
          (count(*) FILTER (WHERE coalesce(selftext, '') = ''))::DOUBLE AS h, avg(len({sql_words("coalesce(selftext, '')")})) AS i FROM posts)""",
        """SELECT 'rows' AS metric, a AS value FROM m UNION ALL SELECT 'unique_ids', b FROM m
        UNION ALL SELECT 'earliest_epoch', c FROM m UNION ALL SELECT 'latest_epoch', d FROM m
        UNION ALL SELECT 'null_post_id', e FROM m UNION ALL SELECT 'null_created_dt', f FROM m UNION ALL SELECT 'null_selftext', g FROM m
        UNION ALL SELECT 'empty_selftext', h FROM m UNION ALL SELECT 'mean_words_selftext', round(i, 6) FROM m""",
    ),
)
def datacard(t):
    posts = po.normalize_posts(t.posts()).select("post_id", "created_dt", "selftext")
    return profile.datacard(posts, "created_dt", ["selftext"], "post_id").withColumn("value", F.round("value", 6))
