"""Comment aggregation, joins onto posts, de-duplication, comment trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from threadloom import reference_tables as ref
from threadloom.functions.text import compose_all
from threadloom.operators.emotion import small
from threadloom.operators.posts import english_side
from threadloom.session import materialize

# The optimiser prunes ranks before the shuffle up to this limit
# (spark.sql.optimizer.windowGroupLimitThreshold).
_PRUNED_RANKS = 1000


def top_n_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank", salts: int = 64
) -> DataFrame:
    """The first ``n`` rows of each group in the given order, ranked from 1.

    Spark drops ranks above a literal limit on the map side, so a hot group
    sends at most ``n`` rows per task. For limits beyond what it prunes, the
    group is cut into salted parts first; the parts' winners hold the group's.
    """
    if n > _PRUNED_RANKS:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if _hashable(df, c)]), F.lit(salts)))
        part = W.partitionBy(*group, "_salt").orderBy(*order)
        df = salted.withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= n).drop("_r", "_salt")
    whole = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= n)


def _hashable(df: DataFrame, column: str) -> bool:
    return not df.schema[column].dataType.simpleString().startswith(("map", "variant"))


def topk_concat(
    comments: DataFrame,
    k: int = 5,
    body: str = "body_clean",
    key: str = "post_id",
    separator: str = ref.COMMENT_SEPARATOR,
) -> DataFrame:
    """The ``k`` best-scored comments of each post as one string."""
    ranked = top_n_per_group(
        comments.select(key, "comment_id", "score", F.col(body).alias("_body")),
        [key],
        [F.col("score").desc(), F.col("comment_id")],
        k,
    )
    picked = F.array_sort(F.collect_list(F.struct("rank", "_body")))
    return ranked.groupBy(key).agg(
        F.array_join(F.transform(picked, lambda s: s["_body"]), separator).alias("comments_concat")
    )


def comment_counts(comments: DataFrame, key: str = "post_id") -> DataFrame:
    """Comments of every depth per post."""
    return comments.groupBy(key).agg(F.count("comment_id").cast("int").alias("comment_count"))


def merge_comments(posts: DataFrame, concat: DataFrame, counts: DataFrame) -> DataFrame:
    """Both sides arrive as one row per post, so a hot post cannot skew the join."""
    return (
        posts.join(concat, "post_id", "left")
        .join(counts, "post_id", "left")
        .withColumn("comments_concat", F.coalesce("comments_concat", F.lit("")))
        .withColumn("comment_count", F.coalesce("comment_count", F.lit(0)))
    )


def dedupe_first(
    df: DataFrame, text: Column | str = "text_all", ts: str = "created_dt", id_col: str = "post_id"
) -> DataFrame:
    """Keep the earliest row of each text, given as a column or an expression.

    Rows meet by a 256-bit digest of the text; the rank limit of one keeps at
    most one row per digest and map task, so hot copies never travel.
    """
    first = W.partitionBy("_digest").orderBy(F.col(ts).asc(), F.col(id_col).asc())
    return (
        df.withColumn("_digest", F.sha2(F.col(text) if isinstance(text, str) else text, 256))
        .withColumn("_r", F.row_number().over(first))
        .where(F.col("_r") == 1)
        .drop("_r", "_digest")
    )


def prefer_source(df: DataFrame, key: str = "post_id", source: str = "source") -> DataFrame:
    """One row per key, the last source in alphabetical order winning."""
    best = W.partitionBy(key).orderBy(F.col(source).desc())
    return df.withColumn("_r", F.row_number().over(best)).where(F.col("_r") == 1).drop("_r")


def backfill(
    df: DataFrame, comments: DataFrame, k: int = 5, by_text: bool = False, body: str = "body_clean"
) -> DataFrame:
    """Refill comment text for posts that need it, from comments of any depth.

    The default mask asks for reported but uncaptured comments. ``by_text``
    asks for posts with captured comments but an empty text instead, which is
    the case the default mask cannot see.
    """
    if by_text:
        need = (F.col("comments_concat") == "") & (F.col("comment_count") > 0)
    else:
        need = (F.coalesce("num_comments", F.lit(0)) > 0) & (F.col("comment_count") == 0)
    found = topk_concat(comments, k, body).withColumnRenamed("comments_concat", "_found")
    n_found = comment_counts(comments).withColumnRenamed("comment_count", "_n_found")
    joined = df.join(found, "post_id", "left").join(n_found, "post_id", "left")
    refilled = (
        joined.withColumn("_need", need)
        .withColumn(
            "comments_concat",
            F.when(F.col("_need"), F.coalesce("_found", F.lit(""))).otherwise(F.col("comments_concat")),
        )
        .withColumn(
            "comment_count",
            F.when(F.col("_need"), F.coalesce("_n_found", F.lit(0))).otherwise(F.col("comment_count")),
        )
        .withColumn(
            "text_all",
            F.when(
                F.col("_need"), compose_all(F.col("text_main"), F.col("comments_concat"))
            ).otherwise(F.col("text_all")),
        )
    )
    return refilled.select(*df.columns)


def attach_labels(corpus: DataFrame, labels: DataFrame) -> DataFrame:
    return corpus.join(labels, "post_id", "inner")


def semi(df: DataFrame, ids: DataFrame, key: str = "post_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def pending(df: DataFrame, done: DataFrame, key: str = "post_id") -> DataFrame:
    """Rows whose key has no result yet."""
    return df.join(done.select(key), key, "left_anti")


def merge_results(done: DataFrame, fresh: DataFrame) -> DataFrame:
    """Earlier results and new ones together."""
    return done.unionByName(fresh)


def with_text(labels: DataFrame, corpus: DataFrame, text: str = "text_all") -> DataFrame:
    return labels.join(corpus.select("post_id", text), "post_id", "left")


def attach_topics(corpus: DataFrame, topics: DataFrame) -> DataFrame:
    """Topic columns back onto all posts; posts left out of the model get null."""
    return corpus.join(topics, "post_id", "left")


def zip_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Row-aligned tables joined by the key both carry, never by position."""
    return left.join(right, key, "inner")


def reply_counts(comments: DataFrame) -> DataFrame:
    """Direct children of each comment, zero included."""
    children = comments.groupBy("parent_id").agg(F.count(F.lit(1)).alias("_n"))
    return (
        comments.select("comment_id")
        .join(children, F.col("comment_id") == F.col("parent_id"), "left")
        .select("comment_id", F.coalesce("_n", F.lit(0)).alias("n_replies"))
    )


#: Replies that meet at one comment before they are dealt over several tasks.
HUB_REPLIES = 20_000


def _meet(waiting: DataFrame, reached: DataFrame, hub: int) -> DataFrame:
    """Every waiting comment beside the one it points to, in its own thread.

    Comments with more than ``hub`` rows pointing to them have their own row repeated
    once per part, and the rows that point to them are dealt over these parts.
    """
    at = ["link_id", "up"]
    target = reached.select(
        "link_id", F.col("comment_id").alias("up"), F.col("up").alias("_next"), F.col("dist").alias("_more")
    )
    hubs = (
        waiting.groupBy(*at).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hub)
        .select(*at, F.ceil(F.col("_n") / hub).alias("_parts"))
    )
    if hubs.isEmpty():
        met = waiting.join(target, at)
    else:
        hubs = small(materialize(hubs, "tree-hubs"))
        parts = F.coalesce("_parts", F.lit(1))
        dealt = waiting.join(hubs, at, "left").withColumn("_part", F.pmod(F.xxhash64("comment_id"), parts)).drop("_parts")
        copies = target.join(hubs, at, "left").select(
            *at, "_next", "_more", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("_part")
        )
        met = dealt.join(copies, [*at, "_part"])
    return met.select(
        "comment_id", "link_id", "parent_id", F.col("_next").alias("up"), (F.col("dist") + F.col("_more")).alias("dist")
    )


def flatten_tree(comments: DataFrame, hub: int = HUB_REPLIES) -> DataFrame:
    """Depth of every comment reachable from its post over live comments.

    Pointer doubling: each comment points to its parent, and in every round to what
    that one points to, so a thread of depth d takes about log2(d) rounds. A comment
    whose pointer reaches the top is done and is written once; one whose pointer
    leads to a removed or absent comment goes, and with it its whole subtree. Rows that
    point in a circle go once their distance exceeds the number of rows. Every round is
    written to the shared folder. An id that occurs repeatedly in a thread is one comment
    below its smallest live parent; null ids and parents are not reachable.
    """
    top = F.col("parent_id") == F.col("link_id")
    live = materialize(
        comments.where(~F.col("body").isin(ref.MARKERS))
        .groupBy("comment_id", "link_id")
        .agg(F.min("parent_id").alias("parent_id"))
        .where("comment_id IS NOT NULL AND link_id IS NOT NULL AND parent_id IS NOT NULL")
        .withColumns({"up": F.when(~top, F.col("parent_id")), "dist": F.when(top, 0).otherwise(1).cast("bigint")}),
        "tree-live",
    )
    total = live.count()
    done, waiting = live.where(F.col("up").isNull()), live.where(F.col("up").isNotNull())
    while not waiting.isEmpty():
        met = materialize(
            _meet(waiting, done.unionByName(waiting), hub).where(F.col("dist") <= total), "tree-round"
        )
        done = done.unionByName(met.where(F.col("up").isNull()))
        waiting = met.where(F.col("up").isNotNull())
    return done.select("comment_id", "link_id", "parent_id", F.col("dist").cast("int").alias("depth"))


def top_comments(comments: DataFrame, k: int = 3, min_len: int = 10, lang: Column | str | None = None) -> DataFrame:
    """Best-scored comments per post after the length filter and, with ``lang``, the
    language filter: both come before the cut."""
    kept = comments.where((F.length("body") >= min_len) & ~F.col("body").isin(ref.MARKERS))
    if lang is not None:
        kept = kept.withColumn("_lang", F.col(lang) if isinstance(lang, str) else lang)
        kept = kept.where(english_side("body", "_lang")).drop("_lang")
    return top_n_per_group(kept, ["link_id"], [F.col("score").desc(), F.col("comment_id")], k)


def newest_n(df: DataFrame, n: int, group: str = "subreddit", ts: str = "created_dt", id_col: str = "post_id") -> DataFrame:
    """Newest rows per group; filter to the time window first."""
    return top_n_per_group(df, [group], [F.col(ts).desc(), F.col(id_col)], n)


def tagged_union(frames: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union with the name of the frame each row came from."""
    parts = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def common_ids(a: DataFrame, b: DataFrame, key: str = "post_id") -> DataFrame:
    return a.select(key).intersect(b.select(key))


def pending_ids(df: DataFrame, done: DataFrame, key: str = "post_id") -> DataFrame:
    return df.select(key).subtract(done.select(key))
