"""Raw posts and comments to the merged corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.functions.text import clean_text, compose_all, compose_main
from threadloom.operators import merge, posts as po


def clean_posts(posts: DataFrame, floor: int | None = None) -> DataFrame:
    return po.clean_post_texts(po.drop_dead(po.normalize_posts(posts)), floor)


def clean_comments(comments: DataFrame) -> DataFrame:
    return po.drop_deleted(po.normalize_comments(comments)).withColumn(
        "body_clean", clean_text("body")
    )


def clean_merge(
    posts: DataFrame, comments: DataFrame, k: int = 5, floor: int = 7, more_comments: DataFrame | None = None
) -> DataFrame:
    """One row per post with its best comments, short texts and copies dropped.

    Short posts go before anything is joined. Comments are reduced to one row
    per post on both sides of the joins; the posts are shuffled once by id, and
    once more by text digest. The composed texts repeat their parts, so they
    are put together behind that shuffle.

    Posts that report comments but have none captured are filled from
    ``more_comments``, cleaned comments of another source. In ``comments`` itself
    there can be none for them, so nothing is looked up there again.
    """
    subs = clean_posts(posts, floor)
    coms = clean_comments(comments)
    merged = merge.merge_comments(
        subs, merge.topk_concat(po.top_level(coms), k), merge.comment_counts(coms)
    )
    whole = compose_all(
        compose_main(F.col("title_clean"), F.col("selftext_clean")), F.col("comments_concat")
    )
    unique = po.compose(merge.dedupe_first(merged, whole))
    flagged = po.flag_missing(unique)
    return flagged if more_comments is None else merge.backfill(flagged, more_comments, k)


def datasets(posts: DataFrame, comments: DataFrame) -> dict[str, DataFrame]:
    """The three tables the corpus step publishes."""
    return {
        "submissions": clean_posts(posts),
        "comments_all": clean_comments(comments).select(
            "comment_id", "post_id", "body_clean", "score", "depth"
        ),
        "corpus": clean_merge(posts, comments),
    }


def parameters(corpus: DataFrame, k: int = 5, floor: int = 7) -> DataFrame:
    """The settings of a run with the dates it covers, as (section, metric, value)."""
    day = "yyyy-MM-dd HH:mm:ss"
    row = corpus.agg(
        F.date_format(F.min("created_dt"), day).alias("date_min"),
        F.date_format(F.max("created_dt"), day).alias("date_max"),
    )
    fixed = {
        "keep_negations": "true", "remove_urls_usernames": "true",
        "comments_top_level_only": "true", "topk_comments": str(k), "length_floor_tokens": str(floor),
    }
    cells = [
        F.struct(F.lit("params").alias("section"), F.lit(m).alias("metric"), F.lit(v).alias("value"))
        for m, v in fixed.items()
    ] + [
        F.struct(F.lit("date_range").alias("section"), F.lit(m).alias("metric"), F.col(m).alias("value"))
        for m in row.columns
    ]
    return row.select(F.inline(F.array(*cells)))
