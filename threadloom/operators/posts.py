"""Row filters and projections on posts and comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom import reference_tables as ref
from threadloom.config import PULL_DEFAULT, PullConfig
from threadloom.functions.text import (
    as_column,
    clean_text,
    clean_word_count,
    compose_all,
    compose_full,
    compose_main,
    months_before,
    text_or_empty,
    to_timestamp,
    word_count,
)


def normalize_posts(df: DataFrame) -> DataFrame:
    """String ids, no null texts, ``created_utc`` renamed and dated."""
    return (
        df.withColumnRenamed("created_utc", "created_ts")
        .withColumn("post_id", F.col("post_id").cast("string"))
        .withColumn("created_dt", to_timestamp("created_ts"))
        .withColumn("title", text_or_empty("title"))
        .withColumn("selftext", text_or_empty("selftext"))
    )


def normalize_comments(df: DataFrame) -> DataFrame:
    return (
        df.withColumnRenamed("created_utc", "created_ts")
        .withColumn("post_id", F.col("link_id").cast("string"))
        .withColumn("comment_id", F.col("comment_id").cast("string"))
        .withColumn("body", text_or_empty("body"))
    )


def drop_dead(df: DataFrame) -> DataFrame:
    """A post goes only when title and body are both a deletion marker."""
    return df.where(~(F.col("title").isin(ref.MARKERS) & F.col("selftext").isin(ref.MARKERS)))


def drop_deleted(df: DataFrame, body: str = "body") -> DataFrame:
    return df.where(~F.col(body).isin(ref.MARKERS))


def top_level(df: DataFrame) -> DataFrame:
    return df.where(F.col("depth") == 0)


def in_window(df: DataFrame, end: Column, months: int, ts: str = "created_dt") -> DataFrame:
    """Both ends belong to the window."""
    return df.where(F.col(ts).between(months_before(end, months), end))


def drop_nsfw(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce("over_18", F.lit(False)))


def is_removed(c: str = "removed_by_category") -> Column:
    return text_or_empty(c) != ""


def drop_removed(df: DataFrame) -> DataFrame:
    return df.where(~is_removed())


def english_side(text: Column | str, lang: Column | str) -> Column:
    """Whether one text counts as English; under three characters it does not,
    an undetected language (null) does."""
    long_enough = F.length(F.trim(text_or_empty(text))) >= 3
    return long_enough & F.coalesce(as_column(lang) == "en", F.lit(True))


def english_post(title_lang: str = "title_lang", body_lang: str = "selftext_lang") -> Column:
    return english_side("title", title_lang) | english_side("selftext", body_lang)


def english_only(df: DataFrame, title_lang: str = "title_lang", body_lang: str = "selftext_lang") -> DataFrame:
    return df.where(english_post(title_lang, body_lang))


def comment_filter(df: DataFrame, min_len: int = 10, lang: str | None = "lang") -> DataFrame:
    kept = df.where(F.length("body") >= min_len)
    return kept.where(english_side("body", lang)) if lang else kept


def filter_reason(
    df: DataFrame,
    end: Column,
    config: PullConfig = PULL_DEFAULT,
    ts: str = "created_dt",
    title_lang: str = "title_lang",
    body_lang: str = "selftext_lang",
) -> DataFrame:
    """Add ``reason``: the first filter a post fails, or ``kept``."""
    start = months_before(end, config.months_back)
    reason = F.when(~F.col(ts).between(start, end), "time")
    if config.exclude_nsfw:
        reason = reason.when(F.coalesce("over_18", F.lit(False)), "nsfw")
    if config.exclude_removed:
        reason = reason.when(is_removed(), "removed")
    if config.english_only:
        reason = reason.when(~english_post(title_lang, body_lang), "non_english")
    return df.withColumn("reason", reason.otherwise("kept"))


def reason_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def comment_reason(df: DataFrame, min_len: int = 10, lang: str | None = "lang") -> DataFrame:
    """Add ``reason`` to comments: removed, short, non_english or kept."""
    reason = F.when(F.col("body").isin(ref.MARKERS), "removed").when(
        F.length("body") < min_len, "short"
    )
    if lang:
        reason = reason.when(~english_side("body", lang), "non_english")
    return df.withColumn("reason", reason.otherwise("kept"))


def min_tokens(df: DataFrame, floor: int = 7, text: str = "text_main") -> DataFrame:
    return df.where(word_count(text) >= floor)


def drop_boilerplate(df: DataFrame, text: str = "text_all") -> DataFrame:
    return df.where(~text_or_empty(text).rlike(f"(?i)({ref.BOILERPLATE})"))


def first_present(df: DataFrame, candidates: list[str]) -> str:
    """The first candidate column the frame has."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of {candidates} found in {df.columns}")


def pick_text(df: DataFrame, candidates: list[str], out: str = "text") -> DataFrame:
    """Row-wise: the first candidate that is neither null nor empty, else ""."""
    present = [c for c in candidates if c in df.columns]
    choices = [F.nullif(F.col(c), F.lit("")) for c in present]
    return df.withColumn(out, F.coalesce(*choices, F.lit("")))


def clean_post_texts(df: DataFrame, floor: int | None = None) -> DataFrame:
    """Add the cleaned title and body.

    With ``floor`` only posts of that many words stay. The filter sits on the
    cleaned pair while it is built: as a plain filter it would be pushed to the
    scan and every text cleaned twice.
    """
    pair = F.struct(
        clean_text("title").alias("title_clean"), clean_text("selftext").alias("selftext_clean")
    )
    if floor is None:
        return df.withColumn("_c", pair).select("*", "_c.*").drop("_c")
    long_enough = F.filter(
        F.array(pair),
        lambda p: clean_word_count(p["title_clean"]) + clean_word_count(p["selftext_clean"]) >= floor,
    )
    return df.select("*", F.inline(long_enough))


def compose(df: DataFrame) -> DataFrame:
    """Add ``text_main``, ``text_all`` and ``fulltext``."""
    return (
        df.withColumn("text_main", compose_main(F.col("title_clean"), F.col("selftext_clean")))
        .withColumn("text_all", compose_all(F.col("text_main"), F.col("comments_concat")))
        .withColumn("fulltext", compose_full(F.col("title"), F.col("selftext")))
    )


def flag_missing(df: DataFrame) -> DataFrame:
    """Posts that report comments of which none were captured."""
    missing = (F.coalesce("num_comments", F.lit(0)) > 0) & (F.col("comment_count") == 0)
    return df.withColumn("comments_missing", missing.cast("tinyint"))


def missing_summary(df: DataFrame) -> DataFrame:
    flagged = F.col("comments_missing") == 1
    return df.agg(
        F.count_if(flagged).alias("n_missing"),
        F.count_if(flagged & (F.length("comments_concat") == 0)).alias("n_missing_empty"),
    )


def project_post(df: DataFrame, host: str = ref.PERMALINK_HOST) -> DataFrame:
    """The published post columns; the author is not among them."""
    link = F.concat(F.lit(host), F.nullif(F.col("permalink"), F.lit("")))
    return df.select(
        F.col("post_id").cast("string").alias("post_id"),
        "subreddit",
        "created_utc",
        text_or_empty("title").alias("title"),
        text_or_empty("selftext").alias("selftext"),
        link.alias("url"),
        link.alias("permalink"),
        "score",
        "num_comments",
        "upvote_ratio",
        "over_18",
        "removed_by_category",
    )


def project_comment(df: DataFrame) -> DataFrame:
    """The published comment columns; the parent id loses its kind prefix."""
    return df.select(
        "comment_id",
        "link_id",
        F.split_part("parent_id", F.lit("_"), F.lit(2)).alias("parent_id"),
        "body",
        "created_utc",
        "score",
        "depth",
    )


def assert_range(df: DataFrame, column: str, lo: float, hi: float) -> DataFrame:
    """One row: smallest, largest and how many values fall outside."""
    c = F.col(column)
    return df.agg(
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
        F.count_if((c < lo) | (c > hi)).alias("n_outside"),
    )


