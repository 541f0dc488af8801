"""Label derivation, prompts and responses, labeller comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom import reference_tables as ref
from threadloom.functions.numeric import to_number
from threadloom.functions.text import (
    estimate_tokens,
    is_anxiety_category,
    preview,
    smart_truncate,
    text_or_empty,
)
from threadloom.operators.merge import prefer_source, tagged_union


def _count() -> Column:
    return F.count(F.lit(1))


# --- derivation -------------------------------------------------------------


def hand_labels(df: DataFrame, rating: str = "anxiety_rating", cut: float = 4) -> DataFrame:
    """Positive from the cut on; an unreadable rating counts as negative."""
    hit = F.coalesce(to_number(rating) >= cut, F.lit(False))
    return df.select("post_id", hit.cast("int").alias("label"))


def ai_labels(df: DataFrame, severity: float = 4, confidence: float = 0.5) -> DataFrame:
    """Positive for an anxiety category with enough severity and confidence."""
    sev = F.coalesce(to_number("ai_severity"), F.lit(0.0))
    conf = F.coalesce(to_number("ai_confidence"), F.lit(0.0))
    hit = is_anxiety_category("ai_category") & (sev >= severity) & (conf >= confidence)
    return df.select("post_id", hit.cast("int").alias("label"))


def binary_from_severity(df: DataFrame, cut: float = 3, out: str = "anxiety_level") -> DataFrame:
    hit = F.coalesce(to_number("ai_severity") >= cut, F.lit(False))
    return df.withColumn(out, hit.cast("int"))


def combined(hand: DataFrame, ai: DataFrame) -> DataFrame:
    """Both sets, hand labels first where a post has two."""
    return prefer_source(tagged_union({"hand": hand, "ai": ai})).select("post_id", "label")


def label_set_stats(hand: DataFrame, ai: DataFrame) -> DataFrame:
    """Rows, positives and rate per label set, plus the overlap."""
    sets = tagged_union({"hand": hand, "ai": ai, "combined": combined(hand, ai)})
    per_set = sets.groupBy("source").agg(
        _count().alias("n"),
        F.sum("label").alias("positives"),
        F.avg(F.col("label").cast("double")).alias("rate"),
    )
    both = tagged_union({"hand": hand, "ai": ai})
    overlap = both.agg((_count() - F.count_distinct("post_id")).alias("o")).scalar()
    return per_set.withColumn("overlap", overlap)


# --- prompt and response ----------------------------------------------------


def build_prompt(
    df: DataFrame,
    template: str = ref.PROMPT_TEMPLATE,
    title: str = "title",
    text: str = "text_all",
    group: str = "subreddit",
    max_title: int = ref.MAX_TITLE,
    max_text: int = ref.MAX_TEXT,
    max_tokens: int = ref.MAX_PROMPT_TOKENS,
) -> DataFrame:
    """Add ``prompt``; over the token budget the text is cut to half its limit."""
    head = F.substring(text_or_empty(title), 1, max_title)

    def fill(limit: int) -> Column:
        return F.format_string(template, text_or_empty(group), head, smart_truncate(text, limit))

    return (
        df.withColumn("_p", fill(max_text))
        .withColumn("prompt", F.when(estimate_tokens("_p") > max_tokens, fill(max_text // 2)).otherwise(F.col("_p")))
        .drop("_p")
    )


def parse_response(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add category, severity (a double, not rounded) and confidence read from a JSON answer.

    A code fence is taken off first. A malformed or empty answer gives ERROR, a
    missing key UNKNOWN, 0 or 0.0; a JSON null stays null.
    """
    s = F.trim(text_or_empty(raw))
    body = (
        F.when(F.startswith(s, F.lit("```json")), F.trim(F.split_part(F.split_part(s, F.lit("```json"), F.lit(2)), F.lit("```"), F.lit(1))))
        .when(F.startswith(s, F.lit("```")), F.trim(F.split_part(s, F.lit("```"), F.lit(2))))
        .otherwise(s)
    )
    parsed = df.withColumn("_b", body).withColumn("_v", F.try_parse_json("_b")).withColumn("_k", F.json_object_keys("_b"))
    ok = F.coalesce(F.expr("schema_of_variant(_v) LIKE 'OBJECT%'") & (F.size("_k") > 0), F.lit(False))

    def field(key: str, kind: str, absent, failed) -> Column:
        value = F.when(F.array_contains("_k", key), F.try_variant_get("_v", f"$.{key}", kind)).otherwise(F.lit(absent))
        return F.when(ok, value).otherwise(F.lit(failed))

    return (
        parsed.withColumn("ai_category", field("category", "string", "UNKNOWN", "ERROR"))
        .withColumn("ai_severity", field("severity", "double", 0.0, 0.0))
        .withColumn("ai_confidence", field("confidence", "double", 0.0, 0.0))
        .drop("_b", "_v", "_k")
    )


def label_rows(df: DataFrame, raw: str = "raw", title: str = "title", text: str = "text_all") -> DataFrame:
    """Result rows of a labelling run."""
    return parse_response(df, raw).select(
        "post_id", "subreddit", F.col(title).alias("title"),
        preview(text).alias("text_preview"),
        "ai_category", "ai_severity", "ai_confidence",
    )


def truncation_stats(df: DataFrame, done: DataFrame, title: str = "title", text: str = "text_all") -> DataFrame:
    """How many rows are skipped, new and cut, one row."""
    flagged = df.join(done.select("post_id", F.lit(1).alias("_done")).distinct(), "post_id", "left")
    new = F.col("_done").isNull()
    return (
        flagged.agg(
            F.count_if(~new).alias("already_labeled"),
            F.count_if(new).alias("new_processed"),
            F.count_if(new & (F.length(text_or_empty(title)) > ref.MAX_TITLE)).alias("title_truncated"),
            F.count_if(new & (F.length(text_or_empty(text)) > ref.MAX_TEXT)).alias("text_truncated"),
        )
        .withColumn("title_pct", F.col("title_truncated") * 100.0 / F.nullif("new_processed", F.lit(0)))
        .withColumn("text_pct", F.col("text_truncated") * 100.0 / F.nullif("new_processed", F.lit(0)))
    )


def label_summary(df: DataFrame) -> DataFrame:
    """Rows and mean confidence per category, overall mean beside them."""
    overall = df.agg(F.avg(to_number("ai_confidence")).alias("m")).scalar()
    return (
        df.groupBy("ai_category")
        .agg(_count().alias("n"), F.avg(to_number("ai_confidence")).alias("mean_confidence"))
        .withColumn("overall_confidence", overall)
    )


# --- comparison -------------------------------------------------------------

ANXIETY = "ANXIETY"


def is_positive_category() -> Column:
    return F.col("ai_category") == ANXIETY


def compare_groups(a: DataFrame, b: DataFrame, group: str = "subreddit") -> DataFrame:
    """Per-group statistics side by side, a missing side as 0."""
    return a.join(b, group, "full").na.fill(0)


def largest_diff(compared: DataFrame, left: str, right: str) -> DataFrame:
    return compared.withColumn("rate_difference", F.col(left) - F.col(right)).orderBy(
        F.abs("rate_difference").desc()
    )


def overlap(ai: DataFrame, hand: DataFrame) -> DataFrame:
    """Posts labelled by both, with both binary views."""
    left = ai.select(
        "post_id", "subreddit", "title", "ai_category", "ai_severity", "ai_confidence",
        is_positive_category().cast("int").alias("ai_binary"),
    )
    right = hand.select(
        "post_id", F.col("anxiety_level").cast("int").alias("human_binary"), "anxiety_rating"
    )
    return left.join(right, "post_id", "inner")


def agreement(both: DataFrame) -> DataFrame:
    same = F.col("ai_binary") == F.col("human_binary")
    return both.agg(
        _count().alias("n"),
        F.avg(same.cast("double")).alias("agreement"),
        F.count_if(~same).alias("disagreements"),
    )


def disagreement_sample(both: DataFrame, n: int = 3) -> DataFrame:
    return both.where(F.col("ai_binary") != F.col("human_binary")).orderBy("post_id").limit(n)


def edge_cases(ai: DataFrame, hand: DataFrame) -> DataFrame:
    """The five contradictory combinations, counted in one row."""
    conf, sev = to_number("ai_confidence"), to_number("ai_severity")
    level, rating = F.col("anxiety_level"), to_number("anxiety_rating")
    human = hand.agg(
        F.struct(
            F.count_if((level == 0) & (rating > 2)).alias("none_high"),
            F.count_if((level == 1) & (rating == 0)).alias("anx_zero"),
        ).alias("h")
    ).scalar()
    return (
        ai.agg(
            F.count_if((conf < 0.8) & (sev >= 4)).alias("low_conf_high_sev"),
            F.count_if((conf > 0.9) & (sev <= 1) & is_positive_category()).alias("high_conf_low_sev"),
            F.count_if((F.col("ai_category") == "NOT_ANXIETY") & (sev > 2)).alias("not_anx_high_sev"),
        )
        .withColumn("_h", human)
        .withColumn("human_none_high", F.col("_h.none_high"))
        .withColumn("human_anx_zero", F.col("_h.anx_zero"))
        .drop("_h")
    )


def confidence_stats(ai: DataFrame, low: float = 0.85) -> DataFrame:
    conf = to_number("ai_confidence")
    return ai.agg(
        F.min(conf).alias("min_conf"),
        F.max(conf).alias("max_conf"),
        F.avg(F.when(F.col("ai_category") == "ANXIETY", conf)).alias("anxiety_conf"),
        F.avg(F.when(F.col("ai_category") == "NOT_ANXIETY", conf)).alias("not_anxiety_conf"),
        F.count_if(conf < low).alias("n_low"),
        (F.count_if(conf < low) * 100.0 / _count()).alias("low_pct"),
        F.corr(conf, to_number("ai_severity")).alias("corr_conf_sev"),
    )


def conf_by_severity(ai: DataFrame) -> DataFrame:
    return ai.groupBy("ai_severity").agg(
        _count().alias("n"), F.avg(to_number("ai_confidence")).alias("mean_confidence")
    )


def share_compare(a: DataFrame, b: DataFrame, group: str = "subreddit", top_n: int | None = None) -> DataFrame:
    """Share of rows per group in both sets over the union of groups.

    With ``top_n`` only the groups with most rows overall stay. A group present
    in one set only ranks last, as its combined count is undefined.
    """

    def shares(df: DataFrame, name: str) -> DataFrame:
        total = df.agg(_count().alias("n")).scalar()
        return df.groupBy(group).agg(_count().alias(f"_n_{name}")).withColumn(
            f"share_{name}", F.col(f"_n_{name}") / total
        )

    both = shares(a, "left").join(shares(b, "right"), group, "full")
    both = both.withColumn("_n", F.col("_n_left") + F.col("_n_right"))
    if top_n is not None:
        both = both.orderBy(F.col("_n").desc_nulls_last(), group).limit(top_n)
    return both.select(
        group,
        F.coalesce("share_left", F.lit(0.0)).alias("share_left"),
        F.coalesce("share_right", F.lit(0.0)).alias("share_right"),
    )


def summary(ai: DataFrame, hand: DataFrame) -> DataFrame:
    """Rows, positive rate, mean and deviation of the two datasets."""

    def one(df: DataFrame, name: str, positive: Column, value: Column) -> DataFrame:
        return df.agg(
            F.lit(name).alias("dataset"),
            _count().alias("n"),
            (F.avg(positive.cast("double")) * 100.0).alias("rate_pct"),
            F.avg(value).alias("mean_value"),
            F.stddev_samp(value).alias("std_value"),
        )

    return one(ai, "ai", is_positive_category(), to_number("ai_severity")).unionAll(
        one(hand, "human", F.col("anxiety_level") == 1, to_number("anxiety_rating"))
    )
