"""Lexicon emotion scoring.

One narrow pass marks each token with the modifiers in the three tokens before
it, the lexicon is joined as a broadcast table after its size is checked, and
one aggregation per document follows. Its map side already collapses a document
to a single row, because a document's tokens sit in one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom import reference_tables as ref
from threadloom.functions.numeric import damped_sigmoid, half_even, severity_bucket
from threadloom.functions.text import let, one_of
from threadloom.functions.tokens import alpha_tokens
from threadloom.operators.posts import pick_text

# Rows a look-up table may hold to be sent to every executor.
BROADCAST_ROWS = 2_000_000


def fits(df: DataFrame, limit: int | None = None) -> bool:
    """Whether a look-up table is small enough to broadcast; the count stops at the limit."""
    limit = BROADCAST_ROWS if limit is None else limit
    return df.limit(limit + 1).count() <= limit


def small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Mark a look-up table for broadcast when its row count allows it.

    A larger table is joined by shuffle, where Spark splits frequent words.
    """
    return F.broadcast(df) if fits(df, limit) else df


def build_lexicon(rows: DataFrame, emotions: list[str] | None = None) -> DataFrame:
    """(word, emotions) from (word, emotion, score) rows.

    Only score "1" and listed emotions count; words are trimmed and lowercased.
    """
    emotions = ref.EMOTIONS if emotions is None else emotions
    word = F.lower(F.trim("word"))
    return (
        rows.where(
            (F.trim("score") == "1") & F.trim("emotion").isin(emotions) & (F.trim("word") != "")
        )
        .groupBy(word.alias("word"))
        .agg(F.collect_set(F.trim("emotion")).alias("emotions"))
    )


def marked_tokens(tokens: Column, window: int = 3) -> Column:
    """Each token with whether a negator or intensifier stands just before it.

    Every token becomes a two-bit code once; the codes shifted by one to
    ``window`` places are joined bit by bit.
    """

    def mark(arr: Column) -> Column:
        codes = F.transform(
            arr,
            lambda w: F.when(one_of(w, ref.NEGATORS), 1).when(one_of(w, ref.INTENSIFIERS), 2).otherwise(0),
        )

        def near(c: Column) -> Column:
            out = None
            for step in range(1, window + 1):
                kept = F.slice(c, 1, F.greatest(F.size(c) - step, F.lit(0)))
                shifted = F.concat(F.array_repeat(F.lit(0), step), kept)
                out = shifted if out is None else F.zip_with(out, shifted, _either)
            return out

        before = let(codes, near)
        return F.filter(F.zip_with(arr, before, lambda w, m: F.struct(w.alias("word"), m.alias("mods"))), lambda s: s["word"].isNotNull())

    marked = let(tokens, mark)
    return F.transform(
        marked,
        lambda s, i: F.struct(
            i.alias("pos"),
            s["word"].alias("word"),
            (s["mods"].bitwiseAND(1) > 0).alias("negated"),
            (s["mods"].bitwiseAND(2) > 0).alias("intensified"),
        ),
    )


def _either(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)).bitwiseOR(F.coalesce(b, F.lit(0)))


def matches(
    df: DataFrame,
    lexicon: DataFrame,
    id_col: str,
    tokens: Column,
    window: int = 3,
    intensifier_weight: float = 1.5,
) -> DataFrame:
    """One row per matched token with its emotions, and one empty row per document.

    ``weight`` is 1, times the intensifier weight once, times -1 once when
    negated. Under a broadcast lexicon the empty row (position -1, null emotions)
    meets an empty word put into it, so an inner join drops unmatched tokens at
    once and still keeps every document. A larger lexicon is joined by shuffle;
    there the empty rows, one per document, would share one key, so they are put
    beside the join instead.
    """
    none = F.array(
        F.struct(
            F.lit(-1).alias("pos"), F.lit("").alias("word"),
            F.lit(False).alias("negated"), F.lit(False).alias("intensified"),
        )
    )
    marked = df.select(F.col(id_col), marked_tokens(tokens, window).alias("_t"))
    rows = marked.select(
        id_col, F.size("_t").alias("n_tokens"), F.explode(F.concat("_t", none)).alias("_m")
    ).select(id_col, "n_tokens", "_m.*")
    weight = F.when(F.col("intensified"), F.lit(float(intensifier_weight))).otherwise(1.0) * F.when(
        F.col("negated"), -1.0
    ).otherwise(1.0)
    table = lexicon.select("word", "emotions")
    if fits(table):
        blank = lexicon.sparkSession.createDataFrame([("", None)], "word string, emotions array<string>")
        found = rows.join(F.broadcast(table.unionByName(blank)), "word")
    else:
        kept = marked.select(id_col, F.size("_t").alias("n_tokens"), F.inline(none)).withColumn(
            "emotions", F.lit(None).cast("array<string>")
        )
        found = rows.where(F.col("pos") >= 0).join(table, "word").unionByName(kept)
    return found.withColumn("weight", weight)


def emotion_weights(
    df: DataFrame,
    lexicon: DataFrame,
    id_col: str,
    tokens: Column,
    emotions: list[str] | None = None,
    window: int = 3,
    intensifier_weight: float = 1.5,
) -> DataFrame:
    """Per document the token count, matched tokens and a weight per emotion."""
    emotions = ref.EMOTIONS if emotions is None else emotions
    found = matches(df, lexicon, id_col, tokens, window, intensifier_weight)
    sums = [
        F.sum(
            F.when(F.array_contains("emotions", e), F.col("weight")).otherwise(0.0)
        ).alias(f"w_{e}")
        for e in emotions
    ]
    return found.groupBy(id_col).agg(
        F.max("n_tokens").alias("n_tokens"),
        F.count_if(F.col("emotions").isNotNull()).alias("n_matched"),
        *sums,
    )


def score_emotions(
    df: DataFrame,
    lexicon: DataFrame,
    id_col: str,
    tokens: Column | None = None,
    text: str = "text",
    emotions: list[str] | None = None,
    weights: dict[str, float] | None = None,
    window: int = 3,
    intensifier_weight: float = 1.5,
) -> DataFrame:
    """Counts per emotion, raw score, score in [0, 1] and label 0-5.

    An emotion without a weight adds nothing to the raw score. No tokens give
    0.0, no matches 0.5.
    """
    emotions = ref.EMOTIONS if emotions is None else emotions
    weights = ref.EMOTION_WEIGHTS if weights is None else weights
    tokens = alpha_tokens(text) if tokens is None else tokens
    sums = emotion_weights(df, lexicon, id_col, tokens, emotions, window, intensifier_weight)
    raw = F.lit(0.0)
    for e in emotions:
        if e in weights:
            raw = raw + F.col(f"w_{e}") * float(weights[e])
    counts = F.create_map(
        *[x for e in emotions for x in (F.lit(e), F.greatest(half_even(f"w_{e}"), F.lit(0)).cast("int"))]
    )
    return (
        sums.withColumn("emo_counts", counts)
        .withColumn("raw", raw)
        .withColumn(
            "norm",
            F.when(F.col("n_tokens") <= 0, 0.0).otherwise(
                damped_sigmoid(F.col("raw"), F.col("n_tokens"))
            ),
        )
        .withColumn("label", severity_bucket("norm"))
        .select(id_col, "n_tokens", "n_matched", "emo_counts", "raw", "norm", "label")
    )


def top_emotions(counts: Column, emotions: list[str] | None = None, n: int = 3) -> Column:
    """Emotions with a count, largest first, ties in the order of the list."""
    emotions = ref.EMOTIONS if emotions is None else emotions
    entries = F.array(
        *[
            F.struct((-counts[e]).alias("neg"), F.lit(i).alias("i"), F.lit(e).alias("emotion"))
            for i, e in enumerate(emotions)
        ]
    )
    present = F.filter(entries, lambda s: s["neg"] < 0)
    return F.transform(
        F.slice(F.array_sort(present), 1, n),
        lambda s: F.struct(s["emotion"].alias("emotion"), (-s["neg"]).alias("count")),
    )


def emotion_diagnostics(
    df: DataFrame,
    lexicon: DataFrame,
    id_col: str,
    text: str = "text",
    emotions: list[str] | None = None,
) -> DataFrame:
    """Matched words with their emotions, match rate and strongest emotions."""
    emotions = ref.EMOTIONS if emotions is None else emotions
    tokens = alpha_tokens(text)
    found = matches(df, lexicon, id_col, tokens)
    per_doc = found.groupBy(id_col).agg(
        F.max("n_tokens").alias("total_words"),
        F.array_sort(
            F.collect_set(F.when(F.col("emotions").isNotNull(), F.struct("word", "emotions")))
        ).alias("_hits"),
        *[
            F.sum(F.when(F.array_contains("emotions", e), F.col("weight")).otherwise(0.0)).alias(f"w_{e}")
            for e in emotions
        ],
    )
    counts = F.create_map(
        *[x for e in emotions for x in (F.lit(e), F.greatest(half_even(f"w_{e}"), F.lit(0)))]
    )
    scored = per_doc.withColumn("_counts", counts).withColumn(
        "matched_words", F.transform("_hits", lambda h: h["word"])
    )
    total = F.greatest(F.col("total_words"), F.lit(0))
    return scored.select(
        id_col,
        total.alias("total_words"),
        F.map_from_entries("_hits").alias("word_emotions"),
        "matched_words",
        F.size("matched_words").alias("n_matched_words"),
        (F.size("matched_words") / F.greatest(F.lit(1), total)).alias("match_rate"),
        F.filter(
            F.array(*map(F.lit, emotions)), lambda e: F.col("_counts")[e] > 0
        ).alias("emotions_found"),
        top_emotions(F.col("_counts"), emotions).alias("top_emotions"),
    )


def add_scores(df: DataFrame, lexicon: DataFrame, id_col: str = "post_id") -> DataFrame:
    """The corpus with ``anxiety_score``; a missing score becomes 0.5."""
    texts = pick_text(df, ["text_all", "text_main"], "_text").select(id_col, "_text")
    scores = score_emotions(texts, lexicon, id_col, text="_text").select(
        id_col, F.col("norm").alias("_norm")
    )
    return (
        df.join(scores, id_col, "left")
        .withColumn("anxiety_score", F.coalesce("_norm", F.lit(0.5)))
        .drop("_norm")
    )


def add_label(df: DataFrame, score: str = "anxiety_score", out: str = "anxiety_label") -> DataFrame:
    return df.withColumn(out, severity_bucket(score))
