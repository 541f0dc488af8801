"""Vocabulary, TF-IDF, document frequencies, auto stop words, language id,
stemming and lemmatising, meta features and feature assembly."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from threadloom import reference_tables as ref
from threadloom.config import BLOCKS_DEFAULT, VOCAB_DEFAULT, FeatureBlocks, VocabConfig
from threadloom.functions.numeric import finite_or_zero, spread_by, zscale
from threadloom.functions.text import has_url, let, paragraphs
from threadloom.functions.tokens import (
    casual_tokens,
    expand_tokens,
    filter_stops,
    ngrams,
    simple_tokens,
    strip_digits,
    term_tokens,
)
from threadloom.operators.counts import fit_counts, weighted_rows
from threadloom.operators.emotion import BROADCAST_ROWS, small
from threadloom.operators.stems import stem_tokens
from threadloom.session import discard, materialize

#: Characters of text in one part of a layout by document; its terms take up to a hundred times that in memory.
TEXT_PART = 4_000_000


def doc_terms(df: DataFrame, id_col: str, tokens: Column | str) -> DataFrame:
    """(id, term, tf). Documents are spread by id once; the count per document
    and everything per document after it reuse that layout."""
    spread = df.select(
        F.col(id_col), (F.col(tokens) if isinstance(tokens, str) else tokens).alias("_tokens")
    ).repartition(id_col)
    return (
        spread.select(id_col, F.explode("_tokens").alias("term"))
        .groupBy(id_col, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def doc_freq(df: DataFrame, tokens: Column | str) -> DataFrame:
    """Documents per word; empty documents add nothing."""
    toks = F.col(tokens) if isinstance(tokens, str) else tokens
    return (
        df.select(F.explode(F.array_distinct(toks)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def top_tokens(df: DataFrame, group: str, tokens: Column | str, n: int) -> DataFrame:
    """Most frequent tokens per group, ties by token."""
    toks = F.col(tokens) if isinstance(tokens, str) else tokens
    counts = (
        df.select(group, F.explode(toks).alias("term"))
        .groupBy(group, "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = W.partitionBy(group).orderBy(F.col("n").desc(), F.col("term"))
    return counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def fit_vocab(
    terms: DataFrame, n_docs: Column, config: VocabConfig = VOCAB_DEFAULT, stops: list[str] | None = None
) -> DataFrame:
    """(term, df, tf, term_id, idf) from (id, term, tf) rows.

    Document-frequency bounds come first, then the ``max_features`` most used
    terms, ties by term. Ids follow the alphabet, over that bounded list.
    A whole-number ``min_df`` is a count, a fraction a share of documents.
    """
    if stops:
        terms = terms.where(~F.col("term").isin(stops))
    return choose_terms(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf")), n_docs, config)


def choose_terms(counted: DataFrame, n_docs: Column, config: VocabConfig = VOCAB_DEFAULT) -> DataFrame:
    """The same from (term, df, tf), one row per term."""
    if config.max_features > BROADCAST_ROWS:
        raise ValueError(f"max_features may not exceed {BROADCAST_ROWS}")
    lowest = F.lit(config.min_df) * n_docs if 0 < config.min_df < 1 else F.lit(config.min_df)
    used = (
        counted.where((F.col("df") >= lowest) & (F.col("df") <= F.lit(config.max_df) * n_docs))
        .orderBy(F.desc("tf"), "term")
        .limit(config.max_features)
    )
    idf = F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0
    return used.select(
        "term", "df", "tf",
        (F.row_number().over(W.orderBy("term")) - 1).alias("term_id"),
        idf.alias("idf"),
    )


def tfidf(terms: DataFrame, vocab: DataFrame, id_col: str) -> DataFrame:
    """(id, term, term_id, weight): sublinear tf times idf, rows of length one.

    The vocabulary is bounded by ``max_features``, so it is broadcast. The row
    norm reuses the layout by document.
    """
    raw = terms.join(F.broadcast(vocab.select("term", "term_id", "idf")), "term").withColumn(
        "_w", (1.0 + F.log(F.col("tf").cast("double"))) * F.col("idf")
    )
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(id_col)))
    return raw.select(id_col, "term", "term_id", (F.col("_w") / norm).alias("weight"))


def counted_tfidf(cells: DataFrame, vocab: DataFrame, id_col: str) -> DataFrame:
    """The same from (id, indices, counts) rows, one per document, without a shuffle."""
    idf = np.array([r["idf"] for r in vocab.select("term_id", "idf").orderBy("term_id").collect()])  # a bounded list
    cell = weighted_rows(cells, id_col, idf).select(id_col, F.inline(F.arrays_zip("indices", "values"))).toDF(id_col, "term_id", "weight")
    return cell.join(F.broadcast(vocab.select("term", "term_id")), "term_id").select(id_col, "term", "term_id", "weight")


def tfidf_rows(weights: DataFrame, id_col: str) -> DataFrame:
    """One row per document: sorted term ids and their weights."""
    cells = F.array_sort(F.collect_list(F.struct("term_id", "weight")))
    return (
        weights.groupBy(id_col)
        .agg(cells.alias("_c"))
        .select(
            id_col,
            F.transform("_c", lambda c: c["term_id"]).alias("indices"),
            F.transform("_c", lambda c: c["weight"]).alias("values"),
        )
    )


def model_terms(df: DataFrame, id_col: str, tokens: Column | str, stops: list[str] | None, config: VocabConfig) -> DataFrame:
    """Stop words out, then n-grams, then counts per document."""
    return doc_terms(df, id_col, ngrams(without_stops(tokens, stops), config.ngram_lo, config.ngram_hi))


def without_stops(tokens: Column | str, stops: list[str] | None) -> Column:
    toks = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.filter(toks, lambda w: ~w.isin(stops)) if stops else toks


def fit_terms(df: DataFrame, id_col: str, tokens: Column | str, stops: list[str] | None = None, config: VocabConfig = VOCAB_DEFAULT) -> tuple[DataFrame, DataFrame]:
    """The vocabulary of a table of documents and (id, indices, counts), its terms per document that has one.

    ``fit_vocab`` over ``model_terms``, without writing out the counts of all other n-grams.
    """
    n_docs = F.lit(df.count())
    found = fit_counts(df, id_col, without_stops(tokens, stops), lambda counted: choose_terms(counted, n_docs, config), config)
    if found:
        return found
    terms = materialize(model_terms(df, id_col, tokens, stops, config), "doc-terms")
    vocab = materialize(fit_vocab(terms, n_docs, config), "vocabulary")
    known = terms.join(F.broadcast(vocab.select("term", "term_id")), "term")
    cells = known.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("term_id", F.col("tf").cast("int").alias("tf")))).alias("_c"))
    cells = materialize(cells.select(id_col, F.col("_c.term_id").alias("indices"), F.col("_c.tf").alias("counts")), "document-terms")
    discard(terms)
    return vocab, cells


# ---------------------------------------------------------------------------
# Auto stop words
# ---------------------------------------------------------------------------


def auto_stop_by_doc(df: DataFrame, id_col: str, text: str, quantile: float = 0.1, min_df: int = 1) -> DataFrame:
    """(id, term): terms in the lowest idf quantile among a text's paragraphs.

    All steps share one layout by document, in parts of a fixed size.
    """
    spread = spread_by(df.select(id_col, text), id_col, F.length(text), TEXT_PART).select(
        id_col, paragraphs(text).alias("_p")
    )
    per_term = (
        spread.select(id_col, F.size("_p").alias("_n"), F.explode("_p").alias("_p"))
        .select(id_col, "_n", F.explode(F.array_distinct(term_tokens("_p"))).alias("term"))
        .groupBy(id_col, "term")
        .agg(F.max("_n").alias("_n"), F.count(F.lit(1)).alias("_df"))
        .where(F.col("_df") >= F.least(F.lit(min_df), F.col("_n")))
        .withColumn("idf", F.log((1.0 + F.col("_n")) / (1.0 + F.col("_df"))) + 1.0)
    )
    cut = F.expr(f"percentile(idf, {quantile})").over(W.partitionBy(id_col))
    return per_term.withColumn("_cut", cut).where(F.col("idf") <= F.col("_cut")).select(id_col, "term", "idf")


def auto_stop_corpus(df: DataFrame, text: str, quantile: float = 0.1, min_df: int = 1) -> DataFrame:
    """The same over the paragraphs of all texts taken as one text.

    The quantile works on the distinct document frequencies with their number
    of terms, which are few however large the vocabulary is.
    """
    paras = df.select(F.explode(paragraphs(text)).alias("_p"))
    n = paras.agg(F.count(F.lit(1)).alias("n")).scalar()
    terms = (
        paras.select(F.explode(F.array_distinct(term_tokens("_p"))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .where(F.col("df") >= min_df)
        .withColumn("idf", F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0)
    )
    steps = terms.groupBy("idf").agg(F.count(F.lit(1)).alias("_m"))
    cut = steps.agg(F.expr(f"percentile(idf, {quantile}, _m)").alias("cut")).scalar()
    return terms.withColumn("_cut", cut).where(F.col("idf") <= F.col("_cut")).select("term", "df", "idf")


# ---------------------------------------------------------------------------
# Text processing family
# ---------------------------------------------------------------------------


def lemmatize(df: DataFrame, id_col: str, tokens: str, lemma_table: DataFrame | None = None, out: str = "lemmas") -> DataFrame:
    """Replace tokens by table look-up, in the order verb, noun, adjective.

    ``lemma_table`` holds (word, pos, lemma) with pos v, n or a; without a
    table the tokens stay as they are. A table of up to ``BROADCAST_ROWS`` words is
    looked up where the tokens are, so that lists are shuffled and not single words;
    a larger one is joined. Rows of one id share their tokens, in the order of places.
    """
    if lemma_table is None:
        return df.withColumn(out, F.col(tokens))
    order = F.when(F.col("pos") == "v", 0).when(F.col("pos") == "n", 1).otherwise(2)
    best = (
        lemma_table.where(F.col("lemma") != F.col("word"))
        .groupBy("word")
        .agg(F.min_by("lemma", order).alias("_lemma"))
    )
    known = best.limit(BROADCAST_ROWS + 1).collect()
    if len(known) > BROADCAST_ROWS:
        rows = df.select(id_col, F.posexplode(tokens).alias("_pos", "word"))
        mapped = rows.join(best, "word", "left").groupBy(id_col).agg(
            F.array_sort(
                F.collect_list(F.struct("_pos", F.coalesce("_lemma", "word").alias("w")))
            ).alias("_l")
        )
        lists = F.transform("_l", lambda s: s["w"])
    else:
        mapped = (
            df.select(id_col, replaced(tokens, {r["word"]: r["_lemma"] for r in known}).alias("_w"))
            .groupBy(id_col)
            .agg(F.collect_list("_w").alias("_l"))
        )
        lists = F.when(F.size("_l") == 1, F.get("_l", 0)).otherwise(by_place("_l"))
    return (
        df.join(mapped, id_col, "left")
        .withColumn(out, F.coalesce(lists, F.array().cast("array<string>")))
        .drop("_l")
    )


def replaced(tokens: str, table: dict[str, str]) -> Column:
    """Token lists with the words of a bounded table replaced, in one narrow pass."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def look_up(lists: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else [table.get(w, w) for w in t] for t in lists], dtype=object)

    return look_up(F.col(tokens))


def by_place(lists: str) -> Column:
    """The lists of repeated ids as one, ordered by place and word."""
    placed = F.transform(lists, lambda t: F.transform(t, lambda w, i: F.struct(i.alias("i"), w.alias("w"))))
    return F.transform(F.sort_array(F.flatten(placed)), lambda s: s["w"])


def processed_tokens(text: str, stops: list[str] | None = None) -> Column:
    """Casual tokens, digits out, contractions expanded, stemmed, stops out."""
    stops = ref.base_stop_words() if stops is None else stops
    toks = expand_tokens(strip_digits(casual_tokens(text)))
    return filter_stops(stem_tokens(toks), stops)


@F.pandas_udf(T.ArrayType(T.StringType()))
def without_terms(tokens: pd.Series, terms: pd.Series) -> pd.Series:
    """Token lists without the terms of their row, one set look-up per token."""
    kept = []
    for toks, drop in zip(tokens, terms):
        drop = frozenset(() if drop is None else drop)
        kept.append(None if toks is None else [w for w in toks if w not in drop])
    return pd.Series(kept, dtype=object)


def process_text(df: DataFrame, text: str, extra_stopwords: list[str] | None = None, out: str = "tokens") -> DataFrame:
    """The base variant. ``extra_stopwords`` is accepted and, as published, has
    no effect."""
    return df.withColumn(out, processed_tokens(text))


def process_text_tfidf(
    df: DataFrame,
    id_col: str,
    text: str,
    extra_stopwords: list[str] | None = None,
    quantile: float = 0.1,
    out: str = "tokens",
) -> DataFrame:
    """The variant that also drops each text's own low-idf terms.

    Those terms are not stemmed, the tokens are, so only terms equal to their
    stem are hit.
    """
    stops = ref.base_stop_words() + [str(w).lower() for w in (extra_stopwords or [])]
    auto = auto_stop_by_doc(df, id_col, text, quantile).groupBy(id_col).agg(
        F.collect_set("term").alias("_auto")
    )
    return (
        df.withColumn("_toks", processed_tokens(text, stops))
        .join(auto, id_col, "left")
        .withColumn(out, without_terms("_toks", "_auto"))
        .drop("_toks", "_auto")
    )


def process_text_switch(
    df: DataFrame, id_col: str, text: str, tfidf_stops: bool = False, extra_stopwords: list[str] | None = None, out: str = "tokens"
) -> DataFrame:
    """The variant with a switch; extra stop words count in both positions."""
    if tfidf_stops:
        return process_text_tfidf(df, id_col, text, extra_stopwords, out=out)
    stops = ref.base_stop_words() + [str(w).lower() for w in (extra_stopwords or [])]
    return df.withColumn(out, processed_tokens(text, stops))


def stop_table(spark, *lists: list[str]) -> DataFrame:
    """Union of word lists without repeats."""
    frames = [spark.createDataFrame([(w,) for w in words], "word string") for words in lists]
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out.distinct()


# ---------------------------------------------------------------------------
# Language id
# ---------------------------------------------------------------------------


def char_grams(text: Column | str, n: int = 3) -> Column:
    """Letter n-grams of the words, each word with a blank at both ends."""
    c = F.col(text) if isinstance(text, str) else text
    letters = letter_words(c)

    def grams(word: Column) -> Column:
        return let(
            F.concat(F.lit(" "), word, F.lit(" ")),
            lambda s: F.transform(
                F.filter(F.sequence(F.lit(1), F.greatest(F.length(s) - (n - 1), F.lit(1))), lambda i: i <= F.length(s) - (n - 1)),
                lambda i: F.substring(s, i, F.lit(n)),
            ),
        )

    return F.flatten(F.transform(letters, grams))


def letter_words(text: Column | str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))


def language_profiles(df: DataFrame, text: str, lang: str, size: int = 300, n: int = 3) -> DataFrame:
    """The most frequent letter n-grams per language with their rank.

    Words are counted first; only distinct words are cut into n-grams.
    """
    words = (
        df.select(lang, F.explode(letter_words(text)).alias("word"))
        .groupBy(lang, "word")
        .agg(F.count(F.lit(1)).alias("_w"))
    )
    counts = (
        words.select(lang, "_w", F.explode(char_grams("word", n)).alias("gram"))
        .groupBy(lang, "gram")
        .agg(F.sum("_w").alias("_n"))
    )
    best = W.partitionBy(lang).orderBy(F.col("_n").desc(), F.col("gram"))
    return (
        counts.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= size)
        .select(F.col(lang).alias("profile_lang"), "gram", "rank")
    )


#: Most rows of a profile table that is packed into a function; a model's size, not the data's.
PROFILE_ROWS = 100_000


def pack_profiles(profiles: DataFrame) -> tuple[list[str], dict[str, list[tuple[int, int]]]]:
    """Profiles as (languages, gram -> [(language, weight)]), for ``lang_column``.

    A gram weighs one more than the ranks behind it in the longest profile. The table
    holds a fixed number of grams per language; more than ``PROFILE_ROWS`` rows raise
    an error (``detect_lang`` joins such a table instead).
    """
    rows = profiles.limit(PROFILE_ROWS + 1).collect()
    if len(rows) > PROFILE_ROWS:
        raise ValueError(f"more than {PROFILE_ROWS} profile rows: join them by detect_lang")
    langs = sorted({r["profile_lang"] for r in rows})
    size = max((r["rank"] for r in rows), default=0) + 1
    packed: dict[str, list[tuple[int, int]]] = {}
    for r in rows:
        packed.setdefault(r["gram"], []).append((langs.index(r["profile_lang"]), size - r["rank"]))
    return langs, packed


def lang_column(text: Column | str, packed: tuple[list[str], dict], n: int = 3) -> Column:
    """The language of a text as a column: one pass over the text, no shuffle.

    Rank-weighted overlap of its letter n-grams with each profile; the first language
    by name wins a tie. Null for a null text and one that shares nothing with any profile.
    Words reach the function joined by blanks, so a window over a gap has a blank
    inside, which no gram of a profile has.
    """
    langs, table = packed
    k = len(langs)

    # Marked so that a filter on the language is not pushed below it and run again.
    @F.pandas_udf("string")
    def detect(texts: pd.Series) -> pd.Series:
        found = []
        for s in texts:
            scores = [0] * k
            for gram, times in Counter([s[i : i + n] for i in range(len(s) - n + 1)]).items() if s else ():
                for lang, weight in table.get(gram, ()):
                    scores[lang] += times * weight
            best = max(scores, default=0)
            found.append(langs[scores.index(best)] if best else None)
        return pd.Series(found, dtype=object)

    spaced = F.concat(F.lit(" "), F.array_join(letter_words(text), " "), F.lit(" "))
    return detect.asNondeterministic()(spaced)


def tag_languages(df: DataFrame, packed: tuple[list[str], dict], texts: dict[str, str], least: int = 3) -> DataFrame:
    """Add the language of each text column under its new name (``texts``: column -> name).

    Texts of fewer than ``least`` characters are not judged and have a null.
    """
    judged = {
        name: lang_column(F.when(F.length(F.trim(text)) >= least, F.col(text)), packed) for text, name in texts.items()
    }
    return df.withColumns(judged)


def detect_lang(df: DataFrame, id_col: str, text: str, profiles: DataFrame, n: int = 3, out: str = "detected") -> DataFrame:
    """Rank-weighted overlap with each language profile; the best one wins.

    The join form of ``lang_column``, for profile tables of any size: n-grams of a
    document are scored where they are cut, and leave the task as one number per
    language. Repeated ids are judged together; a text sharing nothing with any
    profile has no row.
    """
    size = profiles.agg((F.max("rank") + 1).alias("m")).scalar()
    table = (
        profiles.withColumn("_v", size - F.col("rank"))
        .groupBy("gram")
        .agg(F.collect_list(F.struct("profile_lang", "_v")).alias("_langs"))
    )
    votes = (
        df.select(id_col, F.explode(char_grams(text, n)).alias("gram"))
        .join(small(table), "gram")
        .select(id_col, F.inline("_langs"))
        .groupBy(id_col, "profile_lang")
        .agg(F.sum("_v").alias("_score"))
    )
    return votes.groupBy(id_col).agg(
        F.min_by("profile_lang", F.struct(-F.col("_score"), F.col("profile_lang"))).alias(out)
    )


# ---------------------------------------------------------------------------
# Meta features and assembly
# ---------------------------------------------------------------------------


def text_facts(text: str, tokens: Column | None = None) -> list[Column]:
    """What ``meta_features`` takes from a text, for frames that do not carry it on."""
    return [F.size(simple_tokens(text) if tokens is None else tokens).alias("_n_tokens"), has_url(text).alias("_has_url")]


def meta_features(df: DataFrame, text: str = "text_all", log_length: bool = True, score: str = "anxiety_score") -> DataFrame:
    """Add token count (or its log1p), link flag and emotion score.

    They come from the columns of ``text_facts`` where ``df`` has these instead of the text.
    """
    size, url = (F.col("_n_tokens"), F.col("_has_url")) if "_n_tokens" in df.columns else text_facts(text)
    n = size.cast("double")
    emotion = finite_or_zero(score) if score in df.columns else F.lit(0.0)
    return (
        df.withColumn("doc_len", F.log1p(n) if log_length else n)
        .withColumn("has_url", url.cast("double"))
        .withColumn("emotion_score", emotion)
    )


def sparse_vector(size: Column | int, indices: Column, values: Column) -> Column:
    """An ml sparse vector from arrays, built inside the JVM.

    A struct with the vector's own fields goes through JSON, whose reader knows
    the vector type.
    """
    body = F.struct(
        F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            (F.lit(size) if isinstance(size, int) else size).cast("int").alias("size"),
            indices.alias("indices"),
            values.alias("values"),
        ).alias("v")
    )
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(body), schema)["v"]


META_COLUMNS = ["doc_len", "has_url", "emotion_score"]

# Mean and deviation of each scaled column.
Scaler = dict[str, tuple[float, float]]


def fit_scaler(docs: DataFrame, columns: list[str] | None = None) -> Scaler:
    """Means and population deviations over ``docs``; 1 for a constant column."""
    columns = columns or META_COLUMNS
    row = docs.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def apply_scaler(docs: DataFrame, scaler: Scaler) -> DataFrame:
    return docs.withColumns({c: (F.col(c) - mean) / dev for c, (mean, dev) in scaler.items()})


def assemble(
    docs: DataFrame,
    id_col: str,
    n_terms: int,
    n_topics: int,
    blocks: FeatureBlocks = BLOCKS_DEFAULT,
    out: str = "features",
    scaler: Scaler | None = None,
) -> DataFrame:
    """Join the chosen blocks into one sparse vector, NaN as 0.

    Meta columns are scaled by ``scaler``, or by the statistics of the rows at hand.

    ``docs`` carries the columns of the blocks: ``indices``/``values``
    (TF-IDF), ``topics`` (weights), and the meta columns.
    """
    if blocks.meta and blocks.scale_meta and scaler:
        docs = apply_scaler(docs, scaler)
    elif blocks.meta and blocks.scale_meta:
        fit = docs.where(F.col("is_train")) if blocks.fit_on == "train" else None
        docs = zscale(docs, META_COLUMNS, "", fit)
    start = 0
    idx: list[Column] = []
    val: list[Column] = []
    if blocks.tfidf:
        idx.append(F.coalesce("indices", F.array().cast("array<int>")))
        val.append(F.coalesce("values", F.array().cast("array<double>")))
        start += n_terms
    if blocks.topics:
        idx.append(F.sequence(F.lit(start), F.lit(start + n_topics - 1)))
        val.append(F.coalesce("topics", F.array_repeat(F.lit(0.0), n_topics)))
        start += n_topics
    if blocks.meta:
        idx.append(F.sequence(F.lit(start), F.lit(start + len(META_COLUMNS) - 1)))
        val.append(F.array(*[F.col(c) for c in META_COLUMNS]))
        start += len(META_COLUMNS)
    values = F.transform(F.concat(*val), finite_or_zero)
    return docs.withColumn(out, sparse_vector(start, F.concat(*idx), values))
