"""Topic models and their measures.

Topic-word tables hold topics x vocabulary rows at most, both bounded by
configuration. Everything that touches documents is a join or an aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from threadloom.config import NMF_DEFAULT, NmfConfig
from threadloom.functions.numeric import (
    EPS,
    argmax,
    array_sum,
    cosine,
    finite_or_zero,
    l2_norm,
    row_normalize,
    softmax,
    spread_by,
)
from threadloom.functions.text import let, topic_label
from threadloom.operators.counts import tfidf_values
from threadloom.operators.emotion import small
from threadloom.session import discard, materialize

# ---------------------------------------------------------------------------
# Factorisation
# ---------------------------------------------------------------------------


def _doc_weights(batch: pd.DataFrame, h: np.ndarray, config: NmfConfig, steps: int):
    """Weights of a batch of documents for a fixed topic matrix.

    Multiplicative updates for the Kullback-Leibler objective from a flat
    start; the problem is convex in the document weights. Only the non-zero
    cells of the batch are ever formed.
    """
    sizes = batch["indices"].map(len).to_numpy().astype(np.int64)
    cols = np.concatenate(batch["indices"].to_numpy()).astype(np.int64) if sizes.sum() else np.zeros(0, np.int64)
    vals = np.concatenate(batch["values"].to_numpy()).astype(float) if sizes.sum() else np.zeros(0)
    return _solve_weights(sizes, cols, vals, h, config, steps)


def _solve_weights(sizes: np.ndarray, cols: np.ndarray, vals: np.ndarray, h: np.ndarray, config: NmfConfig, steps: int):
    """The same for documents given by their numbers of cells, with all cells one after the other."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    k, n_terms = h.shape  # the penalty on the weights is scaled by the number of terms
    w = np.full((len(sizes), k), 1.0 / k)
    column_sums = h.sum(axis=1) + config.alpha_w * config.l1_ratio * n_terms
    ridge = config.alpha_w * (1.0 - config.l1_ratio) * n_terms
    terms = np.ascontiguousarray(h.T)
    model = np.zeros(len(cols))
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(sizes, kind="stable")
    for part in _blocks(order, sizes):
        width = int(sizes[part[-1]])
        place = np.arange(width)
        inside = place < sizes[part][:, None]
        at = np.where(inside, starts[part][:, None] + place, 0)
        if width:
            x = np.where(inside, vals[at], 0.0)
            cells = terms[cols[at]]
            cells[~inside] = 0.0
        else:
            x, cells = np.zeros((len(part), 0)), np.zeros((len(part), 0, k))
        weights = w[part]
        for _ in range(steps):
            ratio = x / ((cells @ weights[:, :, None])[:, :, 0] + EPS)
            numer = (ratio[:, None, :] @ cells)[:, 0]
            weights = weights * numer / (column_sums + ridge * weights + EPS)
        w[part] = weights
        model[at[inside]] = (cells @ weights[:, :, None])[:, :, 0][inside] + EPS
    return w, rows, cols, vals, model


def _blocks(order: np.ndarray, sizes: np.ndarray, cells: int = 8192) -> Iterator[np.ndarray]:
    """Documents in the order of their sizes, in blocks of about ``cells`` cells once padded."""
    start = 0
    while start < len(order):
        end = start + max(1, cells // max(1, int(sizes[order[start]])))
        while end > start + 1 and (min(end, len(order)) - start) * int(sizes[order[min(end, len(order)) - 1]]) > 2 * cells:
            end = start + (min(end, len(order)) - start) // 2
        yield order[start:end]
        start = end


#: Cells of one part of the packed documents; its task returns one row of sums per term, 120 bytes for 15 topics.
CELL_PART = 1 << 22
#: Cells of one packed row, about 12 bytes each.
CELL_ROW = 1 << 18


def packed_documents(rows: DataFrame, total: int, n_terms: int | None = None) -> DataFrame:
    """(indices, values) rows as (sizes, cols, vals): packed bytes of many documents a row.

    Given the number of terms, the rows hold counts in place of values, and both lists take as few
    bytes a cell as they can. Every pass reads them without taking lists apart. Rows are dealt one by one, in parts
    of about ``CELL_PART`` of the ``total`` cells at most, as many as fill all cores evenly; no more
    than fill one packed row stay where they lie.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = cores * max(1, -(-total // (CELL_PART * cores)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            indices, values = batch.column(0), batch.column(1)
            sizes = np.diff(indices.offsets.to_numpy()).astype(np.int32)
            cols = indices.flatten().to_numpy(zero_copy_only=False).astype(np.int32 if n_terms is None else np.min_scalar_type(n_terms))
            vals = values.flatten().to_numpy(zero_copy_only=False)
            vals = vals.astype(np.float64 if n_terms is None else np.min_scalar_type(int(vals.max(initial=0))))
            ends = np.cumsum(sizes, dtype=np.int64)
            start = 0
            while start < len(sizes):
                done = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + CELL_ROW, side="right")))
                upto = int(ends[stop - 1])
                packed = (sizes[start:stop], cols[done:upto], vals[done:upto])
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in packed], ["sizes", "cols", "vals"])
                start = stop

    data = rows.select("indices", "values" if n_terms is None else "counts")
    dealt = data.repartition(parts) if total > CELL_ROW else data
    return dealt.mapInArrow(pack, "sizes binary, cols binary, vals binary")


def _objective_part(w, vals, model, h) -> float:
    cells = float(np.sum(vals * np.log(np.maximum(vals, EPS) / model) - vals))
    return cells + float((w @ h.sum(axis=1)).sum())


def _start_topics(n_terms: int, mean: float, config: NmfConfig) -> np.ndarray:
    rng = np.random.default_rng(config.seed)
    scale = np.sqrt(max(mean, EPS) / config.k)
    return np.abs(rng.standard_normal((config.k, n_terms))) * scale + EPS


def fit_nmf(
    rows: DataFrame, n_terms: int, config: NmfConfig = NMF_DEFAULT, n_docs: int | None = None, idf: np.ndarray | None = None
) -> tuple[np.ndarray, list[float]]:
    """Fit topics x terms on (indices, values) rows, or with ``idf`` on (indices, counts) rows.

    Counts take a third of the bytes of values or less; a task weighs them as it reads them.

    The penalty on the topics is scaled by the number of documents, so its weight
    stays the same as data grows; ``n_docs`` counts documents without a row too.

    The rows are packed once (``packed_documents``). Each iteration is one narrow pass over
    them. A task solves its documents' weights for
    the current topics and returns one row of partial sums per term, a column for
    each topic; these are summed by key. No state but the topic matrix (k x vocabulary numbers) moves
    between iterations, so there is no lineage to cut and a lost executor costs
    only its own tasks. Pass a table or a persisted frame.

    Returns the matrix and the objective of every iteration.
    """
    spark = rows.sparkSession
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("indices").cast("bigint")).alias("cells")).first()
    if not stats["n"]:
        raise ValueError("no documents to factorise")
    data = materialize(packed_documents(rows, stats["cells"], None if idf is None else n_terms), "packed-documents")

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for packed in chain.from_iterable(zip(*batch.columns) for batch in batches):
            sizes, cols, vals = (b.as_buffer() for b in packed)
            sizes = np.frombuffer(sizes, "i4").astype(np.int64)
            n = max(1, int(sizes.sum()))
            cols = np.frombuffer(cols, "i4" if idf is None else f"u{len(cols) // n or 1}").astype(np.int64)
            if idf is None:
                yield sizes, cols, np.frombuffer(vals, "f8")
            else:
                yield sizes, cols, tfidf_values(sizes, cols, np.frombuffer(vals, f"u{len(vals) // n or 1}").astype(float), idf)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, vals in unpacked(batches):
            yield pa.RecordBatch.from_arrays([pa.array([float(vals.sum())])], ["total"])

    total = data.mapInArrow(summed, "total double").agg(F.sum("total").alias("total")).first()["total"]
    scale = float(stats["n"] if n_docs is None else n_docs)
    mean = (total or 0.0) / (scale * n_terms)
    h = _start_topics(n_terms, mean, config)
    history: list[float] = []
    steps = config.inner_steps
    names = [f"t{t}" for t in range(config.k)]
    cores = spark.sparkContext.defaultParallelism  # the sums are as many as the vocabulary, however large the input is

    for _ in range(config.max_iter):
        shared = spark.sparkContext.broadcast(h)

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            topics = shared.value
            k, n_terms = topics.shape
            numer = np.zeros((n_terms, k))
            w_sum = np.zeros(k)
            loss = 0.0
            for sizes, cols, vals in unpacked(batches):
                w, r, cols, vals, model = _solve_weights(sizes, cols, vals, topics, config, steps)
                ratio = vals / model
                for t in range(k):
                    numer[:, t] += np.bincount(cols, weights=w[r, t] * ratio, minlength=n_terms)
                w_sum += w.sum(axis=0)
                loss += _objective_part(w, vals, model, topics)
            used = np.flatnonzero(numer.any(axis=1))
            # one row per term, then the sums of the weights (-1) and the objective (-2)
            sums = np.vstack([numer[used], w_sum, np.full(k, loss)])
            keys = np.concatenate([used, [-1, -2]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, np.ascontiguousarray(sums.T))], ["term_id", *names])

        sums = (
            data.mapInArrow(step, "term_id int, " + ", ".join(f"{c} double" for c in names))
            .repartition(cores, "term_id")
            .groupBy("term_id")
            .agg(*[F.sum(c).alias(c) for c in names])
            .toPandas()
        ).set_index("term_id")
        shared.destroy()
        if len(history) % 10 == 9:
            spark._jvm.System.gc()  # files of shuffles go when the driver's collector finds that nothing refers to them
        loss = float(sums.loc[-2, names[0]])
        totals = sums.loc[-1].to_numpy()
        cells = sums[sums.index >= 0]
        numer = np.zeros_like(h)
        numer[:, cells.index.to_numpy()] = cells.to_numpy().T
        l1 = config.alpha_h * config.l1_ratio * scale
        l2 = config.alpha_h * (1.0 - config.l1_ratio) * scale
        penalty = l1 * float(h.sum()) + 0.5 * l2 * float((h * h).sum())
        history.append(loss + penalty)
        h = h * numer / (totals[:, None] + l1 + l2 * h + EPS)
        if len(history) > 1 and abs(history[-2] - history[-1]) <= config.tol * abs(history[0]):
            break
    discard(data)
    return h, history


def nmf_transform(rows: DataFrame, h: np.ndarray, config: NmfConfig = NMF_DEFAULT, steps: int = 100, out: str = "topics") -> DataFrame:
    """Add each document's topic weights for fixed topics, one narrow pass."""
    shared = rows.sparkSession.sparkContext.broadcast(h)
    columns = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                w = _doc_weights(batch, shared.value, config, steps)[0]
                yield batch[columns].assign(**{out: list(w)})

    return rows.mapInPandas(run, f"{schema}, `{out}` array<double>")


def topic_table(spark, h: np.ndarray, terms: list[str]) -> DataFrame:
    """(topic, term, weight) of a fitted matrix; k x vocabulary rows."""
    k, v = h.shape
    frame = pd.DataFrame(
        {
            "topic": np.repeat(np.arange(k, dtype=np.int32), v),
            "term": np.tile(np.array(terms, dtype=object), k),
            "weight": h.ravel(),
        }
    )
    return spark.createDataFrame(frame, "topic int, term string, weight double")


# ---------------------------------------------------------------------------
# Topic words
# ---------------------------------------------------------------------------


def top_terms_by_lift(topics: DataFrame, term_sums: DataFrame, n: int = 12) -> DataFrame:
    """Terms per topic by weight over the term's column sum, best first."""
    lift = topics.join(term_sums, "term").withColumn("lift", F.col("weight") / (F.col("term_sum") + EPS))
    best = W.partitionBy("topic").orderBy(F.col("lift").desc(), F.col("term"))
    return (
        lift.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n)
        .select("topic", "rank", "term", "weight", "lift")
    )


def auto_cross_stop(top: DataFrame, k: int) -> DataFrame:
    """Terms in the top lists of at least half the topics (two at least)."""
    return (
        top.groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_topics"))
        .where(F.col("n_topics") >= max(2, k // 2))
    )


def topic_names(top: DataFrame, n: int = 3, limit: int = 35) -> DataFrame:
    terms = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]
    )
    return (
        top.groupBy("topic")
        .agg(terms.alias("_terms"))
        .select("topic", topic_label(F.col("_terms"), n, limit).alias("topic_name"))
    )


def label_words(names: DataFrame, noise: list[str], column: str = "topic_name") -> DataFrame:
    """Words of the topic names without noise words, counted."""
    return (
        names.select(F.explode(F.split(column, r"\s+")).alias("word"))
        .where((F.col("word") != "") & ~F.lower("word").isin(noise))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# ---------------------------------------------------------------------------
# Assignment and simple measures
# ---------------------------------------------------------------------------


def assign_topics(df: DataFrame, names: DataFrame, weights: str = "topics") -> DataFrame:
    """Add ``topic`` (first largest), ``conf`` and ``topic_name``.

    The name table has one row per topic of the model; it is broadcast after its size is checked.
    """
    return (
        df.withColumn("_p", row_normalize(weights))
        .withColumn("topic", argmax("_p"))
        .withColumn("conf", F.array_max("_p"))
        .drop("_p")
        .join(small(names), "topic", "left")
    )


def purity(df: DataFrame, weights: str = "topics", threshold: float = 0.40) -> DataFrame:
    """Share of rows whose largest normalised weight reaches the threshold.

    Also takes one probability per row; NaN counts as 0.
    """
    if df.schema[weights].dataType.typeName() == "array":
        clean = F.transform(weights, finite_or_zero)
        score = F.array_max(row_normalize(clean))
    else:
        score = finite_or_zero(weights)
    return df.agg(F.avg((score >= threshold).cast("double")).alias("purity"))


def topic_stats(df: DataFrame, names: DataFrame, tokens: Column) -> DataFrame:
    """Rows, confidence mean and deviation, mean token count per topic."""
    return (
        df.groupBy("topic")
        .agg(
            F.count("conf").alias("n"),
            F.round(F.avg("conf"), 3).alias("avg_confidence"),
            F.round(F.stddev_samp("conf"), 3).alias("conf_std"),
            F.round(F.avg(tokens.cast("double")), 3).alias("avg_doc_length"),
        )
        .join(small(names), "topic", "left")
    )


def _pairs(topics: DataFrame, key: str = "topic") -> DataFrame:
    """All topic pairs i < j from one row holding the topic ids."""
    ids = topics.select(key).distinct().agg(F.array_sort(F.collect_list(key)).alias("_ids"))
    pairs = let(
        F.col("_ids"),
        lambda a: F.flatten(
            F.transform(
                a,
                lambda x: F.transform(
                    F.filter(a, lambda y: y > x), lambda y: F.struct(x.alias("i"), y.alias("j"))
                ),
            )
        ),
    )
    return ids.select(F.inline(pairs))


def topic_similarity(topics: DataFrame) -> DataFrame:
    """(i, j, sim, dist) of all topic pairs over their word weights.

    Topics meet on shared terms; a pair without one has similarity 0.
    """
    norms = topics.groupBy("topic").agg(
        F.greatest(F.sqrt(F.sum(F.col("weight") * F.col("weight"))), F.lit(EPS)).alias("_norm")
    )
    unit = topics.join(small(norms), "topic").select(
        "topic", "term", (F.col("weight") / F.col("_norm")).alias("_u")
    )
    left = unit.select(F.col("topic").alias("i"), "term", F.col("_u").alias("_a"))
    right = unit.select(F.col("topic").alias("j"), "term", F.col("_u").alias("_b"))
    shared = (
        left.join(right, "term")
        .where(F.col("i") < F.col("j"))
        .groupBy("i", "j")
        .agg(F.sum(F.col("_a") * F.col("_b")).alias("_sim"))
    )
    return (
        _pairs(topics)
        .join(shared, ["i", "j"], "left")
        .select("i", "j", F.coalesce("_sim", F.lit(0.0)).alias("sim"))
        .withColumn("dist", 1.0 - F.col("sim"))
    )


def mean_topic_cosine(topics: DataFrame) -> DataFrame:
    """Mean over the pairs i < j; a single topic gives 0."""
    return topic_similarity(topics).agg(
        F.coalesce(F.avg("sim"), F.lit(0.0)).alias("mean_cosine")
    )


def centroid_similarity(df: DataFrame, topic: str, vector: str, max_topics: int = 30) -> DataFrame:
    """Similarity of the mean vectors of the most frequent topics."""
    sizes = df.groupBy(topic).agg(F.count(F.lit(1)).alias("n"))
    frequent = F.broadcast(sizes.orderBy(F.desc("n"), topic).limit(max_topics).select(topic))
    means = (
        df.join(frequent, topic)
        .select(topic, F.posexplode(vector).alias("pos", "x"))
        .groupBy(topic, "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy(topic)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("v"))
    )
    rows = means.agg(F.array_sort(F.collect_list(F.struct(F.col(topic).alias("t"), "v"))).alias("_m"))
    pairs = let(
        F.col("_m"),
        lambda m: F.flatten(
            F.transform(
                m,
                lambda a: F.transform(
                    F.filter(m, lambda b: b["t"] > a["t"]),
                    lambda b: F.struct(
                        a["t"].alias("i"), b["t"].alias("j"), cosine(a["v"], b["v"]).alias("sim")
                    ),
                ),
            )
        ),
    )
    return rows.select(F.inline(pairs)).withColumn("dist", 1.0 - F.col("sim"))


def topic_metrics(assigned: DataFrame, top: DataFrame, n: int, topic: str = "topic") -> DataFrame:
    """Outlier share (topic -1), word diversity and number of topics."""
    words = top.where(F.col("topic") != -1).agg(
        F.struct(
            F.count_distinct("term").alias("words"), F.count_distinct("topic").alias("topics")
        ).alias("w")
    ).scalar()
    return (
        assigned.agg(F.avg((F.col(topic) == -1).cast("double")).alias("outlier_fraction"))
        .withColumn("_w", words)
        .select(
            "outlier_fraction",
            (F.col("_w.words") / (F.col("_w.topics") * F.lit(float(n)))).alias("topic_diversity"),
            F.col("_w.topics").alias("n_topics"),
        )
    )


# ---------------------------------------------------------------------------
# Coherence
# ---------------------------------------------------------------------------


BITS = 62  # words a mask holds; further words go to further masks


def _bit(rank: str) -> Column:
    return F.expr(f"shiftleft(1L, ({rank} - 1) % {BITS})")


def _holds(masks: str, rank: str) -> Column:
    at = F.expr(f"CAST(({rank} - 1) div {BITS} AS INT)")
    return F.coalesce(F.get(F.col(masks), at).bitwiseAND(_bit(rank)) != 0, F.lit(False))


def _masks_to_pairs(masks: DataFrame, top: DataFrame) -> DataFrame:
    """(topic, w1, w2, n) from (topic, masks, n), w1 <= w2 by rank.

    The masks name the topic words a unit of text holds, one bit per rank. Only
    distinct masks are compared with the word pairs of their topic.
    """
    words = top.groupBy("topic").agg(
        F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_words")
    )
    pairs = let(
        F.col("_words"),
        lambda ws: F.flatten(
            F.transform(
                ws,
                lambda a: F.transform(
                    F.filter(ws, lambda b: b["rank"] >= a["rank"]),
                    lambda b: F.struct(
                        a["rank"].alias("r1"), b["rank"].alias("r2"),
                        a["term"].alias("w1"), b["term"].alias("w2"),
                    ),
                ),
            )
        ),
    )
    table = words.select("topic", F.inline(pairs))
    return (
        table.join(masks, "topic", "left")
        .withColumn("_hit", _holds("masks", "r1") & _holds("masks", "r2"))
        .groupBy("topic", "r1", "r2", "w1", "w2")
        .agg(F.coalesce(F.sum(F.when(F.col("_hit"), F.col("n"))), F.lit(0)).alias("n"))
    )


def _topic_words(top: DataFrame, n_words: int) -> DataFrame:
    """One row per word with its (topic, mask number, bit) entries.

    A rank beyond ``n_words`` is an error, as it would have no mask.
    """
    number = F.when(F.col("rank") <= n_words, F.expr(f"CAST((rank - 1) div {BITS} AS INT)")).otherwise(
        F.raise_error(F.format_string(f"a topic has more than {n_words} words: rank %d", "rank")).cast("int")
    )
    return top.groupBy("term").agg(
        F.collect_list(F.struct("topic", number.alias("number"), _bit("rank").alias("bit"))).alias("_t")
    )


#: Tokens behind one part of a layout by document.
TOKEN_PART = 1_000_000


def _numbers(n_words: int) -> range:
    return range(-(-n_words // BITS))


def cooccurrence(df: DataFrame, id_col: str, tokens: Column | str, top: DataFrame, n_words: int = BITS) -> DataFrame:
    """Documents holding both words, for the word pairs of each topic.

    Documents are reduced to bit masks per topic, equal ones are counted, and
    pairs are formed from the distinct ones, never inside a document.
    ``n_words`` is the length of the longest word list of a topic.
    """
    toks = F.col(tokens) if isinstance(tokens, str) else tokens
    held = [F.bit_or(F.when(F.col("number") == i, F.col("bit")).otherwise(F.lit(0).cast("bigint"))) for i in _numbers(n_words)]
    hits = (
        df.select(id_col, F.explode(F.array_distinct(toks)).alias("term"))
        .join(small(_topic_words(top, n_words)), "term")
        .select(id_col, F.inline("_t"))
        .groupBy(id_col, "topic")
        .agg(F.array(*held).alias("masks"))
    )
    masks = hits.groupBy("topic", "masks").agg(F.count(F.lit(1)).alias("n"))
    return _masks_to_pairs(masks, top)


def coherence_npmi(
    df: DataFrame, id_col: str, tokens: Column | str, top: DataFrame, min_co: int = 2, eps: float = 1e-12, n_words: int = BITS
) -> DataFrame:
    """Per topic the mean NPMI of its word pairs and the number of pairs used.

    Probabilities are over all documents. Pairs met in fewer than ``min_co``
    documents and undefined values are left out; the model's coherence is the
    mean over the topics listed.
    """
    n_docs = df.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    cells = materialize(cooccurrence(df, id_col, tokens, top, n_words), "cells")
    single = cells.where(F.col("r1") == F.col("r2")).select("topic", F.col("r1").alias("_r"), F.col("n").alias("_df"))
    one = single.select("topic", F.col("_r").alias("r1"), F.col("_df").alias("_n1"))
    two = single.select("topic", F.col("_r").alias("r2"), F.col("_df").alias("_n2"))
    pairs = (
        cells.where((F.col("r1") < F.col("r2")) & (F.col("n") >= min_co))
        .join(one, ["topic", "r1"])
        .join(two, ["topic", "r2"])
        .withColumn("_docs", n_docs)
        .withColumn("p12", F.col("n") / F.col("_docs"))
        .withColumn("p1", F.col("_n1") / F.col("_docs"))
        .withColumn("p2", F.col("_n2") / F.col("_docs"))
        .where((F.col("p12") > eps) & (F.col("p1") > eps) & (F.col("p2") > eps) & (F.col("p12") < 1.0))
        .withColumn("npmi", F.log(F.col("p12") / (F.col("p1") * F.col("p2"))) / -F.log("p12"))
    )
    return pairs.groupBy("topic").agg(F.avg("npmi").alias("npmi"), F.count(F.lit(1)).alias("n_pairs"))


def window_masks(
    df: DataFrame, id_col: str, tokens: Column | str, top: DataFrame, window: int = 110, n_words: int = BITS
) -> DataFrame:
    """(topic, masks, n): sliding windows by the topic words they hold.

    Windows are never listed. An occurrence at p lies in the windows starting
    in (p - window, p]; per word these ranges are made disjoint, so each is a
    bit switched on and off again, and a running sum of the switches is the
    mask between them. One sort per document and topic does it.
    """
    toks = F.col(tokens) if isinstance(tokens, str) else tokens
    rows = df.select(F.col(id_col), toks.alias("_toks")).select(
        id_col,
        F.greatest(F.size("_toks") - window, F.lit(0)).alias("_last"),
        F.posexplode("_toks").alias("p", "term"),
    )
    hits = rows.join(small(_topic_words(top, n_words)), "term").select(
        id_col, "_last", "p", F.inline("_t")
    )
    same_word = W.partitionBy(id_col, "topic", "number", "bit").orderBy("p")
    ranges = (
        spread_by(hits, id_col, F.size(toks), TOKEN_PART, df)
        .withColumn("_before", F.lag("p").over(same_word))
        .withColumn(
            "_from",
            F.greatest(F.coalesce(F.col("_before") + 1, F.lit(0)), F.col("p") - (window - 1), F.lit(0)),
        )
        .withColumn("_to", F.least("p", "_last"))
        .where(F.col("_from") <= F.col("_to"))
    )
    switches = (
        ranges.select(
            id_col, "topic", "_last",
            F.inline(
                F.array(
                    F.struct(F.col("_from").alias("at"), "number", F.col("bit").alias("delta")),
                    F.struct((F.col("_to") + 1).alias("at"), "number", (-F.col("bit")).alias("delta")),
                )
            ),
        )
        .groupBy(id_col, "topic", "at")
        .agg(
            *[F.sum(F.when(F.col("number") == i, F.col("delta")).otherwise(0)).alias(f"_d{i}") for i in _numbers(n_words)],
            F.max("_last").alias("_last"),
        )
    )
    sweep = W.partitionBy(id_col, "topic").orderBy("at")
    masks = F.array(*[F.sum(f"_d{i}").over(sweep) for i in _numbers(n_words)])
    return (
        switches.withColumn("masks", masks)
        .withColumn("_next", F.coalesce(F.lead("at").over(sweep), F.col("_last") + 1))
        .where(F.exists("masks", lambda m: m != 0) & (F.col("_next") > F.col("at")))
        .groupBy("topic", "masks")
        .agg(F.sum(F.col("_next") - F.col("at")).alias("n"))
    )


def coherence_cv(
    df: DataFrame, id_col: str, tokens: Column | str, top: DataFrame, window: int = 110, eps: float = 1e-12, n_words: int = BITS
) -> DataFrame:
    """Per topic the c_v coherence of its words.

    Each word's NPMI with all words of its topic, taken over sliding windows,
    is compared by cosine with the sum of these vectors over the topic.
    """
    toks = F.col(tokens) if isinstance(tokens, str) else tokens
    n_windows = df.agg(
        F.sum(F.when(F.size(toks) > 0, F.greatest(F.size(toks) - window + 1, F.lit(1))).otherwise(0)).cast("double").alias("n")
    ).scalar()
    cells = materialize(_masks_to_pairs(window_masks(df, id_col, toks, top, window, n_words), top), "cells")
    single = cells.where(F.col("r1") == F.col("r2"))
    one = single.select("topic", "r1", F.col("n").alias("_n1"))
    two = single.select("topic", "r2", F.col("n").alias("_n2"))
    scored = (
        cells.join(one, ["topic", "r1"])
        .join(two, ["topic", "r2"])
        .withColumn("_N", n_windows)
        .withColumn("_p12", F.col("n") / F.col("_N"))
        .withColumn("_den", (F.col("_n1") / F.col("_N")) * (F.col("_n2") / F.col("_N")))
        .withColumn(
            "npmi",
            F.when(F.col("_den") <= 0, 0.0).otherwise(
                F.log((F.col("_p12") + eps) / F.col("_den")) / -F.log(F.col("_p12") + eps)
            ),
        )
        .select("topic", "r1", "r2", "npmi")
    )
    both = scored.unionByName(
        scored.where(F.col("r1") < F.col("r2")).select(
            "topic", F.col("r2").alias("r1"), F.col("r1").alias("r2"), "npmi"
        )
    )
    vectors = both.groupBy("topic", "r1").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("r2", "npmi"))), lambda s: s["npmi"]).alias("v")
    )
    totals = (
        both.groupBy("topic", "r2").agg(F.sum("npmi").alias("npmi")).groupBy("topic").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("r2", "npmi"))), lambda s: s["npmi"]).alias("total")
        )
    )
    return (
        vectors.join(totals, "topic")
        .groupBy("topic")
        .agg(F.avg(cosine("v", "total")).alias("c_v"))
    )


# ---------------------------------------------------------------------------
# Cluster topics
# ---------------------------------------------------------------------------


def c_tfidf(
    df: DataFrame, topic: str, tokens: Column | str, sqrt_tf: bool = False, bm25: bool = False
) -> DataFrame:
    """(topic, term, tf, weight) with every topic taken as one document.

    The term frequency is relative to the topic's length; the weight of a term
    falls with its total frequency f against the mean topic length A (floored):
    ln(1 + A/f), or ln(1 + (A - f + 0.5)/(f + 0.5)).
    """
    toks = F.col(tokens) if isinstance(tokens, str) else tokens
    cells = (
        df.select(F.col(topic).alias("topic"), F.explode(toks).alias("term"))
        .groupBy("topic", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    lengths = cells.groupBy("topic").agg(F.sum("tf").alias("_len"))
    average = lengths.agg(F.floor(F.avg("_len")).cast("double").alias("a")).scalar()
    f = F.sum("tf").over(W.partitionBy("term"))
    share = F.col("tf") / F.col("_len")
    local = F.sqrt(share) if sqrt_tf else share
    if bm25:
        spread = F.log(1.0 + (F.col("_a") - F.col("_f") + 0.5) / (F.col("_f") + 0.5))
    else:
        spread = F.log(1.0 + F.col("_a") / F.col("_f"))
    return (
        cells.withColumn("_f", f)
        .join(lengths, "topic")
        .withColumn("_a", average)
        .select("topic", "term", "tf", (local * spread).alias("weight"))
    )


def top_by_weight(weights: DataFrame, n: int) -> DataFrame:
    best = W.partitionBy("topic").orderBy(F.col("weight").desc(), F.col("term"))
    return weights.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def cluster_embeddings(
    df: DataFrame, vector: str, k: int = 10, components: int = 5, threshold: float | None = None, seed: int = 42
) -> DataFrame:
    """Reduce, cluster and mark outliers.

    Principal components, then k-means; a row farther from its centre than
    ``threshold`` gets topic -1 (the 95th percentile of distances by default).
    ``prob`` is the softmax of the negative distances at the chosen centre.
    A different algorithm from density clustering, with the same outputs.
    """
    rows = df.withColumn("_v", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    reduced = PCA(k=components, inputCol="_v", outputCol="_r").fit(rows).transform(rows)
    model = KMeans(k=k, seed=seed, featuresCol="_r", predictionCol="_cluster").fit(reduced)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    dists = F.transform(
        centres,
        lambda c: l2_norm(F.zip_with(c, F.col("_point"), lambda a, b: a - b)),
    )
    scored = (
        model.transform(reduced)
        .withColumn("_point", vector_to_array("_r"))
        .withColumn("_d", dists)
        .withColumn("distance", F.get("_d", F.col("_cluster")))
        .withColumn("prob", F.get(softmax(F.transform("_d", lambda d: -d)), F.col("_cluster")))
    )
    if threshold is None:
        limit = scored.agg(F.percentile_approx("distance", 0.95, 10000).alias("t")).scalar()
    else:
        limit = F.lit(threshold)
    return (
        scored.withColumn("_limit", limit)
        .withColumn("topic", F.when(F.col("distance") > F.col("_limit"), -1).otherwise(F.col("_cluster")))
        .drop("_v", "_r", "_cluster", "_point", "_d", "_limit")
    )


def document_info(df: DataFrame, assigned: DataFrame, key: str, helpers: list[str]) -> DataFrame:
    """Source rows with topic, name and probability; helper columns dropped."""
    return df.join(assigned, key, "left").drop(*helpers)


def compare_configs(runs: dict[str, DataFrame], name: str = "config") -> DataFrame:
    """One row of measures per configuration."""
    frames = [df.select(F.lit(n).alias(name), "*") for n, df in runs.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
