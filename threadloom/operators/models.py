"""Training, tuning, calibration, ablation and scoring with ``pyspark.ml``."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from itertools import product

import numpy as np
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, Window as W, functions as F

from threadloom.config import (
    BLOCKS_DEFAULT,
    FOREST_DEFAULT,
    GRID_DEFAULT,
    NMF_DEFAULT,
    VOCAB_DEFAULT,
    FeatureBlocks,
    ForestConfig,
    LogRegGrid,
    NmfConfig,
    VocabConfig,
)
from threadloom.functions.numeric import zscale
from threadloom.functions.tokens import simple_tokens
from threadloom.operators import evaluate, features as feat, logistic, sampling, topics as topic_ops
from threadloom.operators.counts import weighted_rows
from threadloom.operators.forest import Forest, cells_of, fit_forest
from threadloom.session import materialize


@dataclass(frozen=True)
class TopicModel:
    """A fitted vocabulary, topic matrix and topic names.

    Right after the fit it also holds the counts (id, indices, counts) of its documents.
    """

    vocab: DataFrame
    matrix: np.ndarray
    terms: tuple[str, ...]
    names: DataFrame
    top: DataFrame
    history: tuple[float, ...] = ()
    id_col: str | None = None
    idf: np.ndarray | None = None
    doc_cells: DataFrame | None = None

    @property
    def doc_rows(self) -> DataFrame:
        """The TF-IDF rows (id, indices, values) of the fitted documents."""
        return weighted_rows(self.doc_cells, self.id_col, self.idf)

    @property
    def n_terms(self) -> int:
        return self.matrix.shape[1]

    @property
    def k(self) -> int:
        return self.matrix.shape[0]


def _vocab_terms(vocab: DataFrame) -> tuple[list[str], np.ndarray]:
    """The vocabulary and its idf in id order; at most ``max_features`` words."""
    rows = vocab.select("term", "term_id", "idf").orderBy("term_id").collect()
    return [r["term"] for r in rows], np.array([r["idf"] for r in rows])


def fit_topics(
    docs: DataFrame,
    id_col: str,
    tokens: str,
    stops: list[str] | None = None,
    vocab_config: VocabConfig = VOCAB_DEFAULT,
    nmf_config: NmfConfig = NMF_DEFAULT,
    top_n: int = 12,
) -> TopicModel:
    """Vocabulary, TF-IDF, factorisation, topic words and names.

    The vocabulary and the counts of its terms per document are written to the shared
    folder, because every later pass reads them again. Pass a table: it is read several times.
    """
    spark = docs.sparkSession
    vocab, cells = feat.fit_terms(docs, id_col, tokens, stops, vocab_config)
    words, idf = _vocab_terms(vocab)
    if not words:
        raise ValueError("no term passes the vocabulary bounds")
    rows = weighted_rows(cells, id_col, idf)
    matrix, history = topic_ops.fit_nmf(cells, len(words), nmf_config, docs.count(), idf)
    table = topic_ops.topic_table(spark, matrix, words)
    sums = rows.select(F.inline(F.arrays_zip("indices", "values"))).groupBy("indices").agg(
        F.sum("values").alias("term_sum")
    )
    named = sums.join(F.broadcast(vocab.select("term", F.col("term_id").alias("indices"))), "indices")
    top = materialize(topic_ops.top_terms_by_lift(table, named.select("term", "term_sum"), top_n), "topic-words")
    names = topic_ops.topic_names(top)
    return TopicModel(vocab, matrix, tuple(words), names, top, tuple(history), id_col, idf, cells)


def auto_stop_words(docs: DataFrame, id_col: str, tokens: str, vocab_config: VocabConfig, nmf_config: NmfConfig) -> list[str]:
    """Terms that lead at least half the topics of a baseline model."""
    model = fit_topics(docs, id_col, tokens, None, vocab_config, nmf_config)
    return [r["term"] for r in topic_ops.auto_cross_stop(model.top, model.k).collect()]


def document_vectors(docs: DataFrame, id_col: str, tokens: str, model: TopicModel, vocab_config: VocabConfig = VOCAB_DEFAULT, nmf_config: NmfConfig = NMF_DEFAULT, stops: list[str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """(id, indices, values, topics), one row for every document, under a fitted model.

    A document without known terms has no cells and zero weights for all topics. ``known``
    are the TF-IDF rows of ``docs`` where they have been made before, or the counts of the fit, which
    are less to join.
    """
    if known is None:
        terms = feat.model_terms(docs, id_col, tokens, stops, vocab_config)
        known = feat.tfidf_rows(feat.tfidf(terms, model.vocab, id_col), id_col)
    lists = [c for c in known.columns if c != id_col]
    rows = docs.select(id_col).join(known, id_col, "left").select(
        id_col, *[F.coalesce(c, F.array().cast(known.schema[c].dataType)).alias(c) for c in lists]
    )
    if "counts" in lists:
        rows = weighted_rows(rows, id_col, model.idf)
    return topic_ops.nmf_transform(rows, model.matrix, nmf_config)


def joined_rows(model: TopicModel, other: DataFrame, id_col: str) -> DataFrame:
    """TF-IDF rows of the fitted documents joined to ``other`` by id, from the counts of the fit."""
    return weighted_rows(joined_cells(model, other, id_col), id_col, model.idf)


def joined_cells(model: TopicModel, other: DataFrame, id_col: str) -> DataFrame:
    """Counts of the fitted documents joined to ``other`` by id.

    An id that ``other`` holds several times repeats its documents, so its counts are
    multiplied as often.
    """
    times = other.groupBy(id_col).agg(F.count(F.lit(1)).alias("_times"))
    return model.doc_cells.join(times, id_col).select(id_col, "indices", F.transform("counts", lambda n: (n * F.col("_times")).cast("int")).alias("counts"))


def build_features(
    labelled: DataFrame,
    vectors: DataFrame,
    id_col: str,
    n_terms: int,
    n_topics: int,
    blocks: FeatureBlocks = BLOCKS_DEFAULT,
    text: str = "text_all",
    scaler: feat.Scaler | None = None,
) -> DataFrame:
    """Labelled posts with meta features and the assembled vector.

    A fitted ``scaler`` makes a post's vector independent of the posts beside it.
    """
    meta = feat.meta_features(labelled, text, blocks.log_length)
    joined = meta.join(vectors, id_col, "left")
    return feat.assemble(joined, id_col, n_terms, n_topics, blocks, scaler=scaler)


# --- training ---------------------------------------------------------------

#: Cells of the feature vectors in one task of a fit.
CELLS_PER_TASK = 4_000_000


def by_cells(rows: DataFrame, features: str = "features", per_task: int = CELLS_PER_TASK) -> DataFrame:
    """The same rows in as many parts as their vectors have cells for.

    A fit passes over its rows hundreds of times; parts that hold next to nothing cost more
    to start than to compute. A dense vector counts all its values. Parts are put together, not
    shuffled, so there are never more than before.
    """
    cells = rows.agg(F.sum(F.size(F.unwrap_udt(features)["values"])).alias("n")).first()["n"] or 0
    return rows.coalesce(max(1, -(-cells // per_task)))


def train_lr(
    train: DataFrame, c: float = 1.0, penalty: str = "l2", max_iter: int = 4000, label: str = "label", features: str = "features"
) -> LogisticRegressionModel:
    """Logistic regression with balanced class weights.

    The objective is scaled by the row count, so the strength is 1 / (C n).
    """
    weighted = by_cells(sampling.class_weights(train, label, "_weight"), features)
    n = train.count()
    return LogisticRegression(
        featuresCol=features,
        labelCol=label,
        weightCol="_weight",
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
        regParam=1.0 / (c * max(n, 1)),
        standardization=False,
        maxIter=max_iter,
    ).fit(weighted)


def train_rf(
    train: DataFrame, config: ForestConfig = FOREST_DEFAULT, label: str = "label", features: str = "features"
) -> Forest:
    """Random forest with balanced class weights."""
    return fit_forest(sampling.class_weights(train, label, "_weight"), config, label, features, "_weight")


def with_score(model, df: DataFrame, out: str = "score") -> DataFrame:
    """Positive-class probability as a column."""
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(
        "rawPrediction", "probability", "prediction"
    )


def calibrate(scored: DataFrame, label: str = "label", score: str = "score") -> IsotonicRegressionModel:
    """Isotonic map fitted on held-out scores, one weighted point per score."""
    points = scored.groupBy(F.col(score).alias("_x")).agg(
        F.avg(F.col(label).cast("double")).alias("_y"), F.count(F.lit(1)).cast("double").alias("_w")
    )
    return IsotonicRegression(featuresCol="_x", labelCol="_y", weightCol="_w").fit(points)


def apply_calibration(model: IsotonicRegressionModel, df: DataFrame, score: str = "score", out: str = "calibrated") -> DataFrame:
    return (
        model.setFeaturesCol(score).setPredictionCol(out).transform(df)
    )


def tune_lr(df: DataFrame, id_col: str, grid: LogRegGrid = GRID_DEFAULT, label: str = "label", at_once: int = 8) -> DataFrame:
    """Grid search over repeated stratified folds.

    One row per (C, penalty) with mean and population deviation of AUC and AP
    over the folds, best first. The folded rows are written once. Labels of 0 and 1 are
    fitted by ``logistic.fit_all``, all settings and folds in the same passes over the rows; others
    by a fit of their own each, ``at_once`` of which are submitted together.
    """
    if df.where(F.coalesce(F.col(label).isin(0, 1), F.lit(False)) == F.lit(False)).isEmpty() and not df.isEmpty():
        scored = _scored_together(df, id_col, grid, label)
    else:
        scored = _scored_each(df, id_col, grid, label, at_once)
    per_fold = evaluate.measure(scored, label, "score", ["c", "penalty", "repeat", "fold"])
    return rank_configs(
        per_fold.groupBy("c", "penalty").agg(
            F.avg("auc").alias("auc_mean"),
            F.stddev_pop("auc").alias("auc_std"),
            F.avg("ap").alias("ap_mean"),
            F.stddev_pop("ap").alias("ap_std"),
        )
    )


def _scored_together(df: DataFrame, id_col: str, grid: LogRegGrid, label: str) -> DataFrame:
    rows = sampling.fold_columns(df.select(id_col, label, "features"), id_col, label, grid.folds, grid.repeats, grid.seed)
    rows = materialize(rows, "folded")
    packed = materialize(logistic.pack_folded(rows, label, [f"fold_{r}" for r in range(grid.repeats)]), "folds")
    width = df.agg(F.max(cells_of("features")[2]).alias("n")).first()["n"]
    fits = [logistic.Fit(*s) for s in product(grid.cs, grid.penalties, range(grid.repeats), range(grid.folds))]
    points = logistic.fit_all(packed, width, fits, grid.max_iter)
    return materialize(logistic.held_out_scores(packed, points, fits, label), "fold-scores")


def _scored_each(df: DataFrame, id_col: str, grid: LogRegGrid, label: str, at_once: int) -> DataFrame:
    folded = materialize(
        sampling.folds(df.select(id_col, label, "features"), id_col, label, grid.folds, grid.repeats, grid.seed),
        "folds",
    )

    def held_out(setting: tuple[float, str, int, int]) -> DataFrame:
        c, penalty, r, f = setting
        model = train_lr(folded.where((F.col("repeat") == r) & (F.col("fold") != f)), c, penalty, grid.max_iter, label)
        return with_score(model, folded.where((F.col("repeat") == r) & (F.col("fold") == f))).select(
            F.lit(float(c)).alias("c"), F.lit(penalty).alias("penalty"), "repeat", "fold", label, "score"
        )

    settings = list(product(grid.cs, grid.penalties, range(grid.repeats), range(grid.folds)))
    with ThreadPoolExecutor(at_once) as together:
        return materialize(reduce(DataFrame.unionByName, together.map(held_out, settings)), "fold-scores")


def rank_configs(df: DataFrame, first: str = "auc_mean", second: str = "ap_mean") -> DataFrame:
    return df.orderBy(F.desc(first), F.desc(second))


@dataclass(frozen=True)
class ScoringBundle:
    """Everything batch scoring needs."""

    model: LogisticRegressionModel
    calibration: IsotonicRegressionModel
    threshold: float
    scaler: feat.Scaler | None = None


def fit_calibrated(df: DataFrame, id_col: str, c: float = 3.0, penalty: str = "l2", seed: int = 42, label: str = "label", max_iter: int = 4000, scaler: feat.Scaler | None = None) -> tuple[ScoringBundle, DataFrame]:
    """Train, calibrate and pick the threshold on a 60/20/20 split.

    Returns the bundle and the calibrated test rows. The scaler that the features
    were made with goes into the bundle.
    """
    split = materialize(
        sampling.stratified_split(df, id_col, label, {"train": 0.6, "calibration": 0.2, "test": 0.2}, seed),
        "split",
    )
    model = train_lr(split.where("split = 'train'"), c, penalty, max_iter, label)
    cal = with_score(model, split.where("split = 'calibration'"))
    iso = calibrate(cal, label)
    best = evaluate.best_threshold(apply_calibration(iso, cal), label, "calibrated").first()
    threshold = float(best["threshold"]) if best else 0.5
    bundle = ScoringBundle(model, iso, threshold, scaler)
    return bundle, score(split.where("split = 'test'"), bundle)


def score(df: DataFrame, bundle: ScoringBundle) -> DataFrame:
    """Probability, calibrated probability and decision for every row."""
    scored = apply_calibration(bundle.calibration, with_score(bundle.model, df))
    return scored.withColumn("pred", (F.col("calibrated") >= bundle.threshold).cast("int"))


def ablation(
    labelled: DataFrame,
    vectors: DataFrame,
    id_col: str,
    n_terms: int,
    n_topics: int,
    setups: dict[str, FeatureBlocks] | None = None,
    text: str = "text_all",
    seed: int = 42,
    max_iter: int = 4000,
    forest: ForestConfig | None = None,
) -> DataFrame:
    """AUC and AP per subset of feature blocks on one 80/20 split.

    Logistic regression, or a random forest when settings for one are given.
    """
    if setups is None:
        setups = {
            "tfidf_only": replace(BLOCKS_DEFAULT, topics=False),
            "tfidf_nmf": BLOCKS_DEFAULT,
            "nmf_only": replace(BLOCKS_DEFAULT, tfidf=False),
        }
    runs = {}
    for name, blocks in setups.items():
        data = build_features(labelled, vectors, id_col, n_terms, n_topics, blocks, text)
        runs[name] = _holdout(data, id_col, seed, max_iter, forest)
    return rank_configs(topic_ops.compare_configs(runs, "setup"), "auc", "ap")


def _holdout(data: DataFrame, id_col: str, seed: int, max_iter: int, forest: ForestConfig | None, train_share: float = 0.8) -> DataFrame:
    split = materialize(
        sampling.stratified_split(
            data.select(id_col, "label", "features"), id_col, "label",
            {"train": train_share, "test": 1.0 - train_share}, seed,
        ),
        "holdout",
    )
    train = split.where("split = 'train'")
    model = train_rf(train, forest) if forest else train_lr(train, max_iter=max_iter)
    return evaluate.measure(with_score(model, split.where("split = 'test'")))


def compare_sources(sets: dict[str, DataFrame], id_col: str, forest: ForestConfig = FOREST_DEFAULT, seed: int = 42) -> DataFrame:
    """Train per label set; rows, positive rate, AUC, AP and threshold of each.

    Every set holds (id, label, features).
    """
    runs = {}
    for name, df in sets.items():
        split = materialize(
            sampling.stratified_split(df, id_col, "label", {"train": 0.8, "test": 0.2}, seed), f"source-{name}"
        )
        model = train_rf(split.where("split = 'train'"), forest)
        scored = materialize(with_score(model, split.where("split = 'test'")).drop("features"), f"scored-{name}")
        totals = split.agg(
            F.struct(F.count(F.lit(1)).alias("n"), F.avg(F.col("label").cast("double")).alias("rate")).alias("t")
        ).scalar()
        best = evaluate.best_threshold(scored).select("threshold").scalar()
        runs[name] = evaluate.measure(scored).withColumn("_t", totals).select(
            F.col("_t.n").alias("n"), F.col("_t.rate").alias("pos_rate"), "auc", "ap", best.alias("threshold")
        )
    return rank_configs(topic_ops.compare_configs(runs, "source"), "auc", "ap")


def final_model(df: DataFrame, forest: ForestConfig = FOREST_DEFAULT, threshold: float = 0.5) -> tuple[Forest, DataFrame]:
    """Train on all rows; the model and its metadata as (section, metric, value)."""
    model = train_rf(df, forest)
    row = df.agg(F.count(F.lit(1)).alias("n_samples"), F.sum("label").alias("n_positive"))
    cells = [F.struct(F.lit("data").alias("section"), F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in row.columns]
    fixed = {"n_features": model.numFeatures, "trees": forest.trees, "max_depth": forest.max_depth, "threshold": threshold}
    cells += [
        F.struct(F.lit("model").alias("section"), F.lit(k).alias("metric"), F.lit(str(v)).alias("value"))
        for k, v in fixed.items()
    ]
    return model, row.select(F.inline(F.array(*cells)))


def importance_share(model: Forest, spark, n_meta: int = 3) -> DataFrame:
    """Importance of the last ``n_meta`` features against all before them."""
    vec = model.featureImportances
    rows = [(int(i), float(v)) for i, v in zip(vec.indices, vec.values)]
    table = spark.createDataFrame(rows, "feature int, importance double")
    block = F.when(F.col("feature") >= model.numFeatures - n_meta, "meta").otherwise("text")
    return table.groupBy(block.alias("block")).agg(F.sum("importance").alias("share"))


def learning_curve(df: DataFrame, id_col: str, shares: tuple[float, ...] = (0.3, 0.5, 0.7, 0.9), seed: int = 42, max_iter: int = 4000) -> DataFrame:
    """Test measures of the model trained on growing parts of the data; the parts are fitted side by side."""
    with ThreadPoolExecutor(max(1, len(shares))) as together:
        runs = dict(zip([f"{s:g}" for s in shares], together.map(lambda s: _holdout(df, id_col, seed, max_iter, None, s), shares)))
    return topic_ops.compare_configs(runs, "train_share")


def coefficient_table(model: LogisticRegressionModel, vocab: DataFrame) -> DataFrame:
    """(term, term_id, coef) for the vocabulary part of the features."""
    spark = vocab.sparkSession
    coefs = spark.createDataFrame(
        [(i, float(x)) for i, x in enumerate(model.coefficients.toArray())], "term_id int, coef double"
    )
    return vocab.select("term", "term_id").join(coefs, "term_id")


def contributions(weights: DataFrame, coefs: DataFrame, id_col: str, n: int = 8) -> DataFrame:
    """Largest positive and negative weight-times-coefficient terms per row.

    ``weights`` are TF-IDF rows (id, term, term_id, weight); the coefficient
    table is as large as the vocabulary, which is bounded.
    """
    scored = weights.join(F.broadcast(coefs.select("term_id", "coef")), "term_id").withColumn(
        "contribution", F.col("weight") * F.col("coef")
    ).where(F.col("contribution") != 0)
    side = F.when(F.col("contribution") > 0, "positive").otherwise("negative")
    best = W.partitionBy(id_col, "side").orderBy(F.abs("contribution").desc(), F.col("term"))
    return (
        scored.withColumn("side", side)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n)
        .select(id_col, "side", "rank", "term", "contribution")
    )
