"""Queries that train models; rows are checked, values depend on the fit."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from threadloom.config import FOREST_DEFAULT, GRID_DEFAULT, NMF_DEFAULT, VOCAB_DEFAULT
from threadloom.functions import tokens as tk
from threadloom.operators import evaluate as ev, features as feat, labels as lb, models
from threadloom.plans.registry import query
from threadloom.session import discard, materialize, scratch_path
from threadloom.sources import writers

#: The topic fit of the folder that was read last, by application and folder.
_FITTED: dict[tuple[str, str], tuple] = {}


def training_rows(t):
    """Labelled documents with vectors of a topic model over all documents.

    The queries below start from the same fit at the default settings; the first one of
    an application makes it, its tables stay in the shared folder and the others read them.
    The labelled documents carry what the features take from their texts, not the texts.
    """
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _FITTED:
        docs = t.texts().select("doc_id", "text", tk.simple_tokens("text").alias("toks"))
        docs = materialize(docs.select("doc_id", "toks", *feat.text_facts("text", F.col("toks"))), "model-docs")
        labels = t.read("labels").select("doc_id", F.col("toxic").alias("label"), "quality")
        labelled = materialize(docs.drop("toks").join(labels, "doc_id"), "labelled")
        model = models.fit_topics(docs, "doc_id", "toks")
        discard(docs)
        known = models.joined_cells(model, labels, "doc_id")
        vectors = materialize(models.document_vectors(labelled, "doc_id", "toks", model, VOCAB_DEFAULT, NMF_DEFAULT, known=known), "vectors")
        _FITTED.clear()
        _FITTED[key] = labelled, vectors, model
    return _FITTED[key]


def feature_rows(t):
    labelled, vectors, model = training_rows(t)
    scaler = feat.fit_scaler(feat.meta_features(labelled))
    rows = models.build_features(labelled, vectors, "doc_id", model.n_terms, model.k, scaler=scaler)
    return materialize(rows.select("doc_id", "label", "quality", "features"), "features"), model


def with_bundle(t):
    """What batch scoring starts from: labelled rows, their vectors, the model and a fitted bundle."""
    labelled, vectors, model = training_rows(t)
    scaler = feat.fit_scaler(feat.meta_features(labelled))
    rows = materialize(models.build_features(labelled, vectors, "doc_id", model.n_terms, model.k, scaler=scaler), "features")
    bundle, test = models.fit_calibrated(rows, "doc_id", scaler=scaler)
    return labelled, vectors, model, bundle, test


def r6(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, 6))
    return df


@query("feature_vectors")
def feature_vectors(t):
    rows, _ = feature_rows(t)
    dense = vector_to_array("features")
    return rows.select(
        "doc_id", "label", F.size(dense).alias("width"), F.size(F.filter(dense, lambda x: x != 0)).alias("filled")
    )


@query("train_lr")
def train_lr(t):
    rows, _ = feature_rows(t)
    return r6(ev.measure(models.with_score(models.train_lr(rows, 3.0), rows)), "auc", "ap")


@query("train_rf")
def train_rf(t):
    rows, _ = feature_rows(t)
    return r6(ev.measure(models.with_score(models.train_rf(rows, FOREST_DEFAULT), rows)), "auc", "ap")


@query("tune_lr")
def tune_lr(t):
    rows, _ = feature_rows(t)
    return r6(models.tune_lr(rows, "doc_id", GRID_DEFAULT), "auc_mean", "auc_std", "ap_mean", "ap_std")


@query("calibrated_scores")
def calibrated_scores(t):
    rows, _ = feature_rows(t)
    _bundle, test = models.fit_calibrated(rows, "doc_id")
    return r6(test.select("doc_id", "label", "score", "calibrated", "pred"), "score", "calibrated")


@query("bootstrap_ci")
def bootstrap_ci(t):
    return r6(ev.bootstrap_ci(t.scored(), "doc_id", n_boot=1000), "mean", "lo", "hi")


@query("ablation")
def ablation(t):
    labelled, vectors, model = training_rows(t)
    return r6(models.ablation(labelled, vectors, "doc_id", model.n_terms, model.k), "auc", "ap")


@query("source_comparison")
def source_comparison(t):
    rows, _ = feature_rows(t)
    hand = lb.hand_labels(t.hand()).select(F.col("post_id").cast("bigint").alias("doc_id"), "label")
    ai = lb.ai_labels(t.ai()).select(F.col("post_id").cast("bigint").alias("doc_id"), "label")
    vectors = rows.select("doc_id", "features")
    sets = {"hand": vectors.join(hand, "doc_id"), "ai": vectors.join(ai, "doc_id")}
    return r6(models.compare_sources(sets, "doc_id", FOREST_DEFAULT), "pos_rate", "auc", "ap", "threshold")


@query("final_model")
def final_model(t):
    rows, _ = feature_rows(t)
    return models.final_model(rows, FOREST_DEFAULT, 0.37)[1]


@query("importance_share")
def importance_share(t):
    rows, _ = feature_rows(t)
    return r6(models.importance_share(models.train_rf(rows, FOREST_DEFAULT), t.spark), "share")


@query("learning_curve")
def learning_curve(t):
    rows, _ = feature_rows(t)
    return r6(models.learning_curve(rows, "doc_id"), "auc", "ap")


@query("contributions")
def contributions(t):
    """Strongest terms of every wrongly scored document."""
    rows, model = feature_rows(t)
    lr = models.train_lr(rows, 3.0)
    wrong = ev.errors(models.with_score(lr, rows), 0.5).select("doc_id")
    weights = feat.counted_tfidf(model.doc_cells.join(wrong, "doc_id", "left_semi"), model.vocab, "doc_id")
    return r6(models.contributions(weights, models.coefficient_table(lr, model.vocab), "doc_id"), "contribution")


@query("bundle_roundtrip")
def bundle_roundtrip(t):
    """Scores of a saved and reloaded bundle beside the original ones."""
    _labelled, _vectors, model, bundle, test = with_bundle(t)
    path = scratch_path(t.spark, "bundle")
    writers.save_bundle(bundle, t.spark, path)
    writers.save_topic_model(model, f"{path}/topics")
    again = models.score(test.select("doc_id", "label", "features"), writers.load_bundle(t.spark, path))
    loaded = writers.load_topic_model(t.spark, f"{path}/topics")
    both = test.select("doc_id", F.col("calibrated").alias("a")).join(again.select("doc_id", F.col("calibrated").alias("b")), "doc_id")
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("a") - F.col("b")) > 1e-12).alias("n_different"),
        F.lit(bool((loaded.matrix == model.matrix).all())).alias("same_topics"),
    )




@query(
    "batch_scaling",
    "SELECT 0 AS n_different, count(*) AS n FROM documents JOIN labels USING (doc_id)",
)
def batch_scaling(t):
    """Rows whose score under one loaded bundle differs between a half batch and the whole."""
    labelled, vectors, model, bundle, _ = with_bundle(t)
    path = scratch_path(t.spark, "bundle")
    writers.save_bundle(bundle, t.spark, path)
    loaded = writers.load_bundle(t.spark, path)

    def scored(part):
        rows = models.build_features(part, vectors, "doc_id", model.n_terms, model.k, scaler=loaded.scaler)
        return models.score(rows.select("doc_id", "features"), loaded).select("doc_id", "calibrated", "score")

    whole = scored(labelled)
    halves = scored(labelled.where("doc_id % 2 = 0")).unionByName(scored(labelled.where("doc_id % 2 = 1")))
    both = whole.join(halves.select("doc_id", F.col("score").alias("_s"), F.col("calibrated").alias("_c")), "doc_id")
    return both.agg(
        F.count_if((F.col("score") != F.col("_s")) | (F.col("calibrated") != F.col("_c"))).alias("n_different"), F.count(F.lit(1)).alias("n")
    )
