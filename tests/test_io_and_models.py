import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.config import ForestConfig, LogRegGrid, PullConfig
from threadloom.operators import evaluate as ev, features as feat, models
from threadloom.session import scratch_path
from threadloom.sources import readers, writers
from threadloom.streaming.incremental import label_stream


def test_csv_keeps_hard_texts(spark):
    texts = ['a "quoted", text', "two\nlines", "  padded  ", "tab\there", "ünï 😀", "back\\slash", ""]
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(texts)], "post_id string, text_all string")
    path = scratch_path(spark, "csv")
    writers.write_csv(df, path)
    got = {r["post_id"]: r["text_all"] for r in readers.read_csv(spark, path, "post_id string, text_all string").collect()}
    assert got == {str(i): x or None for i, x in enumerate(texts)}


def test_jsonl_writes_nulls(spark):
    path = scratch_path(spark, "jsonl")
    writers.write_jsonl(spark.createDataFrame([("é", None)], "a string, b string"), path)
    assert spark.read.text(path).first()[0] == '{"a":"é","b":null}'


def test_read_any(spark):
    with pytest.raises(ValueError):
        readers.read_any(spark, "x.xlsx")
    with pytest.raises(ValueError):
        readers.read_any(spark, "x.csv")


def test_missing_lexicon_is_empty(spark):
    assert readers.read_lexicon(spark, scratch_path(spark, "none")).count() == 0


def test_lexicon_file(spark):
    path = scratch_path(spark, "lex")
    lines = ["Fear\tfear\t1", "fear\tnegative\t1", "calm\tfear\t0", "", "broken line", "two\tfields", "odd\tother\t1"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = {r["word"]: sorted(r["emotions"]) for r in readers.read_lexicon(spark, path).collect()}
    assert got == {"fear": ["fear", "negative"]}


def test_config_from_dict():
    raw = {"time_range": {"months_back": 3}, "subreddits": ["a"], "comments": {"top_k": 2, "min_len": 5}, "filters": {"english_only": False}}
    got = PullConfig.from_dict(raw)
    assert (got.months_back, got.top_k, got.min_len, got.english_only, got.exclude_nsfw) == (3, 2, 5, False, True)


def test_incremental_labels(spark):
    src, out, cp = (scratch_path(spark, x) for x in ("stream-in", "stream-out", "stream-cp"))

    def label(df):
        return df.withColumn("label", F.length("text"))

    for rows in ([("p1", "a"), ("p2", "bb")], [("p2", "bb"), ("p3", "ccc"), ("p3", "ccc")]):
        spark.createDataFrame(rows, "post_id string, text string").write.mode("append").parquet(src)
        posts = spark.readStream.schema("post_id string, text string").parquet(src)
        label_stream(posts, label, out, cp).awaitTermination(120)
    got = sorted((r["post_id"], r["label"]) for r in spark.read.parquet(out).collect())
    assert got == [("p1", 1), ("p2", 2), ("p3", 3)]


@pytest.fixture(scope="module")
def planted(spark):
    """Sparse vectors whose first feature carries the label."""
    i = F.col("id")
    y = (i % 3 == 0).cast("int")
    idx = F.array(F.lit(0), F.lit(1), F.lit(2))
    val = F.array(y * 1.0 + (i * 7 % 10) / 12.0, (i % 7) / 7.0, (i % 5) / 5.0)
    return spark.range(240).select(i.alias("doc_id"), y.alias("label"), feat.sparse_vector(3, idx, val).alias("features")).cache()


def test_models_find_the_planted_signal(planted):
    for model in (models.train_lr(planted, 1.0, "l2", 50), models.train_lr(planted, 1.0, "l1", 50), models.train_rf(planted, ForestConfig(trees=8, max_depth=4))):
        assert ev.measure(models.with_score(model, planted)).first()["auc"] > 0.8


def test_small_training_rows_are_fitted_in_one_part(planted, monkeypatch):
    seen, fit = [], models.LogisticRegression.fit
    monkeypatch.setattr(models.LogisticRegression, "fit", lambda self, rows: seen.append(rows.rdd.getNumPartitions()) or fit(self, rows))
    dealt = planted.repartition(16)
    model = models.train_lr(dealt, 1.0, "l2", 20)
    assert seen == [1]
    assert model.coefficients.toArray() == pytest.approx(models.train_lr(planted, 1.0, "l2", 20).coefficients.toArray(), rel=1e-3)
    assert models.by_cells(dealt, per_task=240).rdd.getNumPartitions() == 3, "720 cells"
    assert models.by_cells(dealt.limit(0)).rdd.getNumPartitions() <= 1


def test_learning_curve_holds_every_share(planted):
    got = {r["train_share"]: r["auc"] for r in models.learning_curve(planted, "doc_id", (0.5, 0.9), max_iter=20).collect()}
    alone = {s: models._holdout(planted, "doc_id", 42, 20, None, float(s)).first()["auc"] for s in ("0.5", "0.9")}
    assert got == pytest.approx(alone)


def test_calibrated_bundle_roundtrip(spark, planted):
    scaler = {"doc_len": (1.5, 2.0), "has_url": (0.25, 1.0)}
    bundle, test = models.fit_calibrated(planted, "doc_id", max_iter=30, scaler=scaler)
    rows = test.select("calibrated", "score").collect()
    assert all(0.0 <= r["calibrated"] <= 1.0 for r in rows)
    ordered = sorted((r["score"], r["calibrated"]) for r in rows)
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(ordered, ordered[1:])), "the map never falls"
    path = scratch_path(spark, "bundle")
    writers.save_bundle(bundle, spark, path)
    assert writers.load_bundle(spark, path).scaler == scaler
    again = models.score(planted, writers.load_bundle(spark, path))
    assert again.agg(F.sum("calibrated")).first() == models.score(planted, bundle).agg(F.sum("calibrated")).first()


def test_a_fitted_scaler_does_not_look_at_the_batch(spark):
    docs = spark.createDataFrame([(i, "w " * (i + 1)) for i in range(6)], "doc_id long, text_all string")
    scaler = feat.fit_scaler(feat.meta_features(docs))
    vectors = spark.createDataFrame([], "doc_id long, indices array<int>, values array<double>, topics array<double>")

    def rows(part):
        built = models.build_features(part, vectors, "doc_id", 4, 2, scaler=scaler)
        return {r["doc_id"]: r["features"] for r in built.collect()}

    whole, half = rows(docs), rows(docs.where("doc_id < 2"))
    assert all(whole[i] == half[i] for i in half)


def test_tuning_ranks_configs(planted):
    rows = models.tune_lr(planted, "doc_id", LogRegGrid(cs=(0.001, 1.0), penalties=("l2",), folds=2, repeats=1, max_iter=20)).collect()
    assert len(rows) == 2
    assert rows[0]["auc_mean"] >= rows[1]["auc_mean"]


def test_schemas_parse(spark):
    for ddl in (schemas.POSTS, schemas.COMMENTS, schemas.HAND_LABELS, schemas.MODEL_LABELS, schemas.LEXICON, schemas.TOPIC_FEATURES, schemas.METRICS):
        assert spark.createDataFrame([], ddl).count() == 0
