"""Classifier by held-out labels, packing by its promises, the pipeline stage by stage."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from threadloom.llm import cotraining, packing
from threadloom.llm.ngram_join import near_duplicates

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", F.col("quality").cast("double").alias("good"))


def test_held_out_accuracy(spark, labelled):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    shown = labelled.where("doc_id % 3 > 0")
    scored = cotraining.classify(docs, shown).join(labelled.where("doc_id % 3 = 0"), "doc_id").collect()
    good = [r for r in scored if r["good"] == 1.0]
    bad = [r for r in scored if r["good"] == 0.0]
    assert sum(r["kept"] for r in good) >= 0.97 * len(good)
    assert sum(not r["kept"] for r in bad) >= 0.8 * len(bad)


def test_each_view_learns_from_the_other():
    """The pool teaches a view cells that its own labels never show."""
    np = cotraining.np
    rnd = np.random.default_rng(1)
    truth = rnd.integers(0, 2, 600).astype(float)
    words = [np.array([int(t) if i < 120 or i % 2 else int(t) + 2, 9]) for i, t in enumerate(truth)]
    starts = np.arange(601) * 2
    content = cotraining.Rows(starts, np.concatenate(words), np.ones(1200), np.zeros((600, 1)))
    meta = cotraining.Rows(np.arange(601), truth.astype(int), np.ones(600), np.zeros((600, 1)))
    shown, free = np.arange(120), np.arange(120, 600)
    pool = cotraining.LocalPool(content.pick(free), meta.pick(free), free % cotraining.STRATA)
    model = cotraining.co_train(content.pick(shown), meta.pick(shown), truth[shown], pool)
    assert model.content.weights[3] > model.content.weights[2]
    alone = cotraining.co_train(content.pick(shown), meta.pick(shown), truth[shown], pool, rounds=0)
    assert alone.content.weights[3] == alone.content.weights[2]


def test_the_surest_share_by_class():
    np = cotraining.np
    rnd = np.random.default_rng(3)
    scores = np.concatenate((rnd.normal(0, 6, 5000), [100.0, -100.0], np.full(300, 7.0)))
    bins = cotraining.bins_of(scores)
    for share, good_share in ((0.05, 0.5), (0.2, 0.9), (1.0, 0.5), (0.0, 0.5)):
        found = cotraining.surest(np.bincount(bins, minlength=cotraining.BINS), share, good_share)
        want = max(1, share * len(scores) * good_share)
        sure = [b for b in sorted(set(bins.tolist()), reverse=True) if (bins >= b).sum() >= want][0]
        assert (bins >= found.good).sum() == (bins >= max(sure, cotraining.bins_of(np.array([np.log(9)]))[0])).sum()
        assert not ((bins >= found.good) & (bins <= found.bad)).any()


def test_all_unlabelled_documents_take_part_in_any_order(spark, labelled):
    """Counts and sums of tasks equal plain ones over all rows; the model depends on neither order nor partitions."""
    np = cotraining.np
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.unionByName(docs.limit(5).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit("")}))
    table = cotraining.features(docs.withColumn("good", F.lit(None).cast("double")).select("doc_id", "good", "lang", "source", "n_chars", "text"))
    packed = table.toArrow().combine_chunks().to_batches()[0]
    content, meta, strata = cotraining.unpacked(packed)
    rnd = np.random.default_rng(5)
    views = {"content": cotraining.Linear(rnd.normal(0, 60, cotraining.WORD_CELLS), rnd.normal(0, 1, cotraining.RATIOS)),
             "meta": cotraining.Linear(rnd.normal(0, 2, cotraining.META_CELLS), np.zeros(1))}
    local, spread = cotraining.LocalPool(content, meta, strata), cotraining.SparkPool(table.repartition(7))
    counts = spread.histograms(views)
    assert all((counts[v] == local.histograms(views)[v]).all() and counts[v].sum() == docs.count() for v in views)
    bounds = {v: cotraining.surest(counts[v], 0.3, 0.6) for v in views}
    want, got = local.taught(views, bounds), spread.taught(views, bounds)
    assert want.keys() == got.keys() and all((want[k] == got[k]).all() for k in want)
    taught = sum(total[-1] for (view, label, _), total in got.items() if view == "content" and label == 1)
    assert taught == (cotraining.bins_of(views["meta"].score(meta)) >= bounds["meta"].good).sum()
    first, second = cotraining.fit(docs, labelled), cotraining.fit(docs.repartition(5).orderBy("text"), labelled)
    assert (first.content.weights == second.content.weights).all() and (first.meta.weights == second.meta.weights).all()
    assert first.threshold == second.threshold


def test_odd_rows_and_no_labels(spark, labelled):
    rows = [(1, None, None, None, None), (None, "text", "en", "s", 4), (2, "", "en", None, 0), (3, "x " * 50000, "fr", "s", None), (3, "x", "fr", "s", -5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({"good": F.lit("clash"), "kept": F.lit(0)})
    none = spark.createDataFrame([], "doc_id long, good double")
    assert all(r["kept"] is True and r["p_quality"] is None for r in cotraining.classify(docs, none).collect())
    full = spark.read.parquet(f"{FOLDER}/documents.parquet")
    both = full.unionByName(docs.select(full.columns))
    assert cotraining.classify(both, labelled).where("p_quality between 0 and 1").count() == full.count() + len(rows)
    assert cotraining.classify(full.limit(0), labelled).count() == 0


def check_packed(rows, sizes, capacity, info):
    used, held = {}, {}
    for r in rows:
        used.setdefault(r["bin"], []).append((r["offset"], r["size"]))
        held.setdefault(r["bin"], []).append(info[r["doc_id"]])
    for spans in used.values():
        end = 0
        for offset, size in sorted(spans):
            assert offset == end
            end += size
        assert end <= capacity
    for kept in held.values():
        for k in (0, 1):
            known = [v[k] for v in kept if v[k] is not None]
            assert len(known) == len(set(known)) or len(kept) == 1
    for doc, size in sizes.items():
        spans = sorted((r["start"], r["size"]) for r in rows if r["doc_id"] == doc)
        assert sum(s for _, s in spans) == size and [a for a, _ in spans] == [i * capacity for i in range(len(spans))]


@pytest.mark.parametrize("packer_rows", [4000, 40])
def test_packing_keeps_its_promises(spark, packer_rows):
    rnd = random.Random(2)
    sizes = {i: rnd.choice([0, 1, 5, 50, 99, 100, 101, 250, 1000]) for i in range(300)}
    info = {i: ("hot" if i % 3 == 0 else f"s{i % 17}" if i % 5 else None, i % 40 if i % 4 else None) for i in sizes}
    docs = spark.createDataFrame([(i, n, *info[i]) for i, n in sizes.items()], "doc_id long, n_tokens long, source string, cluster long")
    check_packed(packing.pack(docs.withColumns({"bin": F.lit("clash"), "piece": F.lit(0), "salt": F.lit(1)}), 100, packer_rows).collect(), sizes, 100, info)


def test_the_tightest_compatible_sequence_is_taken():
    rnd = random.Random(4)
    sequences, plain = packing.Sequences(100), []
    for _ in range(500):
        size, source, cluster = rnd.randrange(1, 100), 1 << rnd.randrange(5), rnd.choice([0, 1 << rnd.randrange(30)])
        fits = [(100 - b[0], i) for i, b in enumerate(plain) if b[0] + size <= 100 and not (b[1] & source or b[2] & cluster)]
        want = min(fits)[1] if fits else len(plain)
        if not fits:
            plain.append([0, 0, 0])
        plain[want] = [plain[want][0] + size, plain[want][1] | source, plain[want][2] | cluster]
        assert sequences.place(size, source, cluster)[0] == want


def test_packing_odd_rows(spark):
    rows = [(None, 10, None, None), (1, None, "s", 1), (2, 0, "s", 1), (3, 100, "s", 1), (4, 30, "s", 1), (4, 30, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, n_tokens long, source string, cluster long")
    got = packing.pack(docs, 100).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"]) == [(3, 100), (4, 30), (4, 30)] and len(got) == 4
    assert len({r["bin"] for r in got if r["doc_id"] == 4}) == 2
    assert packing.pack(docs.limit(0), 100).count() == 0


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert set(docs.columns) == set(corpus_pipeline.COLUMNS)
            assert docs.join(before, "doc_id", "left_anti").count() == 0
        if name == "ngram_join":
            groups = near_duplicates(before).select("component_id").distinct().count()
            assert docs.count() == groups == near_duplicates(docs).select("component_id").distinct().count()
    clean = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1")
    raw = spark.read.parquet(f"{FOLDER}/documents.parquet").join(clean, "doc_id")
    assert kept["quality_classifier"].join(clean, "doc_id").count() >= 0.98 * raw.count()
    words = kept["substring_dedup"].select(F.explode(F.split("text", r"[\x20\x09-\x0D]+")).alias("w")).where("w <> ''").count()
    assert kept["best_fit_packing"].agg(F.sum("size")).first()[0] == words


def test_stages_on_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, None, None, None, None), (None, "null id text " * 10, "en", "s", 1), (2, "", "en", "s", 0),
            (3, "word " * 200_000, "en", "s", 10), (3, "word " * 200_000, "en", "s", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("kept", F.lit("clash"))
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).collect()
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_one_of_each_group_stays_without_ids(spark):
    """Null and repeated ids: the first by id, then by text; documents without words are no group."""
    base = [f"w{i}" for i in range(60)]
    near = " ".join([*base[:-1], "other"])
    alone = "a text of its own that nothing else in the table holds"
    rows = [(None, " ".join(base)), (None, near), (None, alone), (4, near), (4, " ".join(base).upper()), (9, near), (9, near), (5, ""), (5, ""), (6, ""),
            (7, "an id used"), (7, "for two different texts")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)["ngram_join"]
    got = sorted(((r["doc_id"], r["text"]) for r in stage(spark, docs, FOLDER).collect()), key=str)
    group = [g for g in got if g[1].lower() in (near, " ".join(base))]
    assert len(group) == 1 and group[0][0] == 4
    assert sorted((g for g in got if g not in group), key=str) == sorted(
        [(None, alone), (5, ""), (6, ""), (7, "an id used"), (7, "for two different texts")], key=str)
