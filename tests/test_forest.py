"""The forest's counts, splits and votes against plain loops and Spark's own classifier."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from threadloom.config import ForestConfig
from threadloom.operators import evaluate as ev, forest as ft, models, sampling

WIDTH = 9000
SCHEMA = StructType([StructField("doc_id", LongType()), StructField("label", IntegerType()), StructField("features", VectorUDT())])


def ends_by_loop(values, mass, total):
    pairs = dict(zip(values, mass))
    if total - sum(mass) > 1e-9 * total:
        pairs[0.0] = total - sum(mass)
    pairs = sorted(pairs.items())
    if len(pairs) - 1 < ft.BINS:
        return [(a[0] + b[0]) / 2 for a, b in zip(pairs, pairs[1:])]
    out, upto, target = [], pairs[0][1], total / ft.BINS
    for a, b in zip(pairs, pairs[1:]):
        if abs(upto - target) < abs(upto + b[1] - target):
            out.append((a[0] + b[0]) / 2)
            target += total / ft.BINS
        upto += b[1]
    return out


def test_interval_ends_are_those_of_a_scan():
    rng = np.random.default_rng(1)
    for n, zeros in ((0, 5), (1, 0), (3, 9), (31, 0), (31, 1), (32, 7), (90, 0), (90, 400), (200, 3.5)):
        values = np.unique(np.round(rng.normal(0.3, 1, n), 3))
        mass = rng.integers(1, 9, len(values)).astype(float)
        got = ft.interval_ends(values, mass, mass.sum() + zeros)
        assert got.tolist() == pytest.approx(ends_by_loop(values, mass, mass.sum() + zeros)) and len(got) < ft.BINS


def test_best_splits_are_those_of_a_loop():
    rng = np.random.default_rng(2)
    nodes, drawn, weights, least = 6, 3, np.array([0.6, 2.5]), 2
    cells = [(i, j, v, y, int(rng.integers(1, 4))) for i in range(nodes - 1) for j in range(drawn) for v in (-7, -2, 1, 4, 31) for y in (0, 1) if rng.random() < 0.6]
    totals = np.zeros((nodes, 2))
    for i, j, _, y, n in cells:
        totals[i, y] = max(totals[i, y], sum(c[4] for c in cells if c[:2] == (i, j) and c[3] == y) + 2)
    keys = np.array([(((i * drawn + j) * 2 + (v > 0)) * ft.BINS + ft.BINS - 1 - abs(v)) * 2 + y for i, j, v, y, _ in cells])
    order = rng.permutation(len(cells))
    got = {n: rest for n, *rest in zip(*ft.best_splits(keys[order], np.array([c[4] for c in cells])[order], totals, weights, drawn, least))}

    def impurity(c):
        return 1 - sum((x / (c * weights).sum()) ** 2 for x in c * weights)

    for i in range(nodes):
        best, which = 0.0, None
        for j in range(drawn):
            for cut in range(-31, 31):
                left = totals[i] if cut >= 0 else np.zeros(2)
                for _, _, v, y, n in (c for c in cells if c[:2] == (i, j)):
                    if cut < 0 and v <= cut:
                        left = left + np.eye(2)[y] * n
                    elif cut >= 0 and v > cut:
                        left = left - np.eye(2)[y] * n
                right = totals[i] - left
                if min(left.sum(), right.sum()) >= least:
                    share = (left * weights).sum() / (totals[i] * weights).sum()
                    gain = impurity(totals[i]) - share * impurity(left) - (1 - share) * impurity(right)
                    if gain > best + ft.EPS:
                        best, which = gain, (j, cut)
                    if i in got and (j, cut) == (got[i][0], got[i][1]):
                        assert got[i][2] == pytest.approx(gain) and got[i][3].tolist() == left.tolist()
        assert (i in got) == (best > ft.EPS) and (best == 0 or got[i][2] == pytest.approx(best))
        assert i not in got or tuple(got[i][:2]) == which, "the feature drawn first, its lowest cut"


def test_drawn_features_differ():
    for n, width, drawn in ((50, 3, 2), (50, 9, 3), (20, 70_000, 265), (4, 1, 1)):
        got = ft.draw_features(np.random.default_rng(0), n, width, drawn)
        assert got.shape == (n, drawn) and got.max() < width and all(len(set(r)) == drawn for r in got.tolist())


def rows_of(n):
    rng = np.random.default_rng(n)
    out = []
    for i in range(n):
        y = int(rng.random() < 0.25)
        cells = {int(c): float(v) for c, v in zip(rng.integers(40, WIDTH - 1, 20), rng.random(20))}
        cells |= {int(c): float(rng.random() + 0.2) for c in range(40) if rng.random() < (0.5 if y and c < 25 else 0.15)}
        cells[WIDTH - 1] = float(rng.normal() - y)
        out.append((i, y, Vectors.sparse(WIDTH, cells)))
    return out


@pytest.fixture(scope="module")
def wide(spark):
    # more rows than are laid out at once
    return models.materialize(spark.createDataFrame(rows_of(1100), SCHEMA), "wide"), models.materialize(spark.createDataFrame(rows_of(700), SCHEMA), "held")


@pytest.fixture(scope="module")
def grown(wide):
    return models.train_rf(wide[0], ForestConfig(trees=60))


def test_forest_scores_like_the_library(wide, grown):
    train, held = wide
    assert train.count() > ft.LAID_OUT // WIDTH
    theirs = RandomForestClassifier(
        weightCol="_w", numTrees=60, maxDepth=30, minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=42
    ).fit(sampling.class_weights(train, "label", "_w"))
    auc = [ev.measure(models.with_score(m, held)).first()["auc"] for m in (grown, theirs)]
    assert auc[0] > 0.8 and auc[0] == pytest.approx(auc[1], abs=0.04)
    todo, nodes = list(range(60)), 0
    while todo:
        k = todo.pop()
        nodes += 1
        todo += [grown.left[k], grown.left[k] + 1] if grown.left[k] >= 0 else []
    assert nodes == pytest.approx(theirs.totalNumNodes, rel=0.15)
    mine, other = (m.featureImportances.toArray() for m in (grown, theirs))
    assert mine.sum() == pytest.approx(1.0) and mine[:40].sum() == pytest.approx(other[:40].sum(), abs=0.08)


def test_nodes_hold_the_rows_that_reach_them(wide, grown):
    """Children share out their parent's rows, and votes are those of walking each tree by values."""
    inner = np.flatnonzero(grown.left >= 0)
    child = grown.left[inner]
    assert grown.mass[child] + grown.mass[child + 1] == pytest.approx(grown.mass[inner])
    assert (grown.tree[child] == grown.tree[inner]).all() and (grown.gain[inner] > 0).all()
    got = grown.transform(wide[1]).select("features", vector_to_array("probability").alias("p"), vector_to_array("rawPrediction").alias("raw"), "prediction")
    for r in got.limit(40).collect():
        x, votes = r["features"].toArray(), np.zeros(2)
        for k in range(60):
            while grown.left[k] >= 0:
                f = grown.feature[k]
                k = grown.left[k] + int(x[f] > grown.binning.ends[f][grown.cut[k] + grown.binning.zero[f]])
            votes += grown.mass[k] / grown.mass[k].sum()
        assert r["raw"] == pytest.approx(votes) and r["p"] == pytest.approx(votes / 60) and r["prediction"] == votes.argmax()


def test_a_level_of_all_trees_is_one_pass(spark, wide, monkeypatch):
    passes, level = [], ft._level_splits
    monkeypatch.setattr(ft, "_level_splits", lambda *a: passes.append(len(a[1][5])) or level(*a))
    models.train_rf(wide[0], ForestConfig(trees=120, max_depth=4))
    assert len(passes) == 4 and passes[0] == 120


def test_small_forest_does_not_depend_on_the_order_of_rows(wide):
    some = wide[0].limit(120).cache()
    config = ForestConfig(trees=9, max_depth=5)
    one, two = models.train_rf(some, config), models.train_rf(some.orderBy(F.rand(3)).repartition(7), config)
    assert one.left.tolist() == two.left.tolist() and one.feature.tolist() == two.feature.tolist()


def test_dense_vectors_and_bad_labels(spark):
    dense = spark.createDataFrame([(i, int(i % 4 == 0), Vectors.dense([float(i % 4), float(i % 3)])) for i in range(80)], SCHEMA)
    assert ev.measure(models.with_score(models.train_rf(dense, ForestConfig(trees=15, max_depth=4)), dense)).first()["auc"] > 0.95
    with pytest.raises(ValueError, match="labels"):
        models.train_rf(dense.withColumn("label", F.col("label") - 1), ForestConfig(trees=2))
    with pytest.raises(ValueError, match="no rows"):
        models.train_rf(dense.limit(0), ForestConfig(trees=2))
