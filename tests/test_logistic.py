"""Regressions fitted side by side beside single fits of Spark's classifier."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.config import GRID_DEFAULT, LogRegGrid
from threadloom.operators import evaluate as ev, features as feat, logistic, models, sampling
from threadloom.plans import catalog_models
from threadloom.session import materialize


@pytest.fixture(scope="module")
def folded(spark):
    """Noisy labels over four features of unlike scale, one of them mostly zero, in two folds."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(5, 2, 300), rng.random(300) * 0.01, rng.integers(0, 2, 300), np.where(rng.random(300) < 0.05, 1.0, 0.0)])
    y = (0.4 * (x[:, 0] - 5) + x[:, 2] + 3 * x[:, 3] + rng.normal(0, 1, 300) > 1.2).astype(int)
    rows = [(int(i), int(a), [float(v) for v in b]) for i, (a, b) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "doc_id long, label int, v array<double>")
    dense = df.select("doc_id", "label", feat.sparse_vector(4, F.array(*map(F.lit, range(4))), F.col("v")).alias("features"))
    return materialize(sampling.fold_columns(dense, "doc_id", "label", 2, 2, 7), "folded")


def test_fits_side_by_side_are_those_of_single_fits(folded, monkeypatch):
    monkeypatch.setattr(logistic, "PACKED", 100)
    packed = materialize(logistic.pack_folded(folded, "label", ["fold_0", "fold_1"]), "packed")
    fits = [logistic.Fit(c, p, r, f) for c, p, r, f in [(0.05, "l2", 0, 0), (3.0, "l2", 1, 1), (0.05, "l1", 0, 1), (3.0, "l1", 1, 0)]]
    for direct in (logistic.DIRECT, 0):
        monkeypatch.setattr(logistic, "DIRECT", direct)
        points = logistic.fit_all(packed, 4, fits, 4000, 1e-9)
        for fit, point in zip(fits, points):
            one = models.train_lr(folded.where(F.col(f"fold_{fit.repeat}") != fit.fold), fit.c, fit.penalty)
            assert point[:-1] == pytest.approx(one.coefficients.toArray(), rel=0.02, abs=0.01)
            assert point[-1] == pytest.approx(one.intercept, rel=0.02, abs=0.02)
    got = logistic.held_out_scores(packed, points, fits).where("c = 3 and penalty = 'l1'")
    one = models.with_score(models.train_lr(folded.where("fold_1 <> 0"), 3.0, "l1"), folded.where("fold_1 = 0"))
    assert got.count() == one.count()
    assert ev.measure(got).first()["auc"] == pytest.approx(ev.measure(one).first()["auc"], abs=2e-3)


def test_rows_of_one_class_have_no_coefficients(folded):
    packed = materialize(logistic.pack_folded(folded.where("label = 1 or fold_0 = 0"), "label", ["fold_0"]), "packed")
    first, second = logistic.fit_all(packed, 4, [logistic.Fit(1.0, "l2", 0, 0), logistic.Fit(1.0, "l2", 0, 1)], 50)
    assert first.tolist() == [0, 0, 0, 0, np.inf] and np.isfinite(second).all()


def test_fold_columns_are_the_folds(folded):
    rows = folded.select("doc_id", "label")
    long = {(r["doc_id"], r["repeat"]): r["fold"] for r in sampling.folds(rows, "doc_id", "label", 5, 2, 42).collect()}
    wide = sampling.fold_columns(rows, "doc_id", "label", 5, 2, 42).collect()
    assert long == {(r["doc_id"], k): r[f"fold_{k}"] for r in wide for k in (0, 1)}


def test_tuning_in_common_passes_ranks_as_single_fits_do(folded):
    grid = LogRegGrid(cs=(0.01, 1.0), folds=3, repeats=2)
    got = {(r["c"], r["penalty"]): r for r in models.tune_lr(folded.select("doc_id", "label", "features"), "doc_id", grid).collect()}
    each = ev.measure(models._scored_each(folded, "doc_id", grid, "label", 4), "label", "score", ["c", "penalty", "repeat", "fold"])
    for r in each.groupBy("c", "penalty").agg(F.avg("auc").alias("auc"), F.avg("ap").alias("ap")).collect():
        assert got[r["c"], r["penalty"]]["auc_mean"] == pytest.approx(r["auc"], abs=5e-3)
        assert got[r["c"], r["penalty"]]["ap_mean"] == pytest.approx(r["ap"], abs=5e-3)


def test_the_query_tries_the_whole_grid(monkeypatch):
    grids = []
    monkeypatch.setattr(catalog_models, "feature_rows", lambda t: (None, None))
    monkeypatch.setattr(catalog_models, "r6", lambda df, *c: df)
    monkeypatch.setattr(models, "tune_lr", lambda rows, id_col, grid, *a: grids.append(grid))
    catalog_models.tune_lr(None)
    assert grids == [GRID_DEFAULT] and (GRID_DEFAULT.repeats, GRID_DEFAULT.max_iter) == (2, 4000)
