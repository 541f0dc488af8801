"""Isotonic calibration, exact quantiles and budgeted samples on small tables."""

import random
import statistics

import numpy as np
import pytest

from threadloom.operators import calibration, profile, sampling as sp


def max_min(points):
    xs = sorted(points)
    out = {}
    for i, x in enumerate(xs):
        out[x] = max(
            min(sum(points[y][0] for y in xs[a : b + 1]) / sum(points[y][1] for y in xs[a : b + 1]) for b in range(i, len(xs)))
            for a in range(i + 1)
        )
    return out


@pytest.mark.parametrize("seed,per_task", [(1, 200_000), (2, 7)])
def test_isotonic_equals_the_max_min_formula(spark, seed, per_task):
    rnd = random.Random(seed)
    rows = [(float(rnd.randrange(60)), rnd.random() < 0.5 + 0.3 * (i % 2)) for i in range(300)] + [(None, True), (3.0, None)]
    points = {}
    for x, y in rows:
        if x is not None and y is not None:
            total, n = points.get(x, (0, 0))
            points[x] = (total + y, n + 1)
    df = spark.createDataFrame([(x, None if y is None else int(y)) for x, y in rows], "s double, y int")
    got = {r["score"]: (r["weight"], r["calibrated"]) for r in calibration.isotonic_fit(df, "s", "y", per_task).collect()}
    want = max_min(points)
    assert got.keys() == want.keys()
    assert all(got[x][0] == points[x][1] and abs(got[x][1] - want[x]) < 1e-12 for x in want)
    assert calibration.isotonic_fit(df.limit(0), "s", "y").count() == 0


def test_quantiles_are_exact(spark):
    rnd = random.Random(5)
    groups = {"a": [rnd.lognormvariate(0, 9) for _ in range(200)], "b": [1.0] * 50 + [2.0], "c": [-3.5], "d": [float(i % 7) for i in range(40)], None: [1.0, 4.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None), ("c", float("nan"))]
    per_value = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").count().withColumnRenamed("count", "_n")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r["g"]: (r["n"], r["_q"]) for r in profile.exact_quantiles(per_value, "g", "v", probs).collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        assert got[g][0] == len(vs) and np.allclose(got[g][1], np.quantile(vs, probs), rtol=1e-12)
    assert got["a"][1][3] == pytest.approx(statistics.median(groups["a"]))


def test_a_sample_keeps_few_rows_before_the_shuffle(spark):
    df = spark.range(5000, numPartitions=4).selectExpr("id", "case when id % 3 = 0 then 'x' else 'y' end AS g")
    drawn = sp.quota_sample(df, "id", "g", 20, 2)
    assert drawn.groupBy("g").count().count() == 2 and drawn.count() in (20, 21)
    assert "WindowGroupLimit" in drawn._jdf.queryExecution().executedPlan().toString()
