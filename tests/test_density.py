"""Density clustering against a plain version on the full distance matrix."""

import numpy as np
import pytest

from threadloom.operators import density


def plain_clusters(points: dict[int, list[float]], least: int, samples: int):
    """Labels and probabilities from single linkage on mutual reachability, cut by stability."""
    ids = sorted(points)
    x = np.array([points[i] for i in ids])
    n = len(ids)
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(far, axis=1)[:, min(samples, n - 1)]
    reach = np.maximum(far, np.maximum(core[:, None], core[None]))
    edges = sorted((reach[i, j], i, j) for i in range(n) for j in range(i + 1, n))
    leader = list(range(n))

    def find(i):
        while leader[i] != i:
            i = leader[i]
        return i

    tree, rows, node = {}, {i: [i] for i in range(n)}, n
    at = {i: i for i in range(n)}
    for w, i, j in edges:
        a, b = find(i), find(j)
        if a != b:
            leader[b] = a
            tree[node] = (at[a], at[b], 1 / max(w, density.LEAST_DISTANCE))
            rows[node] = rows[at[a]] + rows[at[b]]
            at[a] = node
            node += 1
    found = {}

    def walk(top, born):
        """One cluster from the top down: what leaves it and when, and the two clusters it ends in."""
        leaves, t = {}, top
        while True:
            left, right, d = tree[t]
            big = [c for c in (left, right) if len(rows[c]) >= least]
            for c in (left, right):
                if c not in big:
                    leaves.update({r: d for r in rows[c]})
            if len(big) == 1:
                t = big[0]
                continue
            kids = [walk(c, d) for c in big]
            stability = sum(d2 - born for d2 in leaves.values()) + sum((d - born) * len(rows[c]) for c in big)
            peak = max([*leaves.values(), d])
            below = sum(k["best"] for k in kids)
            chosen = not kids or stability >= below
            return {"rows": rows[top], "leaves": leaves, "kids": kids, "peak": peak, "chosen": chosen, "best": stability if chosen else below}

    def keep(c, root=False):
        if c["chosen"] and not root:
            def label(k):
                for r, d in k["leaves"].items():
                    found[r] = (min(c["rows"]), min(d, c["peak"]) / c["peak"])
                for kid in k["kids"]:
                    label(kid)
            label(c)
        else:
            for kid in c["kids"]:
                keep(kid)

    if n >= least and n > 1:
        keep(walk(node - 1, 0.0), root=True)
    return {ids[i]: (ids[found[i][0]], found[i][1]) if i in found else (-1, 0.0) for i in range(n)}


def blobs(seed: int) -> dict[int, list[float]]:
    rnd = np.random.default_rng(seed)
    parts = [rnd.normal(c, s, (m, 3)) for c, s, m in ((0, 0.3, 40), (3, 0.5, 30), (3.9, 0.2, 25), (-4, 1.5, 30))] + [rnd.uniform(-8, 8, (25, 3))]
    x = np.vstack(parts)
    return {int(i): [float(v) for v in p] for i, p in zip(rnd.permutation(len(x)) + 10, x)}


@pytest.mark.parametrize("seed,least,samples,block,per_pass", [(1, 8, 4, 2000, 500_000), (2, 6, 3, 20, 40)])
def test_clusters_equal_a_plain_version(spark, seed, least, samples, block, per_pass):
    points = blobs(seed)
    df = spark.createDataFrame(list(points.items()), "vec_id long, embedding array<double>")
    got = density.cluster_density(df, "vec_id", "embedding", least, samples, neighbours=len(points) - 1, block=block, per_pass=per_pass).collect()
    want = plain_clusters(points, least, samples)
    assert len({t for t, _ in want.values()}) > 2 and any(t == -1 for t, _ in want.values())
    assert {r["vec_id"]: r["topic"] for r in got} == {i: t for i, (t, _) in want.items()}
    assert all(abs(r["prob"] - want[r["vec_id"]][1]) < 1e-9 for r in got)


def test_nearest_rows_are_exact(spark):
    points = blobs(3)
    df = spark.createDataFrame(list(points.items()), "id long, v array<double>")
    got = {}
    for r in density.nearest_rows(df, 5, block=7).collect():
        got.setdefault(r["id"], set()).add(r["other"])
    x = {i: np.array(v) for i, v in points.items()}
    for i in points:
        assert got[i] == set(sorted((o for o in points if o != i), key=lambda o: (np.sqrt(((x[i] - x[o]) ** 2).sum()), o))[:5])


def test_copies_odd_rows_and_an_empty_table(spark):
    rows = [(i, [0.0, 0.0]) for i in range(30)] + [(100 + i, [5.0 + i / 100, 5.0]) for i in range(20)] + [(200, None), (201, [float("nan"), 0.0]), (202, [None, 1.0]), (None, [1.0, 1.0]), (300, [90.0, 90.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["topic"] for r in density.cluster_density(df, "vec_id", "embedding", 10, 5, neighbours=30).collect()}
    assert {got[i] for i in range(30)} == {0} and {got[100 + i] for i in range(5, 15)} == {100}
    assert {got[i] for i in (200, 201, 202, None, 300)} == {-1}
    assert density.cluster_density(df.limit(0), "vec_id", "embedding").count() == 0


def test_rows_are_copied_by_the_askers_of_their_cell_only(spark):
    asking = spark.createDataFrame([(i, [0.0], 0) for i in range(5)] + [(9, [1.0], 1)], "id long, v array<double>, cell int")
    held = spark.createDataFrame([(1, [0.0], 0, 0), (2, [0.0], 0, 1), (9, [1.0], 1, 0), (7, [2.0], 2, 0)], "id long, v array<double>, cell int, block int")
    left, right = density.by_askers(asking, held, per_part=2)
    assert sorted((r["id"], r["part"]) for r in right.collect()) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2), (9, 0)]
    assert sorted(r["id"] for r in left.collect()) == [0, 1, 2, 3, 4, 9]
    assert all(r["part"] < (3 if r["cell"] == 0 else 1) for r in left.collect())
    empty, none = density.by_askers(asking.limit(0), held)
    assert empty.count() == none.count() == 0
