"""Density clustering with noise, as joins and bounded groups.

Rows are nodes of a graph: each is linked to its nearest rows, an edge weighs the
largest of its length and the core distances of both ends. Of this graph a minimum
spanning forest is grown by rounds of joins, every component adding its lightest edge.
Merging along the forest's edges, lightest first, gives the cluster tree: components of
at least ``min_cluster_size`` rows are clusters, smaller ones drop out of the cluster
they join. The clusters that last longest are kept; rows outside are noise.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window as W, functions as F

from threadloom.session import materialize

#: Rows of a block of a cell; two blocks are compared in one task.
BLOCK = 2000
#: Rows that ask one block in one task, about.
ASKING = 16384
#: Centres of cells; their coordinates are sent to all tasks.
CELLS = 1024
#: Forest edges merged in one pass.
EDGES = 500_000
#: Distances below this count as this, so that equal rows have a finite density.
LEAST_DISTANCE = 1e-9


def principal(df: DataFrame, vector: str, components: int) -> DataFrame:
    """Replace a vector column by its principal components."""
    rows = df.withColumn("_v", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    reduced = PCA(k=components, inputCol="_v", outputCol="_r").fit(rows).transform(rows)
    return reduced.withColumn(vector, vector_to_array("_r")).drop("_v", "_r")


# ---- nearest rows ----

def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2), 0)) if a.size * len(b) < 1 << 24 else np.vstack([distances(p, b) for p in np.array_split(a, 2)])


def stacked(values) -> np.ndarray:
    return np.array(list(values), dtype=np.float64)


def by_askers(asking: DataFrame, held: DataFrame, per_part: int = ASKING) -> tuple[DataFrame, DataFrame]:
    """Deal the rows that ask a cell over parts, and give each part a copy of the cell's rows.

    ``asking`` (id, v, cell) and ``held`` (id, v, cell, block) get a column ``part``. A cell has as
    many parts as its own askers fill, so a row is copied as often as its cell is crowded, however
    large the table is. Cells that nobody asks are left out.
    """
    counts = asking.groupBy("cell").agg(F.count("*").alias("n")).collect()  # one row a cell
    if not counts:
        return asking.withColumn("part", F.lit(0)), held.limit(0).withColumn("part", F.lit(0))
    pairs = [x for r in sorted(counts) for x in (r["cell"], -(-r["n"] // per_part))]
    parts = F.create_map(*[F.lit(x) for x in pairs])[F.col("cell")]
    dealt = asking.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    return dealt, held.where(parts.isNotNull()).withColumn("part", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))


def nearest_rows(points: DataFrame, k: int, block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """The ``k`` nearest other rows of each of ``points`` (id long, v array of doubles): id, other, d.

    Exact; ties go to the smaller id. Rows are dealt to the cell of the nearest of some
    centres, large cells to several blocks. Distances within a row's own block bound how
    far its nearest rows are; it then asks every block of the cells that reach as near, by
    their radius and by the plane between the two centres.
    """
    spark = points.sparkSession
    n = points.count()
    centres = points.orderBy(F.xxhash64("id"), "id").limit(int(min(cells, max(1, n**0.5)))).collect()
    if not centres:
        return spark.createDataFrame([], "id long, other long, d double")
    middle = spark.sparkContext.broadcast(stacked(r["v"] for r in centres))

    def deal(frames):
        for frame in frames:
            far = distances(stacked(frame["v"]), middle.value)
            cell = far.argmin(axis=1)
            yield frame[["id", "v"]].assign(cell=cell.astype(np.int32), d=far[np.arange(len(frame)), cell])

    dealt = materialize(points.select("id", "v").mapInPandas(deal, "id long, v array<double>, cell int, d double"), "cells")
    sizes = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("reach")).collect()
    blocks = {r["cell"]: -(-r["n"] // block) for r in sizes}
    reach = np.full(len(centres), -np.inf)
    for r in sizes:
        reach[r["cell"]] = r["reach"]
    split = F.create_map(*[F.lit(x) for pair in sorted(blocks.items()) for x in pair])[F.col("cell")]
    held = dealt.select("id", "v", "cell", F.pmod(F.xxhash64("id"), split).cast("int").alias("block"))

    def bound(rows: pd.DataFrame) -> pd.DataFrame:
        v = stacked(rows["v"])
        limit = np.full(len(rows), np.inf)
        if len(rows) > k:
            for at in range(0, len(rows), 256):
                limit[at : at + 256] = np.partition(distances(v[at : at + 256], v), k, axis=1)[:, k]
        return rows[["id", "v"]].assign(limit=limit)

    bounded = materialize(held.groupBy("cell", "block").applyInPandas(bound, "id long, v array<double>, limit double"), "bounded")

    def ask(frames):
        apart = distances(middle.value, middle.value)
        for frame in frames:
            far, limit = distances(stacked(frame["v"]), middle.value), frame["limit"].to_numpy()[:, None] * (1 + 1e-9) + 1e-12
            own = far.argmin(axis=1)
            between = apart[own]  # a cell's rows lie beyond the plane half way between the two centres
            plane = (far**2 * (1 - 1e-12) - far[np.arange(len(frame)), own][:, None] ** 2) / np.where(between > 0, 2 * between, np.inf)
            rows, asked = np.nonzero((far - reach <= limit) & (plane <= limit))
            yield pd.DataFrame({"id": frame["id"].to_numpy()[rows], "v": frame["v"].to_numpy()[rows], "cell": asked.astype(np.int32)})

    asking = bounded.mapInPandas(ask, "id long, v array<double>, cell int")
    asking, asked = by_askers(asking.where(split.isNotNull()), held)
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), split - 1)))

    def answer(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "other": [], "d": []}).astype({"id": "int64", "other": "int64"})
        right = right.sort_values("id")
        ids, v, out = right["id"].to_numpy(), stacked(right["v"]), []
        for at in range(0, len(left), 256):
            part = left.iloc[at : at + 256]
            far = distances(stacked(part["v"]), v)
            far[part["id"].to_numpy()[:, None] == ids[None, :]] = np.inf
            near = np.argsort(far, axis=1, kind="stable")[:, :k]
            found = pd.DataFrame({"id": np.repeat(part["id"].to_numpy(), near.shape[1]), "other": ids[near].ravel(), "d": np.take_along_axis(far, near, 1).ravel()})
            out.append(found[np.isfinite(found["d"])])
        return pd.concat(out)

    key = ["cell", "block", "part"]
    found = asking.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(answer, "id long, other long, d double")
    best = W.partitionBy("id").orderBy("d", "other")
    return found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).drop("_r")


def reachability(near: DataFrame, copies: DataFrame, min_samples: int) -> tuple[DataFrame, DataFrame]:
    """Edges (a < b, w) of the mutual reachability graph, and core distances (id, core).

    ``copies`` (id, copies) counts the rows at each place; a row's core distance is that to
    the ``min_samples``-th other row, copies counted one by one.
    """
    others = near.join(copies.withColumnRenamed("id", "other").withColumnRenamed("copies", "c"), "other")
    so_far = F.sum("c").over(W.partitionBy("id").orderBy("d", "other").rowsBetween(W.unboundedPreceding, 0))
    counted = others.withColumn("before", so_far).join(copies, "id")
    enough = F.col("before") + F.col("copies") - 1 >= min_samples
    reached = counted.groupBy("id").agg(F.min(F.when(enough, F.col("d"))).alias("reached"), F.max("d").alias("last"))
    core = copies.join(reached, "id", "left").select(
        "id", F.when(F.col("copies") > min_samples, 0.0).otherwise(F.coalesce("reached", "last", F.lit(0.0))).alias("core")
    )
    core = materialize(core, "core")
    sided = near.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), "d").groupBy("a", "b").agg(F.min("d").alias("d"))
    weighed = sided.join(core.select(F.col("id").alias("a"), F.col("core").alias("ca")), "a").join(core.select(F.col("id").alias("b"), F.col("core").alias("cb")), "b")
    return weighed.select("a", "b", F.greatest("d", "ca", "cb").alias("w")), core


# ---- spanning forest ----

def spanning_forest(edges: DataFrame) -> DataFrame:
    """The minimum spanning forest of edges (a, b, w): a, b, w. Equal weights are ordered by a and b.

    Every round each component takes its lightest edge to another one, so their number
    halves at least. Edges inside a component are dropped as it grows.
    """
    left = materialize(edges.select("a", "b", "w", F.col("a").alias("ca"), F.col("b").alias("cb")), "edges")
    taken = None
    while not left.isEmpty():
        edge = F.struct("w", "a", "b")
        ends = left.select(F.col("ca").alias("c"), F.col("cb").alias("to"), edge.alias("e")).unionByName(left.select(F.col("cb").alias("c"), F.col("ca").alias("to"), edge.alias("e")))
        best = materialize(ends.groupBy("c").agg(F.min(F.struct("e", "to")).alias("m")).select("c", F.col("m.to").alias("to"), "m.e"), "lightest")
        new = best.select("e.a", "e.b", "e.w").distinct()
        taken = new if taken is None else taken.unionByName(new)
        label = hooked(best.select("c", "to"))
        for end in ("ca", "cb"):
            left = left.join(label.select(F.col("c").alias(end), "root"), end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        left = materialize(left.where(F.col("ca") != F.col("cb")), "edges")
    return taken if taken is not None else edges.select("a", "b", "w")


def hooked(steps: DataFrame) -> DataFrame:
    """Where the steps c -> to end: c, root. Of two that step to each other the smaller is the root."""
    back = steps.select(F.col("c").alias("to"), F.col("to").alias("onward"))
    state = steps.join(back, "to", "left").select("c", F.when((F.col("onward") == F.col("c")) & (F.col("c") < F.col("to")), F.col("c")).otherwise(F.col("to")).alias("root"))
    while True:
        state = materialize(state, "roots")
        onward = state.select(F.col("c").alias("root"), F.col("root").alias("next"))
        moved = state.join(onward, "root", "left").withColumn("next", F.coalesce("next", "root"))
        if moved.where(F.col("next") != F.col("root")).isEmpty():
            return state
        state = moved.select("c", F.col("next").alias("root"))


# ---- cluster tree ----

STATE = "label long, size long, cluster long, density double, below double, peak double"
EVENT = f"kind string, {STATE}, parent long, born double, chosen boolean"


class Merger:
    """Merges components along edges, lightest first; ``events`` tells what became of components, clusters and dropped rows.

    A component of enough rows is a cluster: it begins when two small ones join, goes on
    when a small one drops out of it at an edge's density, and ends when it meets
    another cluster. Its stability is the density at which its rows leave it, summed,
    over that at which it ends.
    """

    def __init__(self, least: int, state: dict[int, dict], number: int):
        self.least, self.parts, self.number = least, state, number
        self.leader: dict[int, int] = {}
        self.events: list[dict] = []

    def find(self, node: int) -> int:
        path = []
        while node in self.leader:
            path.append(node)
            node = self.leader[node]
        for p in path:
            self.leader[p] = node
        return node

    def tell(self, kind: str, **values) -> None:
        self.events.append({"kind": kind, **values})

    def close(self, part: dict, parent: int, born: float) -> float:
        """Record a finished cluster; gives the best stability in it."""
        stability = part["density"] - born * part["size"]
        chosen = part["below"] is None or stability >= part["below"]
        self.tell("cluster", cluster=part["cluster"], parent=parent, born=born, peak=part["peak"], size=part["size"], density=stability, chosen=chosen)
        return stability if chosen else part["below"]

    def merge(self, a: int, b: int, w: float) -> None:
        density, self.number = 1 / max(w, LEAST_DISTANCE), self.number + 1
        a, b = sorted((self.find(a), self.find(b)))
        one, two = self.parts[a], self.parts.pop(b)
        size = one["size"] + two["size"]
        big = [p for p in (one, two) if p["cluster"] is not None]
        new = {"size": size, "cluster": None, "density": 0.0, "below": None, "peak": None}
        if len(big) == 2:
            below = self.close(one, self.number, density) + self.close(two, self.number, density)
            new |= {"cluster": self.number, "density": density * size, "below": below, "peak": density}
        elif big:
            small, name = (two, b) if one is big[0] else (one, a)
            self.tell("drop", label=name, cluster=big[0]["cluster"], density=density)
            new = big[0] | {"size": size, "density": big[0]["density"] + density * small["size"]}
        elif size >= self.least:
            new |= {"cluster": self.number, "density": density * size, "peak": density}
            for name in (a, b):
                self.tell("drop", label=name, cluster=self.number, density=density)
        else:
            self.tell("small", label=b, cluster=a)
        self.parts[a] = new
        self.leader[b] = a

    def result(self) -> pd.DataFrame:
        for label, part in self.parts.items():
            self.tell("part", label=label, **part)
        for label in list(self.leader):
            self.tell("moved", label=label, cluster=self.find(label))
        names = [f.split()[0] for f in EVENT.split(", ")]
        longs = {n: "Int64" for n in ("label", "size", "cluster", "parent")}
        return pd.DataFrame(self.events).reindex(columns=names).astype({**longs, **{n: "float64" for n in ("density", "below", "peak", "born")}, "chosen": "boolean"})


def cluster_tree(forest: DataFrame, least: int, per_pass: int = EDGES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clusters, dropped rows and final components of a forest (a, b, w).

    Edges are dealt to ranges of their order; a pass merges one range of about
    ``per_pass`` edges in a task. Between passes only the components' state is carried.
    """
    ranges = max(1, -(-forest.count() // per_pass))
    dealt = forest.repartitionByRange(ranges, "w", "a", "b").withColumn("pass", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    nodes = dealt.select(F.col("a").alias("node")).unionByName(dealt.select(F.col("b").alias("node"))).distinct()
    labels = nodes.select("node", F.col("node").alias("label"))
    fresh = {"size": F.lit(1).cast("long"), "cluster": F.lit(None).cast("long"), "density": F.lit(0.0), "below": F.lit(None).cast("double"), "peak": F.lit(None).cast("double")}
    parts = nodes.select(F.col("node").alias("label"), *[c.alias(n) for n, c in fresh.items()])
    events, held_names = None, tuple(fresh)
    for number in range(ranges):
        base = number << 32  # the pass is computed before the next one begins

        def merged(rows: pd.DataFrame) -> pd.DataFrame:
            state = {}
            for end in ("a", "b"):
                for r in rows[[f"{end}_{n}" for n in ("label", *held_names)]].drop_duplicates(f"{end}_label").itertuples(index=False):
                    state[int(r[0])] = {n: (None if pd.isna(v) else float(v) if n in ("density", "below", "peak") else int(v)) for n, v in zip(held_names, r[1:])}
            merger = Merger(least, state, base)  # noqa: B023
            for r in rows.sort_values(["w", "a", "b"]).itertuples():
                merger.merge(int(r.a_label), int(r.b_label), float(r.w))
            return merger.result()

        edges = dealt.where(F.col("pass") == number).select("a", "b", "w")
        for end in ("a", "b"):
            held = labels.join(parts, "label").select(F.col("node").alias(end), *[F.col(n).alias(f"{end}_{n}") for n in ("label", *fresh)])
            edges = edges.join(held, end)
        found = materialize(edges.groupBy(F.lit(number).alias("pass")).applyInPandas(merged, EVENT), "events")
        told = found.where(F.col("kind").isin("cluster", "drop", "small"))
        events = told if events is None else events.unionByName(told)
        state = found.where(F.col("kind") == "part").select("label", *fresh)
        moved = found.where(F.col("kind") == "moved").select("label", F.col("cluster").alias("to"))
        touched = state.select("label").unionByName(moved.select("label"))
        parts = materialize(parts.join(touched, "label", "left_anti").unionByName(state), "parts")
        if number + 1 < ranges:
            labels = materialize(labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "nodes")
    clusters = events.where(F.col("kind") == "cluster").select("cluster", "parent", "peak", "chosen")
    top = parts.where(F.col("cluster").isNotNull())
    several = top.agg((F.count("*") > 1).alias("s")).first()["s"]
    kept = F.lit(several) & (F.col("below").isNull() | (F.col("density") >= F.col("below")))
    clusters = clusters.unionByName(top.select("cluster", F.lit(None).cast("long").alias("parent"), "peak", kept.alias("chosen")))
    dropped = events.where(F.col("kind") == "drop").select("label", "cluster", "density")
    small = events.where(F.col("kind") == "small").select(F.col("label").alias("c"), F.col("cluster").alias("to"))
    return clusters, dropped, small


def kept_clusters(clusters: DataFrame) -> DataFrame:
    """The topmost chosen cluster above each cluster, itself included: cluster, top (null: none)."""
    state = materialize(clusters.select("cluster", F.col("parent").alias("up"), F.when(F.col("chosen"), F.col("cluster")).alias("top")), "climb")
    while not state.where(F.col("up").isNotNull()).isEmpty():
        above = state.select(F.col("cluster").alias("up"), F.col("up").alias("next"), F.col("top").alias("higher"))
        state = materialize(state.join(above, "up", "left").select("cluster", F.col("next").alias("up"), F.coalesce("higher", "top").alias("top")), "climb")
    return state.select("cluster", "top")


def cluster_density(df: DataFrame, id_col: str, vector: str, min_cluster_size: int = 15, min_samples: int | None = None, neighbours: int | None = None,
                    block: int = BLOCK, per_pass: int = EDGES) -> DataFrame:
    """Cluster and membership of each row: the id, topic, prob.

    ``topic`` is the smallest id of the cluster's rows, -1 for noise; ``prob`` is the
    density at which a row leaves its cluster as a share of the cluster's highest, 0
    for noise. Core distances reach to the ``min_samples``-th other row
    (``min_cluster_size`` by default); the graph links each row to its ``neighbours``
    nearest distinct places (``min_samples`` by default), parts of it that do not hang
    together count as infinitely far apart. The cluster of all rows is not chosen.
    Ids are distinct longs. Rows with a null id, or a vector that is null or holds
    null or non-finite values, are noise. Copies of a vector are one place, held by
    many rows. An empty table gives no rows.
    """
    least_samples = min_samples or min_cluster_size
    v = F.transform(vector, lambda x: x.cast("double"))
    sound = F.col("id").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = materialize(df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")), "vectors")
    good = rows.where(sound)
    places = materialize(good.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "places")
    near = materialize(nearest_rows(places.select("id", "v"), neighbours or least_samples, block), "near")
    edges, core = reachability(near, places.select("id", "copies"), least_samples)
    shared = places.where(F.col("copies") > 1).select("v", F.col("id").alias("a"))
    twins = good.join(shared, "v").where(F.col("id") != F.col("a")).select("a", F.col("id").alias("b"))
    twins = twins.join(core.select(F.col("id").alias("a"), F.col("core").alias("w")), "a").select("a", "b", "w")
    forest = materialize(spanning_forest(edges).unionByName(twins), "forest")
    clusters, dropped, small = cluster_tree(forest, min_cluster_size, per_pass)
    clusters = materialize(clusters, "clusters")
    tops = kept_clusters(clusters).join(clusters.select(F.col("cluster").alias("top"), "peak"), "top")
    ends = hooked(small).select(F.col("c").alias("id"), F.col("root").alias("label"))
    own = rows.select("id").join(ends, "id", "left").select("id", F.coalesce("label", "id").alias("label"))
    placed = own.join(dropped, "label").join(tops, "cluster").select("id", "top", (F.least("density", "peak") / F.col("peak")).alias("prob"))
    placed = materialize(placed, "placed")
    named = placed.groupBy("top").agg(F.min("id").alias("topic"))
    found = placed.join(named, "top").select("id", "topic", "prob")
    return rows.select("id").join(found, "id", "left").select(F.col("id").alias(id_col), F.coalesce("topic", F.lit(-1)).alias("topic"), F.coalesce("prob", F.lit(0.0)).alias("prob"))
