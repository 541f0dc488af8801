"""Approximate nearest neighbours: one navigable small-world graph per shard.

Rows with equal vectors are one node, which keeps as many of its smallest ids as a
result can ask for. Nodes are dealt to shards of bounded size by a hash of the vector.
A shard's graph has levels; each level is one flat array of neighbour places. Nodes
are added in batches: a batch is searched in the graph so far, linked to the diverse
ones among its nearest nodes, and linked back.

Nearness is the inner product. To link nodes of different lengths sensibly, each gets
one more coordinate that makes all lengths in the shard equal; queries have 0 there,
so their products are unchanged.

Queries meet every shard, in blocks. What a shard finds is scored again in double
precision on the original vectors, and the shards' results are merged per query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from threadloom.session import materialize

#: Nodes in a shard, links of a node above and on the ground level, breadth of searches while building and answering.
SHARD_NODES = 10_000
LINKS = 16
GROUND_LINKS = 32
BUILD_BREADTH = 64
BREADTH = 128
#: Nodes added together, queries in a block, beam entries opened together.
BATCH = 256
QUERY_BLOCK = 4096
OPENED = 4


def beam_search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, breadth: int):
    """The ``breadth`` best places found for each query, best first: places, products; -1 pads.

    All queries advance together: in each round every query opens the best places of
    its beam that it has not opened, until it has opened its whole beam.
    """
    n, width = len(queries), links.shape[1]
    opened_at_once = min(OPENED, breadth)
    breadth = max(breadth, entries.shape[1])
    places = np.full((n, breadth), -1, dtype=np.int32)
    scores = np.full((n, breadth), -np.inf, dtype=np.float32)
    opened = np.ones((n, breadth), dtype=bool)
    e = entries.shape[1]
    places[:, :e] = entries
    scores[:, :e] = np.where(entries >= 0, np.einsum("bed,bd->be", vectors[entries], queries), -np.inf)
    opened[:, :e] = entries < 0
    seen = np.zeros((n, len(vectors)), dtype=bool)
    seen[np.arange(n)[:, None], entries] = True
    rows = np.arange(n)
    while True:
        waiting = np.where(opened[rows], -np.inf, scores[rows])
        rows_left = waiting.max(axis=1) > -np.inf
        rows, waiting = rows[rows_left], waiting[rows_left]
        if not len(rows):
            break
        best = np.argpartition(-waiting, opened_at_once - 1, axis=1)[:, :opened_at_once]
        real = np.take_along_axis(waiting, best, 1) > -np.inf
        at = rows[:, None]
        current = np.where(real, places[at, best], 0)
        opened[at, best] = True
        near = np.where(real[:, :, None], links[current], -1).reshape(len(rows), opened_at_once * width)
        near = np.sort(near, axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        near = np.where(fresh, near, 0)
        fresh &= ~seen[at, near]
        r, c = np.nonzero(fresh)
        seen[rows[r], near[r, c]] = True
        found = np.full(near.shape, -np.inf, dtype=np.float32)
        found[r, c] = np.einsum("id,id->i", vectors[near[r, c]], queries[rows[r]])
        all_scores = np.concatenate((scores[rows], found), axis=1)
        all_places = np.concatenate((places[rows], near.astype(np.int32)), axis=1)
        all_opened = np.concatenate((opened[rows], ~fresh), axis=1)
        top = np.argpartition(-all_scores, breadth - 1, axis=1)[:, :breadth]
        scores[rows] = np.take_along_axis(all_scores, top, 1)
        places[rows] = np.take_along_axis(all_places, top, 1)
        opened[rows] = np.take_along_axis(all_opened, top, 1)
    order = np.argsort(-scores, axis=1, kind="stable")
    scores = np.take_along_axis(scores, order, 1)
    places = np.where(scores > -np.inf, np.take_along_axis(places, order, 1), -1)
    return places, scores


def diverse(vectors: np.ndarray, candidates: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, best first, those nearer to the row than to any taken before; then the best others.

    -1 pads candidates and results.
    """
    rows, width = candidates.shape
    own = vectors[candidates]
    mutual = np.einsum("bcd,bed->bce", own, own)
    real = (candidates >= 0) & (scores > -np.inf)
    taken = np.zeros((rows, width), dtype=bool)
    nearest_taken = np.full((rows, width), -np.inf, dtype=np.float32)
    for c in range(width):
        good = real[:, c] & (scores[:, c] > nearest_taken[:, c]) & (taken.sum(axis=1) < most)
        taken[:, c] = good
        nearest_taken = np.where(good[:, None], np.maximum(nearest_taken, mutual[:, c, :]), nearest_taken)
    rank = np.where(taken, 0, np.where(real, width, 3 * width)) + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :most]
    chosen = np.where(np.take_along_axis(real, order, 1), np.take_along_axis(candidates, order, 1), -1)
    if chosen.shape[1] < most:
        chosen = np.pad(chosen, ((0, 0), (0, most - chosen.shape[1])), constant_values=-1)
    return chosen.astype(np.int32)


def exact_links(vectors: np.ndarray, members: np.ndarray, most: int, breadth: int) -> np.ndarray:
    """Links among ``members`` (places) from all their products, row by row of blocks."""
    out = np.full((len(members), most), -1, dtype=np.int32)
    own = vectors[members]
    width = min(breadth, len(members) - 1)
    if width <= 0:
        return out
    for at in range(0, len(members), BATCH):
        products = own[at : at + BATCH] @ own.T
        products[np.arange(len(products)), np.arange(at, at + len(products))] = -np.inf
        top = np.argpartition(-products, width - 1, axis=1)[:, :width]
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(products, top, 1), axis=1, kind="stable"), 1)
        out[at : at + BATCH] = diverse(vectors, members[top], np.take_along_axis(products, top, 1), most)
    return out


def link_back(vectors: np.ndarray, links: np.ndarray, new: np.ndarray) -> None:
    """Add each new node to the lists of the nodes it is linked to; full lists are chosen anew."""
    source = np.repeat(new, links.shape[1])
    target = links[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    touched, start, count = np.unique(target, return_index=True, return_counts=True)
    if not len(touched):
        return
    most = links.shape[1]
    extra = np.full((len(touched), count.max()), -1, dtype=np.int32)
    extra[np.repeat(np.arange(len(touched)), count), np.arange(len(target)) - np.repeat(start, count)] = source
    pool = np.concatenate((links[touched], extra), axis=1)
    held = (pool >= 0).sum(axis=1)
    roomy = held <= most
    packed = np.take_along_axis(pool, np.argsort(pool < 0, axis=1, kind="stable"), 1)
    links[touched[roomy]] = packed[roomy, :most]
    for at in range(0, int((~roomy).sum()), BATCH):
        which = np.flatnonzero(~roomy)[at : at + BATCH]
        candidates = packed[which][:, : held[which].max()]
        scores = np.where(candidates >= 0, np.einsum("bcd,bd->bc", vectors[candidates], vectors[touched[which]]), -np.inf)
        by_score = np.argsort(-scores, axis=1, kind="stable")
        links[touched[which]] = diverse(vectors, np.take_along_axis(candidates, by_score, 1), np.take_along_axis(scores, by_score, 1), most)


class Graph:
    """Levels of links over places; level 0 holds all, a higher level the first ``sizes[level]`` places."""

    def __init__(self, vectors: np.ndarray, levels: list[np.ndarray]):
        self.vectors, self.levels = vectors, levels

    @classmethod
    def build(cls, vectors: np.ndarray) -> "Graph":
        """Places are in random order, so the first n / LINKS, n / LINKS^2 ... of them are the higher levels."""
        n = len(vectors)
        sizes = [n]
        while sizes[-1] > 2 * LINKS:
            sizes.append(max(1, sizes[-1] // LINKS))
        levels = [exact_links(vectors, np.arange(size), LINKS, BUILD_BREADTH) for size in sizes[1:]]
        ground = np.full((n, GROUND_LINKS), -1, dtype=np.int32)
        first = min(n, max(sizes[1] if len(sizes) > 1 else n, 2 * BATCH))
        ground[:first] = exact_links(vectors, np.arange(first), GROUND_LINKS, BUILD_BREADTH)
        link_back(vectors, ground, np.arange(first))
        graph = cls(vectors, [ground, *levels])
        at = first
        while at < n:
            new = np.arange(at, min(n, at + min(BATCH, at)))
            queries = vectors[new]
            places, scores = graph.search(queries, BUILD_BREADTH)
            within = queries @ queries.T
            np.fill_diagonal(within, -np.inf)
            few = min(8, len(new) - 1)
            if few > 0:
                top = np.argpartition(-within, few - 1, axis=1)[:, :few]
                places = np.concatenate((places, new[top].astype(np.int32)), axis=1)
                scores = np.concatenate((scores, np.take_along_axis(within, top, 1)), axis=1)
                order = np.argsort(-scores, axis=1, kind="stable")
                places, scores = np.take_along_axis(places, order, 1), np.take_along_axis(scores, order, 1)
            ground[new] = diverse(vectors, places, scores, LINKS) if LINKS == GROUND_LINKS else np.pad(
                diverse(vectors, places, scores, LINKS), ((0, 0), (0, GROUND_LINKS - LINKS)), constant_values=-1
            )
            link_back(vectors, ground, new)
            at = int(new[-1]) + 1
        return graph

    def search(self, queries: np.ndarray, breadth: int):
        """Down from the highest level, then the ground level with the whole breadth."""
        entries = np.zeros((len(queries), 1), dtype=np.int64)
        for links in reversed(self.levels[1:]):
            entries, _ = beam_search(self.vectors[: len(links)], links, queries, entries, 4)
            entries = np.where(entries >= 0, entries, entries[:, :1]).astype(np.int64)
            entries = entries[:, :1] if len(links) < 4 else entries[:, :4]
            entries = np.sort(entries, axis=1)
            entries[:, 1:] = np.where(entries[:, 1:] == entries[:, :-1], -1, entries[:, 1:])
        return beam_search(self.vectors, self.levels[0], queries, entries, breadth)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: an id, and a vector that is not null, empty or zero and holds finite numbers only."""
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda v: v != 0))


def build_shards(nodes: DataFrame) -> DataFrame:
    """One row per shard: its vectors, ids of its nodes, and the flat links of its levels."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        exact = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        vectors = scaled(exact, np.abs(exact).max())
        lengths = np.einsum("id,id->i", vectors, vectors, dtype=np.float64)
        level = np.sqrt(np.maximum(lengths.max() - lengths, 0)).astype(np.float32)
        graph = Graph.build(np.ascontiguousarray(np.concatenate((vectors, level[:, None]), axis=1)))
        counts = rows["ids"].map(len).to_numpy(dtype=np.int32)
        return pd.DataFrame({
            "shard": [key[0]], "dims": [key[1]],
            "vectors": [exact.tobytes()], "level": [level.tobytes()],
            "ids": [np.concatenate([np.asarray(i, dtype=np.int64) for i in rows["ids"]]).tobytes()], "counts": [counts.tobytes()],
            "links": [[level_links.tobytes() for level_links in graph.levels]],
        })

    schema = "shard int, dims int, vectors binary, level binary, ids binary, counts binary, links array<binary>"
    return nodes.groupBy("shard", "dims").applyInPandas(run, schema)


def scaled(vectors: np.ndarray, most) -> np.ndarray:
    """Single-precision vectors for walking the graph; a common factor leaves the order of products as it is."""
    return np.ascontiguousarray((vectors / most).astype(np.float32))


def with_ties(vectors: np.ndarray, asked: np.ndarray, found: np.ndarray, k: int, breadth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that may be among the ``k`` best besides the query's own, and their scores, ties at the end included.

    If all that a walk saw last has one score, there may be more of it than the walk's
    breadth: then the whole shard is compared with this query.
    """
    score = (vectors[found] * asked).sum(axis=1)
    if len(found) <= k:
        return found, score
    least = -np.partition(-score, k)[k]
    if len(found) >= breadth and score.min() >= least:
        found = np.arange(len(vectors))
        score = (vectors * asked).sum(axis=1)
    near = score >= least
    return found[near], score[near]


def answer(graphs: pd.DataFrame, queries: pd.DataFrame, k: int, breadth: int) -> pd.DataFrame:
    """The ``k`` best rows of one shard for each of a block of queries."""
    out = {"query_id": [], "query_hash": [], "vec_id": [], "score": []}
    if len(graphs) and len(queries):
        row = graphs.iloc[0]
        vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, row["dims"])
        level = np.frombuffer(row["level"], dtype=np.float32)
        ids, counts = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["counts"], dtype=np.int32)
        first = np.concatenate(([0], np.cumsum(counts)))
        widths = [GROUND_LINKS] + [LINKS] * (len(row["links"]) - 1)
        levels = [np.frombuffer(b, dtype=np.int32).reshape(-1, w) for b, w in zip(row["links"], widths)]
        graph = Graph(np.ascontiguousarray(np.concatenate((scaled(vectors, np.abs(vectors).max()), level[:, None]), axis=1)), levels)
        asked = np.stack(queries["vector"].to_numpy()).astype(np.float64)
        padded = np.concatenate((scaled(asked, np.abs(asked).max(axis=1, keepdims=True)), np.zeros((len(asked), 1), dtype=np.float32)), axis=1)
        for at in range(0, len(asked), BATCH):
            places, _ = graph.search(padded[at : at + BATCH], breadth)
            for i, row_places in enumerate(places):
                own = int(queries["query_id"].iloc[at + i])
                found, score = with_ties(vectors, asked[at + i], row_places[row_places >= 0], k, breadth)
                rows = [(-s, v, s) for p, s in zip(found, score) for v in ids[first[p] : first[p + 1]] if v != own]
                rows.sort()
                for _, v, s in rows[:k]:
                    out["query_id"].append(own)
                    out["query_hash"].append(queries["query_hash"].iloc[at + i])
                    out["vec_id"].append(int(v))
                    out["score"].append(float(s))
    return pd.DataFrame(out).astype({"query_id": "int64", "query_hash": "int64", "vec_id": "int64", "score": "float64"})


def nearest(vectors: DataFrame, is_query, k: int = 20, breadth: int = BREADTH, shard_nodes: int = SHARD_NODES,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows found for every row that ``is_query`` (a column of the id) picks.

    Columns: query_id, rank from 1, vec_id, score; nearest first, ties to the smaller
    id, however many rows tie. Scores are sums in double precision over the original vectors. A row is never found for its own id. Vectors that are null, empty, zero or not
    finite, and rows without an id, take no part. Vectors meet those of their own
    number of dimensions only. Repeated rows are found as often as they occur, but a
    repeated query is answered once. Fewer candidates than ``k`` give fewer rows, an
    empty table none. Other columns are not read.
    """
    picked = usable(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")))
    by_vector = Window.partitionBy("vector").orderBy("id")
    nodes = materialize(
        picked.withColumn("_r", F.row_number().over(by_vector)).where(F.col("_r") <= k + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")),
        "nodes",
    )
    shards = max(1, math.ceil(nodes.count() / shard_nodes))
    place = F.xxhash64("vector", F.lit(7))
    dealt = nodes.select("vector", "ids", F.size("vector").alias("dims"), place.alias("place"), F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"))
    graphs = materialize(build_shards(dealt), "graphs")
    queries = picked.where(is_query(F.col("id"))).select(
        F.col("id").alias("query_id"), F.xxhash64("vector").alias("query_hash"), "vector", F.size("vector").alias("dims")
    ).dropDuplicates(["query_id", "query_hash"])
    queries = materialize(queries, "queries")
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    block = F.pmod(F.col("query_hash"), F.lit(blocks)).cast("int")
    asked = queries.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    offered = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["shard", "dims", "block"]
    found = offered.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(
        lambda g, q: answer(g, q, k, breadth), "query_id long, query_hash long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
