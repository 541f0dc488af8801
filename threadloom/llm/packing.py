"""Best-fit packing of documents into sequences of fixed length, with conflicts.

A document longer than a sequence is cut; its full pieces are sequences of their own,
the rest is packed like a short document. A sequence takes a piece only if it has
room for it, holds no piece of the same duplicate cluster, and of the same source at
most one. Each sequence carries its sources and clusters as bit sets.

Open sequences are kept in the order of their remaining room. For a piece, longest
first, the search starts at the least room that is enough and goes on to the next
larger until a sequence without conflict is found: the tightest compatible one. If
there is none a new sequence is opened.

Pieces are dealt to packers of bounded size by a hash, so no source, cluster or
length gathers in one of them; each packer leaves at most the few sequences that
its own conflicts force.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from threadloom.session import materialize

CAPACITY = 2048
#: Pieces that one packer orders.
PACKER_ROWS = 4000


class Sequences:
    """Open sequences in the order of their remaining room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (room, sequence)
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.used: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Sequence and offset of a piece; source and cluster are bits, 0 for none."""
        order, sources, clusters = self.order, self.sources, self.clusters
        for at in range(bisect_left(order, (size, -1)), len(order)):
            room, sequence = order[at]
            if not (sources[sequence] & source or clusters[sequence] & cluster):
                del order[at]
                break
        else:
            sequence, room = len(self.used), self.capacity
            sources.append(0)
            clusters.append(0)
            self.used.append(0)
        offset = self.used[sequence]
        self.used[sequence] += size
        sources[sequence] |= source
        clusters[sequence] |= cluster
        if room > size:
            insort(order, (room - size, sequence))
        return sequence, offset


def bits_of(values) -> list[int]:
    """A bit for each distinct value; 0 for null."""
    seen: dict = {}
    return [0 if v is None or v != v else seen.setdefault(v, 1 << len(seen)) for v in values]


def pack_group(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pack the pieces of one packer, longest first, ties by id, text hash and first token."""
    rows = rows.sort_values(["size", "doc_id", "tie", "start"], ascending=[False, True, True, True], kind="stable", na_position="first")
    sequences = Sequences(capacity)
    placed = [
        sequences.place(int(size), source, cluster)
        for size, source, cluster in zip(rows["size"], bits_of(rows["source"]), bits_of(rows["cluster"]))
    ]
    return rows.assign(sequence=[s for s, _ in placed], offset=[o for _, o in placed])


def pieces(docs: DataFrame, capacity: int) -> DataFrame:
    """Cut documents (doc_id, n_tokens, source, cluster, tie) into pieces of at most ``capacity``.

    The salt keeps rows that are repeated very often apart; it is written with the
    pieces, so a repeated task deals them out as before.
    """
    full = F.floor((F.col("n_tokens") - 1) / capacity).cast("int")
    cut = docs.where(F.col("n_tokens") > 0).withColumn("piece", F.explode(F.sequence(F.lit(0), full)))
    start = (F.col("piece") * capacity).cast("long")
    sized = cut.withColumn("start", start).withColumn("size", F.least(F.lit(capacity).cast("long"), F.col("n_tokens") - start))
    return sized.withColumn("salt", F.floor(F.rand(7) * 64).cast("int"))


def pack(docs: DataFrame, capacity: int = CAPACITY, packer_rows: int = PACKER_ROWS) -> DataFrame:
    """Places of all pieces: doc_id, piece, start, size, bin, offset.

    ``docs`` has doc_id, n_tokens, source, cluster. ``bin`` names a sequence: packer
    and number within it, or the piece itself where it fills a sequence. Documents
    without tokens (null or 0) have no piece. A null source or cluster conflicts with
    nothing. Repeated rows are packed as often as they occur. An empty table gives no
    rows. Other columns are not read.
    """
    picked = docs.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"), F.col("source").cast("string").alias("source"),
                         F.col("cluster").cast("long").alias("cluster")).withColumn("tie", F.col("cluster"))
    cut = materialize(pieces(picked, capacity), "pieces")
    rest = cut.where(F.col("size") < capacity)
    packers = max(1, math.ceil(rest.count() / packer_rows))
    dealt = rest.withColumn("packer", F.pmod(F.xxhash64("doc_id", "tie", "start", "salt"), F.lit(packers)).cast("int"))
    schema = "doc_id long, piece int, start long, size long, bin string, offset long"

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        packed = pack_group(rows, capacity)
        packed["bin"] = f"{key[0]}-" + packed["sequence"].astype(str)
        return packed[["doc_id", "piece", "start", "size", "bin", "offset"]]

    small = dealt.groupBy("packer").applyInPandas(run, schema)
    whole = cut.where(F.col("size") == capacity).select(
        "doc_id", "piece", "start", "size",
        F.concat_ws("-", F.lit("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex("tie"), F.col("piece").cast("string"),
                    F.hex(F.monotonically_increasing_id())).alias("bin"),
        F.lit(0).cast("long").alias("offset"),
    )
    return small.unionByName(whole)


def words_and_cluster(docs: DataFrame) -> DataFrame:
    """Adds n_tokens, the words of a text, and cluster, a hash of these words in lower case:
    texts that differ in case or white space only are one cluster."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    counted = docs.select("doc_id", "source", words.alias("_w"))
    return counted.select("doc_id", "source", F.size("_w").cast("long").alias("n_tokens"), F.xxhash64(F.lower(F.array_join("_w", " "))).alias("cluster"))
