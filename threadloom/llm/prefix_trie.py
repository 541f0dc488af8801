"""The trie of conversation prefixes, grown from sorted conversations by union-find.

Conversations are rows (their turns' digests in a row), sorted by range over all
partitions. The longest common prefix of two neighbours is an edge of that depth.
Edges are taken by descending depth: joining the components at both ends makes the
branching node at that depth, and the chain above each component down to it are nodes
with one child. In a block of sorted rows every node is complete but those on the way to
the block's first and last row. These two ways are what a block is contracted to:
one row each, with the sums that hang on every depth. Contracted rows are sorted and
joined in the same way until one block is left.

A conversation is cut into segments of bounded length. Segments with the same turns
before them are a tree of their own, whose sums are handed to the node it hangs on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.session import materialize

#: Turns in a segment, nodes in a block, and contracted rows that are joined in one task.
SEGMENT = 512
BLOCK_NODES = 1 << 18
FINAL_ROWS = 4096
#: A block of so many rows at least becomes two rows, so every level is a quarter of the one before at most.
LEAST_ROWS = 8
#: Letters of a turn's digest, and conversation ids in one string that is hashed on.
DIGEST = 32
IDS_AT_ONCE = 1000

NODE = "kind string, block long, node string, conv_id long, depth long, parent_conv_id long, parent string, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
ROW = "grp string, first_depth long, up_id long, seq string, sizes array<long>, w array<long>, m array<long>, kids array<long>, leaves array<long>, saved array<long>, ends_at array<string>"


# ---- conversations as rows ----

def turn_digests(turns: DataFrame) -> DataFrame:
    """conv_id, turn, digest of role and text, and the text's bytes, for every turn of a conversation with an id."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )


def numbered(turns: DataFrame) -> DataFrame:
    """Turns with their place in the conversation: conv_id, place (from 0), digest, size.

    Turns are dealt by ranges of conversation and turn, so a conversation with any share
    of all turns is spread over tasks. Places are counted within a task; what earlier
    tasks hold of a conversation that goes on is added, one row a task at most.
    """
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "tie").sortWithinPartitions(*order, "tie")

    def count(batches):
        task = TaskContext.get().partitionId()
        last, done = None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(ids):
                continue
            starts = np.concatenate(([True], ids[1:] != ids[:-1]))
            at = np.arange(len(ids))
            places = at - np.maximum.accumulate(np.where(starts, at, 0))
            if ids[0] == last:
                places[: np.argmax(np.concatenate((starts[1:], [True]))) + 1] += done
            last, done = ids[-1], places[-1] + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), task), pa.int32()), batch.column(0), pa.array(places, pa.int64()), batch.column(2), batch.column(3)],
                ["task", "conv_id", "place", "digest", "size"],
            )

    counted = materialize(dealt.select("conv_id", "turn", "digest", "size").mapInArrow(count, "task int, conv_id long, place long, digest string, size long"), "places")
    runs = counted.groupBy("task", "conv_id").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    onward = runs.withColumn("before", F.sum("n").over(earlier)).where(F.col("before").isNotNull()).select("task", "conv_id", "before")
    return counted.join(F.broadcast(onward), ["task", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "digest", "size"
    )


def segments(items: Column, first: Column, length: int) -> Column:
    """The items (struct of digest, size) of depths ``first`` on, cut where the depth is a multiple of ``length``."""
    last = F.greatest(first + F.size(items) - 1, first)
    return F.transform(
        F.sequence((first / length).cast("long"), (last / length).cast("long")),
        lambda s: F.struct(
            s.alias("seg"), F.greatest(first, s * length).alias("from"),
            F.slice(items, (F.greatest(s * length - first, F.lit(0)) + 1).cast("int"), (F.least((s + 1) * length, first + F.size(items)) - F.greatest(first, s * length)).cast("int")).alias("items"),
        ),
    )


def rebuilt(turns: DataFrame, heads: int = 9, family: int = 5, length: int = SEGMENT) -> DataFrame:
    """Segments of rebuilt conversations: conv_id, seg, seq (digests in a row), sizes.

    Conversation c gets the first h turns of conversation c - c mod ``family``, then its
    own after its first h; h is the CRC-32 of the decimal c modulo ``heads``. With
    ``heads`` 1 conversations stay as they are. A conversation without turns is one
    empty segment.
    """
    placed = numbered(materialize(turn_digests(turns), "turns"))
    own_h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("long")
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(family))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("place", "digest", "size"))), lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size")))
    convs = placed.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", base.alias("base"), own_h.alias("h"))
    lent = placed.where((F.pmod("conv_id", F.lit(family)) == 0) & (F.col("place") < heads - 1)).groupBy(F.col("conv_id").alias("base")).agg(in_order.alias("lent"))
    none = F.expr("cast(array() as array<struct<digest:string,size:bigint>>)")
    begun = convs.join(lent, "base", "left").select("conv_id", F.slice(F.coalesce("lent", none), F.lit(1), F.col("h").cast("int")).alias("head"))
    kept = placed.withColumn("h", own_h).where(F.col("place") >= F.col("h")).withColumn("chunk", ((F.col("place") - F.col("h")) / length).cast("long"))
    chunks = kept.groupBy("conv_id", "chunk").agg(in_order.alias("own"))
    joined = begun.join(chunks, "conv_id", "left").withColumn("chunk", F.coalesce("chunk", F.lit(0)))
    start = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.size("head") + F.col("chunk") * length).cast("long")
    items = F.when(F.col("chunk") == 0, F.concat("head", F.coalesce("own", none))).otherwise(F.coalesce("own", none))
    whole = joined.select("conv_id", start.alias("first"), items.alias("items"))
    cut = whole.select("conv_id", F.explode(segments(F.col("items"), F.col("first"), length)).alias("s")).select("conv_id", "s.seg", "s.from", "s.items")
    pieces = cut.groupBy("conv_id", "seg").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("from", "items"))), lambda x: x["items"])).alias("items"))
    return pieces.select("conv_id", "seg", F.array_join(F.col("items.digest"), "").alias("seq"), F.col("items.size").alias("sizes"))


def with_group(parts: DataFrame) -> DataFrame:
    """Add what names the turns before a segment (grp), and whether the conversation goes on after it."""
    ends = parts.groupBy("conv_id").agg(F.max("seg").alias("last"), F.sort_array(F.collect_list(F.struct("seg", F.md5("seq").alias("own")))).alias("all"))
    several = ends.where(F.col("last") > 0)

    def chain(batches):
        for batch in batches:
            ids, segs, names, more = [], [], [], []
            for conv_id, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = ""
                for i, part in enumerate(own):
                    ids.append(conv_id)
                    segs.append(part["seg"])
                    names.append(name)
                    more.append(i + 1 < len(own))
                    name = hashlib.md5((name + part["own"]).encode()).hexdigest()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(segs, pa.int64()), pa.array(names, pa.string()), pa.array(more, pa.bool_())], ["conv_id", "seg", "grp", "more"])

    named = several.select("conv_id", "all").mapInArrow(chain, "conv_id long, seg long, grp string, more boolean")
    return parts.join(named, ["conv_id", "seg"], "left").select(
        "conv_id", "seg", "seq", "sizes", F.coalesce("grp", F.lit("")).alias("grp"), F.coalesce("more", F.lit(False)).alias("more")
    )


def ids_hashed(members: DataFrame) -> DataFrame:
    """SHA-256 of the ascending conversation ids of each node, joined by commas: node, ends.

    Ids are dealt by ranges of node and id, so many copies of one conversation are spread
    over tasks; strings of up to 1,000 ids are then hashed on, in order, in bounded memory.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id")

    def join(batches):
        node, ids = None, []
        for batch in batches:
            out = []
            for name, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (name != node or len(ids) >= IDS_AT_ONCE):
                    out.append((node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = name
                ids.append(conv_id)
            yield strings_of(out)
        if ids:
            yield strings_of([(node, ids[0], ",".join(map(str, ids)))])

    def strings_of(out):
        kinds = (pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["node", "first", "ids"])

    def digest(batches):
        node, hashed = None, None
        for batch in batches:
            done = []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name == node:
                    hashed.update(b"," + ids.encode())
                    continue
                if hashed is not None:
                    done.append((node, hashed.hexdigest()))
                node, hashed = name, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], ["node", "ends"])
        if hashed is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.string()), pa.array([hashed.hexdigest()], pa.string())], ["node", "ends"])

    strings = dealt.select("node", "conv_id").mapInArrow(join, "node string, first long, ids string")
    return strings.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(digest, "node string, ends string")


# ---- growing the trie ----

@dataclass
class Sums:
    """What hangs on a node: members, least member, children, childless nodes and saved tokens below, hash of its ends."""

    w: int = 0
    m: int | None = None
    kids: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None

    def add(self, other: Sums) -> None:
        self.w += other.w
        self.m = other.m if self.m is None else self.m if other.m is None else min(self.m, other.m)
        self.kids += other.kids
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends if other.ends is None else other.ends


@dataclass
class Tree:
    """A component of neighbouring rows: its top node, what else hangs on depths above it, and the nodes below without a parent yet."""

    first: int
    last: int
    depth: int
    top: Sums
    above: dict[int, Sums]
    below: list[dict] = field(default_factory=list)


def common(a: str, b: str) -> int:
    """Turns that two rows begin with alike."""
    if a == b[: len(a)]:
        return len(a) // DIGEST
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: middle * DIGEST] == b[: middle * DIGEST] else (low, middle - 1)
    return low


def node_name(grp: str, seq: str, depth: int) -> str:
    return hashlib.md5(f"{grp}/{seq[: depth * DIGEST]}".encode()).hexdigest()


class Block:
    """Sorted rows of one block, joined to the nodes that are complete and at most two contracted rows."""

    def __init__(self, rows: list[dict], number: int, whole: bool):
        self.rows, self.number, self.whole = rows, number, whole
        self.nodes: list[dict] = []
        self.ways = {i: {} for i in (0, len(rows) - 1)}

    def open_side(self, tree: Tree) -> int | None:
        """The block's end whose way the top of this tree lies on, if blocks beside may hold more of it."""
        if self.whole:
            return None
        return 0 if tree.first == 0 else len(self.rows) - 1 if tree.last == len(self.rows) - 1 else None

    def climb(self, tree: Tree, depth: int) -> None:
        """Complete the nodes of a tree above ``depth``, and make its top the node at ``depth``."""
        while tree.depth > depth:
            self.leave(tree)
            tree.depth -= 1
            if tree.depth in tree.above:
                tree.top.add(tree.above.pop(tree.depth))

    def leave(self, tree: Tree) -> None:
        """Finish the top node of a tree; its parent begins with what is known of this child."""
        row, top, side = self.rows[tree.first], tree.top, self.open_side(tree)
        if side is not None:
            name = node_name(row["grp"], row["seq"], tree.depth)
            for child in tree.below:
                child["parent"] = name
            self.ways[side][tree.depth] = top
            tree.top, tree.below = Sums(), []
            return
        record = self.record(tree, "node")
        for child in tree.below:
            child["parent_conv_id"] = top.m
        tree.top, tree.below = Sums(top.w, top.m, 1, record["n_leaves"], record["saved_tokens"]), [record]

    def record(self, tree: Tree, kind: str) -> dict:
        row, top = self.rows[tree.first], tree.top
        saved = top.saved + ((top.w - 1) * row["sizes"][tree.depth - 1] if tree.depth else 0)
        found = {
            "kind": kind, "block": self.number, "node": node_name(row["grp"], row["seq"], tree.depth) if row["named"] else None,
            "conv_id": top.m, "depth": row["first_depth"] + tree.depth, "parent_conv_id": None, "parent": None, "n_convs": top.w,
            "n_children": top.kids, "n_leaves": top.leaves if top.kids else 1, "saved_tokens": saved, "ends": top.ends,
        }
        if kind == "tree":
            found["node"] = row["grp"]
        self.nodes.append(found)
        return found

    def finish(self, tree: Tree) -> None:
        """The depth above the first turns of a tree: the root, or the sums of a tree that hangs on another."""
        self.climb(tree, 0)
        row, side = self.rows[tree.first], self.open_side(tree)
        if row["grp"]:  # the node above lies in another tree and is known
            for child in tree.below:
                child["parent_conv_id"] = row["up_id"]
            tree.below = []
        if side is not None:
            for child in tree.below:
                child["parent"] = node_name(row["grp"], row["seq"], 0)
            self.ways[side][0] = tree.top
            return
        self.record(tree, "tree" if row["grp"] else "node")
        for child in tree.below:
            child["parent_conv_id"] = tree.top.m

    def join(self) -> None:
        """Join neighbours by union-find over their edges in descending depth."""
        rows = self.rows
        trees: list[Tree | None] = []
        for i, row in enumerate(rows):
            depth = len(row["seq"]) // DIGEST
            above = {d: s for d, s in row["sums"].items() if d < depth}
            trees.append(Tree(i, i, depth, row["sums"].get(depth, Sums()), above))
        leader = list(range(len(rows)))

        def find(i: int) -> int:
            while leader[i] != i:
                leader[i] = leader[leader[i]]
                i = leader[i]
            return i

        edges = [(common(rows[i]["seq"], rows[i + 1]["seq"]), i) for i in range(len(rows) - 1) if rows[i]["grp"] == rows[i + 1]["grp"]]
        for depth, i in sorted(edges, key=lambda e: -e[0]):
            left, right = find(i), find(i + 1)
            one, two = trees[left], trees[right]
            self.climb(one, depth)
            self.climb(two, depth)
            one.top.add(two.top)
            one.last = two.last
            if len(one.below) < len(two.below):
                one.below, two.below = two.below, one.below
            one.below += two.below
            for at, sums in two.above.items():
                if at < depth:
                    one.above.setdefault(at, Sums()).add(sums)
            trees[right], leader[right] = None, left
        for i in range(len(rows)):
            if leader[i] == i:
                self.finish(trees[i])

    def contracted(self) -> list[dict]:
        if self.whole or not self.rows:
            return []
        out = []
        for i, way in self.ways.items():
            row = self.rows[i]
            depths = range(len(row["seq"]) // DIGEST + 1)
            at = [way.get(d, Sums()) for d in depths]
            out.append({
                "kind": "row", **{k: row[k] for k in ("grp", "first_depth", "up_id", "seq", "sizes")}, "w": [s.w for s in at], "m": [s.m for s in at],
                "kids": [s.kids for s in at], "leaves": [s.leaves for s in at], "saved": [s.saved for s in at], "ends_at": [s.ends for s in at],
            })
        return out


def read_rows(batch: pa.RecordBatch, level: int) -> Iterator[dict]:
    for row in batch.to_pylist():
        row["named"] = level > 0
        depth = len(row["seq"]) // DIGEST
        if level == 0:
            row["sums"] = {depth: Sums(row["w"], row["m"], row["kids"], row["leaves"], row["saved"], row["ends"])}
        else:
            columns = zip(row["w"], row["m"], row["kids"], row["leaves"], row["saved"], row["ends_at"])
            row["sums"] = {d: Sums(*values) for d, values in enumerate(columns)}
        yield row


def grown(rows: DataFrame, level: int, whole: bool, block_nodes: int) -> DataFrame:
    """Complete nodes and contracted rows of all blocks of the sorted rows."""
    schema = f"{NODE}, {ROW}"
    arrow = pa.schema([(f.split()[0], {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}[f.split()[1]]) for f in schema.split(", ")])

    def run(batches):
        task, blocks = TaskContext.get().partitionId(), 0

        def joined(held):
            block = Block(held, (level << 56) + (task << 32) + blocks, whole)
            block.join()
            out = block.nodes + block.contracted()
            for at in range(0, len(out), 1 << 14):
                yield pa.RecordBatch.from_pylist(out[at : at + (1 << 14)], arrow)

        held, nodes = [], 0
        for batch in batches:
            for row in read_rows(batch, level):
                held.append(row)
                nodes += len(row["sizes"]) + 1
                if nodes >= block_nodes and len(held) >= LEAST_ROWS and not whole:
                    yield from joined(held)
                    held, nodes, blocks = [], 0, blocks + 1
        if held:
            yield from joined(held)

    return rows.mapInArrow(run, schema)


def forest(rows: DataFrame, block_nodes: int = BLOCK_NODES, final_rows: int = FINAL_ROWS) -> DataFrame:
    """All nodes over rows (grp, first_depth, up_id, seq, sizes, w, m, kids, leaves, saved, ends), parents of open nodes by name.

    Each level leaves two rows a block; the last is one task over ``final_rows`` at most.
    """
    final_rows = max(final_rows, 2 * LEAST_ROWS)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    level, nodes = 0, None
    while True:
        last = parts == 1
        dealt = rows.coalesce(1) if last else rows.repartitionByRange(parts, "grp", "seq")
        found = materialize(grown(dealt.sortWithinPartitions("grp", "seq"), level, last, block_nodes), "trie")
        own = found.where(F.col("kind") != "row").select(*[f.split()[0] for f in NODE.split(", ")])
        nodes = own if nodes is None else nodes.unionByName(own)
        if last:
            return nodes
        rows = found.where(F.col("kind") == "row").select(*[f.split()[0] for f in ROW.split(", ")])
        parts = max(1, -(-rows.count() // final_rows))
        level += 1


def with_parents(nodes: DataFrame) -> DataFrame:
    """Replace names of parents by their least members.

    Names are looked up once a block, so that a parent of very many nodes is not one key.
    """
    known = nodes.where((F.col("kind") == "node") & F.col("node").isNotNull()).select(F.col("node").alias("parent"), F.col("conv_id").alias("found"))
    asked = nodes.where(F.col("parent").isNotNull()).select("block", "parent").distinct()
    answers = asked.join(known, "parent")
    found = nodes.where(F.col("parent").isNotNull()).join(answers, ["block", "parent"])
    return nodes.where(F.col("parent").isNull()).unionByName(found.withColumn("parent_conv_id", F.col("found")).select(*nodes.columns))


def sums_below(trees: DataFrame) -> DataFrame:
    """Sums over all trees that hang below each tree, itself included: grp, kids, leaves, saved.

    ``trees`` has grp, up (the tree it hangs on; null: the first one), kids, leaves, saved.
    Each round doubles the distance that is covered.
    """
    state = materialize(trees.select("grp", "kids", "leaves", "saved", "up"), "trees")
    while not state.where(F.col("up").isNotNull()).isEmpty():
        added = state.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("grp")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        onward = state.select(F.col("grp").alias("up"), F.col("up").alias("next"))
        state = materialize(
            state.join(added, "grp", "left").join(onward, "up", "left").select(
                "grp", "kids", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), F.col("next").alias("up"),
            ),
            "trees",
        )
    return state.drop("up")


def prefix_trie(turns: DataFrame, heads: int = 9, family: int = 5, length: int = SEGMENT, block_nodes: int = BLOCK_NODES, final_rows: int = FINAL_ROWS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, from the root without turns.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, as longs and a string. Turns are ordered by number, null
    first, equal numbers by the digest of role and text; repeated rows are turns of
    their own. Null roles and texts are empty. Rows without a conversation id are left
    out, a negative one belongs to the next lower multiple of ``family``. An empty table
    gives no rows. Other columns are not read.
    """
    parts = materialize(with_group(rebuilt(turns, heads, family, length)), "segments")
    after = F.md5(F.concat("grp", F.md5("seq")))
    by_row = parts.groupBy("grp", "seg", "seq").agg(
        F.first("sizes").alias("sizes"), F.count("*").alias("w"), F.min("conv_id").alias("m"), F.max("more").alias("more")
    )
    ends = ids_hashed(parts.where(~F.col("more")).select(F.concat(after, F.lit("/"), F.col("seg")).alias("name"), "conv_id").withColumnRenamed("name", "node"))
    rows = by_row.withColumn("after", after).withColumn("node", F.concat("after", F.lit("/"), F.col("seg"))).join(ends, "node", "left").drop("node")
    rows = materialize(rows.withColumn("first_depth", F.col("seg") * length), "rows")
    zero = F.lit(0).cast("long")
    above = rows.where("more").select(F.col("after").alias("grp"), F.col("m").alias("up_id"), F.when(F.col("grp") != "", F.col("grp")).alias("up"))
    if above.isEmpty():
        placed = rows.withColumns({"up_id": F.lit(None).cast("long"), "kids": zero, "leaves": zero, "saved": zero})
    else:
        placed = rows.join(above.select("grp", "up_id"), "grp", "left")
        going_on = placed.where(F.col("seg") > 0).withColumns({"kids": F.col("more").cast("long"), "leaves": zero, "saved": zero})
        trees = forest(going_on.select(*LEVEL_ROW), block_nodes, final_rows).where(F.col("kind") == "tree")
        own = trees.select(F.col("node").alias("grp"), F.col("n_children").alias("kids"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        below = sums_below(own.join(above.select("grp", "up"), "grp")).withColumnRenamed("grp", "after")
        placed = placed.join(below, "after", "left").withColumns({k: F.coalesce(k, zero) for k in ("kids", "leaves", "saved")})
    nodes = materialize(forest(placed.select(*LEVEL_ROW), block_nodes, final_rows), "nodes")
    return with_parents(nodes.where(F.col("kind") == "node")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


LEVEL_ROW = ("grp", "first_depth", "up_id", "seq", "sizes", "w", "m", "kids", "leaves", "saved", "ends")
