"""Near duplicates: a blocked sparse product of documents by word shingles.

Rows of the matrix are distinct shingle sets, columns are shingles. Two sets can
only be similar enough if they meet in a column among the first few of both, under
one order of all columns; so only these entries of the matrix are multiplied. The
order puts columns that hold many documents last: a sketch of all shingles, of
fixed size, tells roughly how many each holds.

Overlap counts of two rows are summed over the columns of the product; pairs that
cannot reach the overlap that their sizes ask for are dropped; the full overlap of
the others is counted. A parity signature of each set bounds the overlap of two sets
as well, and is compared first.

The product is not made from all pairs of a column. First each entry meets one
pivot of its column (and size class); links found so join rows into components.
Then only pairs of rows from different components are left to multiply: a few
more rounds with other pivots, and in the end all of these pairs, in square blocks.
No link between different components can be lost, and a group of a million near
copies costs a million pairs rather than their square.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.fingerprints import WordHashes, runs
from threadloom.llm.graph import components
from threadloom.llm.shared import id_and_text, kept_in_worker, pieces_of, raw_texts
from threadloom.session import materialize

WORDS = 5
#: Two sets link when 100 * intersection >= LEAST * union.
LEAST = 80
#: Cells of the sketch that orders the columns; one byte each is broadcast.
SKETCH_BITS = 21
SKETCH_BLOCK = 1 << 16
#: Rounds with pivots before the remaining pairs are multiplied in blocks of this many entries a side.
PIVOT_ROUNDS = 3
BLOCK = 512
#: Pairs across components per entry up to which they are multiplied at once.
FEW = 256
#: Words of 64 bits in the parity signature of a set.
PARITY = 8
#: Ids up to this many are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def shingle_set(text: bytes | None, hashes: WordHashes, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; all words as one run if there are fewer."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(runs(hashes.of(words), min(size, len(words))))


def signature(found: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def parity(found: np.ndarray) -> np.ndarray:
    """Per cell of a small table whether an odd number of shingles falls into it, as signed 64-bit words.

    The signatures of two sets differ in no more bits than there are shingles in only
    one of the sets, which bounds their overlap from above.
    """
    counts = np.bincount((found & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def profiles(docs: DataFrame, size: int, bits: int) -> tuple[DataFrame, bytes]:
    """One row (doc_id, text_id, n, sig, parity) per document, and the sketch of all columns.

    Both come from one reading of the texts. Each task adds up its shingles in an
    array of fixed size and hands on the cells that are not zero; the cells of a
    range meet in one task, which adds one byte each to the result: the logarithm
    of the count.
    """
    schema = "doc_id long, text_id long, n long, sig long, parity array<long>, block int, cells binary, counts binary"

    names = ["doc_id", "text_id", "n", "sig", "parity", "block", "cells", "counts"]

    def run(batches):
        hashes = kept_in_worker("words", WordHashes)
        sketch = np.zeros(1 << bits, dtype=np.uint32)
        for batch in batches:
            for part in pieces_of(batch):
                sets = [shingle_set(t, hashes, size) for t in raw_texts(part)]
                cells = np.concatenate(sets) >> np.uint64(64 - bits)
                sketch += np.bincount(cells.astype(np.int64), minlength=1 << bits).astype(np.uint32)
                n = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("doc_id")), part.column(part.schema.get_field_index("text_id")),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([signature(s) for s in sets], pa.int64()),
                     pa.array([parity(s) for s in sets], pa.list_(pa.int64())), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                     pa.nulls(n, pa.binary())],
                    names,
                )
        for block in range(0, len(sketch), SKETCH_BLOCK):
            part = sketch[block : block + SKETCH_BLOCK]
            full = np.flatnonzero(part)
            if len(full):
                yield pa.RecordBatch.from_arrays(
                    [*[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.list_(pa.int64())), pa.array([block // SKETCH_BLOCK], pa.int32()),
                     pa.array([full.astype("<u2").tobytes()], pa.binary()), pa.array([part[full].astype("<u4").tobytes()], pa.binary())],
                    names,
                )

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                total = totals.setdefault(block, np.zeros(SKETCH_BLOCK, dtype=np.uint64))
                total[np.frombuffer(cells, dtype="<u2")] += np.frombuffer(counts, dtype="<u4")
        for block, total in totals.items():
            logs = np.log2(total.astype(np.float64) + 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([logs.tobytes()], pa.binary())], ["block", "logs"])

    both = materialize(docs.mapInArrow(run, schema), "profiles")
    blocks = max(1, (1 << bits) // SKETCH_BLOCK)
    summed = both.where(F.col("block").isNotNull()).select("block", "cells", "counts").repartition(blocks, "block").mapInArrow(add, "block int, logs binary")
    sketch = bytearray(1 << bits)
    for row in summed.collect():
        at = row["block"] * SKETCH_BLOCK
        sketch[at : at + SKETCH_BLOCK] = row["logs"]
    return both.where(F.col("block").isNull()).select("doc_id", "text_id", "n", "sig", "parity"), bytes(sketch)


def first_columns(docs: DataFrame, sketch: bytes, size: int, least: int, bits: int) -> DataFrame:
    """The entries of the matrix that take part: column, sig, n, place.

    Of n columns in order, the first n - ceil(least * n / 100) + 1. A set that a
    task has seen before is not repeated by it, so copies are reduced before the
    shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches):
        hashes = kept_in_worker("words", WordHashes)
        logs = np.frombuffer(sent.value, dtype=np.uint8)
        seen: set[int] = set()
        for batch in batches:
            for part in pieces_of(batch):
                columns, sigs, sizes, places = [], [], [], []
                for text in raw_texts(part):
                    found = shingle_set(text, hashes, size)
                    n = len(found)
                    sig = signature(found)
                    if n == 0 or sig in seen:
                        continue
                    if len(seen) >= 1 << 20:
                        seen.clear()
                    seen.add(sig)
                    order = np.argsort((logs[found >> np.uint64(64 - bits)].astype(np.uint64) << np.uint64(56)) | (found >> np.uint64(8)), kind="stable")
                    taken = n - -(-least * n // 100) + 1
                    columns.append(found[order[:taken]])
                    sigs.append(np.full(taken, sig, dtype=np.int64))
                    sizes.append(np.full(taken, n, dtype=np.int32))
                    places.append(np.arange(taken, dtype=np.int32))
                if columns:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(columns).view(np.int64)), pa.array(np.concatenate(sigs)), pa.array(np.concatenate(sizes)),
                         pa.array(np.concatenate(places))],
                        ["column", "sig", "n", "place"],
                    )

    return docs.mapInArrow(run, "column long, sig long, n int, place int")


def needed(n: Column, m: Column, least: int) -> Column:
    """The overlap that two sets of these sizes must reach: 100 o >= least (n + m - o)."""
    return F.ceil(least * (n + m) / (100 + least))


def taken(n: Column, least: int) -> Column:
    return n - F.ceil(least * n / 100) + 1


def with_size_group(entries: DataFrame, least: int) -> DataFrame:
    """Each entry in two groups of sizes, so that any two sets of fitting sizes share one."""
    class_of = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / least)) + 1e-9).cast("int")
    return entries.withColumn("class", class_of).withColumn("size_group", F.explode(F.array(F.col("class"), F.col("class") + 1)))


def few_differences(nx: Column, px: Column, ny: Column, py: Column, least: int) -> Column:
    """Whether two parity signatures differ in no more bits than sets of these sizes may."""
    bits = [F.bit_count(px[i].bitwiseXOR(py[i])) for i in range(PARITY)]
    return sum(bits[1:], bits[0]) <= nx + ny - 2 * needed(nx, ny, least)


def promising(product: DataFrame, least: int) -> DataFrame:
    """Sum the overlap counts of pairs over all columns; drop those below what their sizes ask for.

    ``product`` has one row per pair and column: x, nx, ix, y, ny, iy (i: place).
    """
    x, y = F.col("nx"), F.col("ny")
    in_column = F.least("ix", "iy") + 1 + F.least(x - F.col("ix"), y - F.col("iy")) - 1
    fits = product.where((least * F.greatest("nx", "ny") <= 100 * F.least("nx", "ny")) & (in_column >= needed(x, y, least)))
    turned = fits.select(
        F.when(F.col("x") < F.col("y"), F.struct("x", "nx", "y", "ny")).otherwise(F.struct(F.col("y").alias("x"), F.col("ny").alias("nx"), F.col("x").alias("y"), F.col("nx").alias("ny"))).alias("p")
    ).select("p.*")
    summed = turned.groupBy("x", "nx", "y", "ny").agg(F.count("*").alias("common"))
    beyond = F.greatest(x - taken(x, least), y - taken(y, least))
    return summed.where(F.col("common") + beyond >= needed(x, y, least))


def pivot_pairs(entries: DataFrame, turn: int, least: int) -> DataFrame:
    """Each entry of a column and size group with the group's pivot of this turn.

    The first pivot is the row in which the column comes earliest: a text that others
    were made from holds fewer rare columns before it than they do.
    """
    early = F.col("place") if turn == 0 else F.lit(0)
    pivots = entries.groupBy("column", "size_group").agg(
        F.min(F.struct(early.alias("e"), F.xxhash64(F.col("sig"), F.lit(turn)).alias("r"), "sig", "n", "place", "class")).alias("v")
    )
    joined = entries.join(pivots, ["column", "size_group"]).where(
        (F.col("sig") != F.col("v.sig")) & (F.greatest("class", "v.class") == F.col("size_group"))
    )
    return joined.select(
        F.col("sig").alias("x"), F.col("n").alias("nx"), F.col("place").alias("ix"),
        F.col("v.sig").alias("y"), F.col("v.n").alias("ny"), F.col("v.place").alias("iy"),
    )


def block_pairs(entries: DataFrame, parities: DataFrame, least: int) -> DataFrame:
    """The pairs of a column and size group that lie in different components, made in square blocks.

    Pairs whose parity signatures differ too much are not handed on.
    """
    key = ["column", "size_group"]
    sides = entries.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int")
    sized = entries.join(parities, "sig").join(sides, key)
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    names = {"sig": "x", "n": "nx", "place": "ix", "class": "cx", "component": "kx", "parity": "px"}
    left = sized.withColumn("i", own).withColumn("j", every).select(*key, "i", "j", *[F.col(a).alias(b) for a, b in names.items()])
    right = sized.withColumn("j", own).withColumn("i", every).select(*key, "i", "j", *[F.col(a).alias(b.replace("x", "y")) for a, b in names.items()])
    return left.join(right, [*key, "i", "j"]).where(
        (F.col("kx") < F.col("ky")) & (F.greatest("cx", "cy") == F.col("size_group"))
        & (least * F.greatest("nx", "ny") <= 100 * F.least("nx", "ny"))
        & few_differences(F.col("nx"), F.col("px"), F.col("ny"), F.col("py"), least)
    ).select("x", "nx", "ix", "y", "ny", "iy")


def alike(pairs: DataFrame, parities: DataFrame, least: int) -> DataFrame:
    """The pairs whose parity signatures do not rule them out."""
    left = pairs.join(parities.select(F.col("sig").alias("x"), F.col("parity").alias("px")), "x")
    both = left.join(parities.select(F.col("sig").alias("y"), F.col("parity").alias("py")), "y")
    return both.where(few_differences(F.col("nx"), F.col("px"), F.col("ny"), F.col("py"), least)).select("x", "nx", "y", "ny")


def sets_of(docs: DataFrame, names: DataFrame, size: int) -> DataFrame:
    """The whole sets (sig, found) of the documents in ``names`` (rep_id, rep_text, sig)."""
    few = names.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    same = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_id") == F.col("rep_text"))
    picked = docs.join(F.broadcast(names) if few else names, same).select("sig", "text")

    def run(batches):
        hashes = kept_in_worker("words", WordHashes)
        for batch in batches:
            for part in pieces_of(batch):
                found = [shingle_set(t, hashes, size).tobytes() for t in raw_texts(part)]
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("sig")), pa.array(found, pa.binary())], ["sig", "found"])

    return picked.mapInArrow(run, "sig long, found binary")


def links_of(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose whole overlap is large enough."""
    left = pairs.select("x", "y").join(sets.select(F.col("sig").alias("x"), F.col("found").alias("fx")), "x")
    both = left.join(sets.select(F.col("sig").alias("y"), F.col("found").alias("fy")), "y").select("x", "y", "fx", "fy")

    def run(batches):
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for fx, fy in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(fx.as_buffer(), dtype=np.uint64), np.frombuffer(fy.as_buffer(), dtype=np.uint64)
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= least * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, k in zip(a, keep) if k], pa.int64()), pa.array([v for v, k in zip(b, keep) if k], pa.int64())], ["a", "b"]
            )

    return both.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = WORDS, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text",
                    bits: int = SKETCH_BITS, rounds: int = PIVOT_ROUNDS, with_first: bool = False) -> DataFrame:
    """Per row its number of shingles and the smallest id that links reach: doc_id, n_shingles, component_id.

    One row per input row. Texts without words, null ones among them, have no
    shingles and reach only themselves. Equal sets are one class, however many
    documents share it; null ids take part, but never name a component that has
    another id. Repeated rows are members of one class. Empty tables give no rows.
    Other columns are not read. ``with_first`` adds is_first: whether the row's id and text
    are the first ones that links reach, by id (null last), then by a hash of the text; and
    text_id, that hash.
    """
    picked = id_and_text(docs, id_col, text_col).withColumn("text_id", F.xxhash64("text"))
    profile, sketch = profiles(picked, size, bits)
    postings = materialize(first_columns(picked, sketch, size, least, bits), "postings")
    shared = postings.groupBy("column").agg(F.count("*").alias("c")).where(F.col("c") > 1).select("column")
    entries = materialize(with_size_group(postings.join(shared, "column"), least).distinct(), "entries")
    full = profile.where(F.col("n") > 0)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id"))
    classes = full.groupBy("sig").agg(first.alias("r")).select("sig", F.col("r.doc_id").alias("doc_id"), F.col("r.text_id").alias("rep_text"))
    parities = full.groupBy("sig").agg(F.first("parity").alias("parity"))
    links = None
    for turn in range(rounds + 1):
        if turn == 0:
            product = pivot_pairs(entries, 0, least)
        else:
            label = components(links)
            open_entries = cross_entries(entries, label)
            entries = materialize(open_entries, "entries")
            if entries.isEmpty():
                break
            if turn == rounds or few_pairs(entries):
                turn = rounds
                product = block_pairs(entries, parities, least)
            else:
                product = pivot_pairs(entries, turn, least)
            entries = entries.drop("component")
        pairs = materialize(alike(promising(product, least), parities, least), "pairs")
        new = materialize(links_of(pairs, picked_sets(picked, pairs, classes, size), least), "links")
        links = new if links is None else links.unionByName(new)
        if turn == rounds:
            break
    named = classes.select(F.col("sig").alias("node"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rep_text").alias("own"))
    names = components(links).join(named, "node")
    least_id = names.groupBy("component").agg(F.min("own").alias("first"))
    reached = names.join(least_id, "component").select(F.col("node").alias("sig"), "first")
    own = named.withColumnRenamed("node", "sig")
    by_sig = own.join(reached, "sig", "left").select("sig", F.coalesce("first", "own").alias("first"))
    alone = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("text_id").alias("rep_text"))
    found = profile.join(by_sig, "sig", "left").withColumn("first", F.when(F.col("n") > 0, F.col("first")).otherwise(alone))
    result = [F.col("doc_id"), F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id")]
    if with_first:
        same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.col("text_id").eqNullSafe(F.col("first.rep_text"))
        result += [same.alias("is_first"), "text_id"]
    return found.select(*result)


def picked_sets(docs: DataFrame, pairs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """The sets that the pairs name, computed once."""
    named = pairs.select(F.col("x").alias("sig")).unionByName(pairs.select(F.col("y").alias("sig"))).distinct()
    return materialize(sets_of(docs, materialize(classes.join(named, "sig").withColumnRenamed("doc_id", "rep_id"), "names"), size).dropDuplicates(["sig"]), "sets")


def cross_entries(entries: DataFrame, label: DataFrame) -> DataFrame:
    """The entries of columns that still hold more than one component, with their component."""
    labelled = entries.join(label.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    mixed = labelled.groupBy("column", "size_group").agg(F.min("component").alias("_a"), F.max("component").alias("_b"))
    return labelled.join(mixed.where(F.col("_a") != F.col("_b")).select("column", "size_group"), ["column", "size_group"])


def few_pairs(entries: DataFrame) -> bool:
    """Whether the pairs across components are at most ``FEW`` times the entries."""
    parts = entries.groupBy("column", "size_group", "component").agg(F.count("*").cast("double").alias("c"))
    sums = parts.groupBy("column", "size_group").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
    row = sums.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2).alias("pairs"), F.sum("s").alias("n")).first()
    return (row["pairs"] or 0) <= FEW * (row["n"] or 0)
