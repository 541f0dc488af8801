"""Near duplicates by 64-bit similarity fingerprints, joined through tables of pivot distances.

Every fingerprint gets its Hamming distances to a set of fixed reference fingerprints,
part by part: the bits are cut into parts, and a distance is kept per part and
reference. A distance to a reference differs between two fingerprints by no more than
they differ themselves. So of two fingerprints that differ in ``most`` bits

* the parts without a differing bit, all but ``most`` of them at least, have equal
  distances: rows meet by the distances of every choice of so many parts, and pairs
  whose coordinates differ in each choice are never formed;
* no whole distance (the sum over the parts) differs by more than ``most``: pairs with a
  larger coordinate difference are discarded;
* the survivors are verified by their own bits.

Rows are distinct fingerprints. Rows that meet are not paired at once: each is held
against one of its meeting place first, links found so join rows into components, and
only pairs between different components are formed then, in square blocks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.graph import components
from threadloom.llm.shared import id_and_text, pieces_of, raw_texts
from threadloom.session import materialize

WORDS = 4
SEED = 42
#: Fingerprints link when they differ in so many bits at most.
MOST_BITS = 4
#: References per part; with fewer, unequal parts would often have equal distances.
REFERENCES = 12
#: Rows that may meet by chance in one place, on average, before the bits are cut into more parts.
MEETING = 64
#: Rounds with one partner per place before the rest is paired in blocks of this many rows a side.
ROUNDS = 3
BLOCK = 512
#: Pairs between components per row up to which they are formed at once.
FEW = 64
#: Fingerprints of more than one document in so many get their component by broadcast.
SHARE = 1000


def fingerprint(raw: bytes | None, size: int = WORDS) -> int:
    """Bit by bit, what more than half of the hashes of a text's word shingles have set; zero without words.

    Repeated shingles count again; all words are one shingle if there are fewer. A-Z is
    lower-cased; words are cut at space and tab to carriage return.
    """
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    size = min(size, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, bits) per document; bits as a signed long."""
    def run(batches):
        for batch in batches:
            for part in pieces_of(batch):
                found = np.array([fingerprint(t, size) for t in raw_texts(part)], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")), pa.array(found)], ["doc_id", "bits"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, bits long")


def references(count: int = REFERENCES) -> list[int]:
    """Fixed reference fingerprints: hashes of their numbers, as signed longs."""
    return [xxhash.xxh64_intdigest(str(i).encode(), SEED) - (1 << 63) for i in range(count)]


def part_masks(parts: int) -> list[int]:
    """The bits of each part, as signed longs; sizes differ by one bit at most."""
    edges = [64 * i // parts for i in range(parts + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def parts_for(rows: int, most: int = MOST_BITS) -> int:
    """So many parts that few unlike rows have equal distances in all but ``most`` of them."""
    parts = most + 2
    while parts < 4 * most and rows > MEETING * 2.0 ** (64 * (parts - most) / parts):
        parts += 1
    return parts


def with_distances(rows: DataFrame, parts: int) -> DataFrame:
    """Add the pivot tables: ``near`` holds the distances of each part, ``whole`` their sums."""
    masks = part_masks(parts)
    near = [F.array(*[F.bit_count((F.col("bits").bitwiseXOR(F.lit(r))).bitwiseAND(F.lit(m))).cast("byte") for r in references()]) for m in masks]
    whole = F.array(*[F.bit_count(F.col("bits").bitwiseXOR(F.lit(r))).cast("byte") for r in references()])
    return rows.withColumn("near", F.array(*near)).withColumn("whole", whole)


def meeting_places(rows: DataFrame, parts: int, most: int) -> DataFrame:
    """One row per fingerprint and choice of parts: place (the distances there, hashed), choice, bits, whole."""
    choices = list(combinations(range(parts), parts - most))
    place = F.array(*[
        F.struct(F.lit(i).cast("short").alias("choice"), F.xxhash64(F.lit(i), *[F.col("near")[p] for p in chosen]).alias("place"))
        for i, chosen in enumerate(choices)
    ])
    return rows.select("bits", "whole", F.explode(place).alias("at")).select("at.place", "at.choice", "bits", "whole")


def within(a: str, b: str, most: int) -> Column:
    """No coordinate of the pivot tables differs by more than ``most``, then the bits themselves."""
    far = [F.abs(F.col(f"{a}_whole")[i] - F.col(f"{b}_whole")[i]) for i in range(REFERENCES)]
    coordinates = F.greatest(*far) <= most
    return coordinates & (F.bit_count(F.col(f"{a}_bits").bitwiseXOR(F.col(f"{b}_bits"))) <= most)


def head_links(rows: DataFrame, turn: int, most: int) -> DataFrame:
    """Links (a, b) between each row of a place and the place's head of this turn."""
    heads = rows.groupBy("place").agg(F.min(F.struct(F.xxhash64("bits", F.lit(turn)).alias("r"), "bits", "whole")).alias("h"), F.count("*").alias("c"))
    heads = heads.where(F.col("c") > 1).select("place", F.col("h.bits").alias("b_bits"), F.col("h.whole").alias("b_whole"))
    own = rows.select("place", F.col("bits").alias("a_bits"), F.col("whole").alias("a_whole"))
    met = own.join(heads, "place").where((F.col("a_bits") != F.col("b_bits")) & within("a", "b", most))
    return met.select(F.col("a_bits").alias("a"), F.col("b_bits").alias("b")).distinct()


def block_links(rows: DataFrame, most: int) -> DataFrame:
    """Links (a, b) between rows of a place that lie in different components, formed in square blocks."""
    sides = rows.groupBy("place").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("bits", F.lit("block")), F.col("blocks")).cast("int")
    sized = rows.join(sides, "place")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    held = [F.col("bits"), F.col("whole"), F.col("component")]
    left = sized.withColumn("i", own).withColumn("j", every).select("place", "i", "j", *[c.alias(f"a_{n}") for c, n in zip(held, ("bits", "whole", "component"))])
    right = sized.withColumn("j", own).withColumn("i", every).select("place", "i", "j", *[c.alias(f"b_{n}") for c, n in zip(held, ("bits", "whole", "component"))])
    met = left.join(right, ["place", "i", "j"]).where((F.col("a_component") < F.col("b_component")) & within("a", "b", most))
    return met.select(F.col("a_bits").alias("a"), F.col("b_bits").alias("b")).distinct()


def open_rows(rows: DataFrame, label: DataFrame) -> DataFrame:
    """The rows of places that still hold more than one component, with their component."""
    labelled = rows.drop("component").join(label.withColumnRenamed("node", "bits"), "bits", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "bits"))
    mixed = labelled.groupBy("place").agg(F.min("component").alias("_a"), F.max("component").alias("_b"))
    return labelled.join(mixed.where(F.col("_a") != F.col("_b")).select("place"), "place", "left_semi")


def few_pairs(rows: DataFrame) -> bool:
    """Whether pairs between components are at most ``FEW`` times the rows."""
    parts = rows.groupBy("place", "component").agg(F.count("*").cast("double").alias("c"))
    sums = parts.groupBy("place").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
    row = sums.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2).alias("pairs"), F.sum("s").alias("n")).first()
    return (row["pairs"] or 0) <= FEW * (row["n"] or 0)


def fingerprint_links(distinct: DataFrame, most: int = MOST_BITS, parts: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Links (a, b) that join all fingerprints of ``distinct`` (bits) differing in ``most`` bits at most.

    Links inside a component that is already joined are left out.
    """
    parts = parts or parts_for(distinct.count(), most)
    rows = materialize(meeting_places(with_distances(distinct, parts), parts, most), "places")
    links = materialize(head_links(rows, 0, most), "links")
    for turn in range(1, rounds + 1):
        rows = materialize(open_rows(rows, components(links)), "open")
        if rows.isEmpty():
            break
        last = turn == rounds or few_pairs(rows)
        new = block_links(rows, most) if last else head_links(rows, turn, most)
        links = materialize(links.unionByName(new).distinct(), "links")
        if last:
            break
    return links


def fingerprint_groups(docs: DataFrame, size: int = WORDS, most: int = MOST_BITS, id_col: str = "doc_id", text_col: str = "text",
                       parts: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Per row its fingerprint and the smallest id that links reach: doc_id, fingerprint, component_id.

    One row per input row. Texts without words, null ones among them, have the
    fingerprint zero and link like others. Equal fingerprints are one row of the join,
    however many documents have them. Null ids take part, but name no component; a
    component without any id gets null. Empty tables give no rows. Other columns are not read.
    """
    found = materialize(fingerprints(docs, size, id_col, text_col), "fingerprints")
    classes = materialize(found.groupBy("bits").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")), "classes")
    label = components(fingerprint_links(classes.select("bits"), most, parts, rounds))
    named = classes.join(label.withColumnRenamed("node", "bits"), "bits", "left").withColumn("component", F.coalesce("component", "bits"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_bits = materialize(named.select("bits", "component", "copies").join(least, "component").select("bits", "copies", "component_id"), "labels")
    return with_labels(found, by_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def with_labels(found: DataFrame, labels: DataFrame) -> DataFrame:
    """Hand every row the label of its fingerprint.

    Fingerprints of more than one row in ``SHARE`` (so there are fewer than ``SHARE``
    of them) are broadcast, the others joined by a shuffle.
    """
    least = (labels.agg(F.sum("copies").alias("n")).first()["n"] or 0) / SHARE
    labels, often = labels.select("bits", "component_id", "copies"), F.col("copies") > least
    hot = F.broadcast(labels.where(often).select("bits", F.lit(True).alias("hot"), F.col("component_id").alias("hot_id")))
    marked = found.join(hot, "bits", "left")
    frequent = marked.where("hot").select("doc_id", "bits", F.col("hot_id").alias("component_id"))
    rest = marked.where(F.col("hot").isNull()).select("doc_id", "bits").join(labels.where(~often).select("bits", "component_id"), "bits")
    return frequent.unionByName(rest.select("doc_id", "bits", "component_id"))
