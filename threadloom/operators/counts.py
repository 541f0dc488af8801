"""Counts of a bounded vocabulary: only terms that can be in it are counted per document.

All n-grams of all documents are many times the input, and nearly all of them are rare. Every
task counts its own n-grams in memory and names its most used ones; a term none of them names
cannot be among the most used of all. What is written or shuffled is the named terms and, per document,
the counts of those few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.config import VocabConfig
from threadloom.session import discard, materialize

#: Terms a task names, as a multiple of the vocabulary's size.
NAMED = 2
#: N-grams that a task holds before it sums them up.
HELD = 1 << 23
#: Most candidates that are sent to all tasks.
CANDIDATES = 1_000_000


class _Words:
    """Numbers for the words of a task, in the order they come."""

    def __init__(self):
        self.number: dict[str, int] = {}

    def codes(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The row and the number of every token."""
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if coded.null_count or any(" " in w for w in words):
            raise NotPlain
        number = self.number
        known = np.array([number.setdefault(w, len(number)) for w in words] or [0], np.int64)
        return np.repeat(np.arange(len(sizes)), sizes), known[coded.indices.to_numpy()]


class NotPlain(Exception):
    """A token is null or holds a blank, so that an n-gram's words cannot be told from its text."""


def _keys(row: np.ndarray, code: np.ndarray, config: VocabConfig) -> np.ndarray:
    """One number per n-gram: a word's own, or both of a pair."""
    found = [code] if config.ngram_lo <= 1 else []
    if config.ngram_hi >= 2:
        side = row[1:] == row[:-1]
        found.append(((code[:-1] + 1) << 32 | code[1:])[side])
    return np.concatenate(found)


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    return ordered[first], np.diff(first, append=len(ordered))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


#: Kinds of rows of ``_used``: a term, the most a term that is not named can have, all n-grams, and a token that is not plain.
TERM, UNNAMED, ALL, ODD = range(4)


def _used(docs: DataFrame, config: VocabConfig, share: float | None = None) -> DataFrame:
    """(kind, term, tf) of every task: its most used terms, or those with at least a ``share`` of its n-grams."""
    most = NAMED * config.max_features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, parts, total = _Words(), [], [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0

        def rows(kind, terms, tf):
            return pa.RecordBatch.from_arrays([pa.array([kind] * len(terms), pa.int32()), pa.array(terms, pa.string()), pa.array(tf, pa.int64())], ["kind", "term", "tf"])

        def summed():
            parts[:] = [_merged([*parts, _runs(np.sort(np.concatenate(held)))])]
            held.clear()

        for batch in batches:
            try:
                held.append(_keys(*words.codes(batch.column(0)), config))
            except NotPlain:
                yield rows(ODD, [None], [1])
                return
            total += len(held[-1])
            if sum(map(len, held)) > HELD:
                summed()
        if held:
            summed()
        keys, tf = parts[0]
        if share is not None:
            named, rest = tf >= share * total, 0
        elif len(tf) > most:
            rest = int(np.partition(tf, len(tf) - most - 1)[len(tf) - most - 1])
            named = tf > rest
        else:
            named, rest = np.ones(len(tf), bool), 0
        names = list(words.number)
        terms = [names[k] if k < 1 << 32 else f"{names[(k >> 32) - 1]} {names[k & 0xFFFFFFFF]}" for k in keys[named].tolist()]
        yield rows(TERM, terms, tf[named])
        yield rows(UNNAMED, [None], [rest])
        yield rows(ALL, [None], [total])

    return docs.mapInArrow(run, "kind int, term string, tf bigint")


def _candidates(docs: DataFrame, config: VocabConfig, lowest: float, least: float | None) -> tuple[list[str], float] | None:
    """All terms used ``least`` times or more, and perhaps others; and that number.

    Without a given one it is such that the vocabulary is probably full with the terms above it; the
    caller checks that. None if the tokens are not plain or the candidates too many.

    What no task names comes up at most as often as the sum of the tasks' bounds. Where
    that is too much, a second pass names what has its share of a task's n-grams: a term
    below its share in every task is below ``least`` in all.
    """
    used = materialize(_used(docs, config), "used-terms")
    totals = {r["kind"]: r["n"] for r in used.where(F.col("kind") != TERM).groupBy("kind").agg(F.sum("tf").alias("n")).collect()}
    if ODD in totals:
        return None
    terms = used.where(F.col("kind") == TERM).groupBy("term").agg(F.sum("tf").alias("tf"))
    if least is None:
        wanted = config.max_features + config.max_features // 10
        top = terms.orderBy(F.desc("tf")).limit(wanted).agg(F.count(F.lit(1)).alias("n"), F.min("tf").alias("tf")).first()
        least = top["tf"] if top["n"] == wanted else 1
        least = max(least, int(np.ceil(lowest)), 1)
    unnamed = totals.get(UNNAMED, 0)
    if unnamed < least:
        found = terms.where(F.col("tf") + unnamed >= least).select("term")
    else:
        found = _used(docs, config, least / max(1, totals.get(ALL, 0)) * (1 - 1e-9)).where(F.col("kind") == TERM).select("term").distinct()
    rows = found.limit(CANDIDATES + 1).collect()
    discard(used)
    return (sorted(r["term"] for r in rows), least) if len(rows) <= CANDIDATES else None


def _cells(docs: DataFrame, id_col: str, terms: list[str], config: VocabConfig) -> DataFrame:
    """(id, indices, counts): places in ``terms`` of the n-grams of each row, ascending, and how often they come."""
    number: dict[str, int] = {}
    for w in (w for t in terms for w in t.split(" ")):
        number.setdefault(w, len(number))
    of_word = np.full(len(number) + 1, -1, np.int64)  # the last one stands for all other words
    pairs, of_pair = [], []
    for i, t in enumerate(terms):
        first, *second = (number[w] for w in t.split(" "))
        if second:
            pairs.append((first << 32) | second[0])
            of_pair.append(i)
        else:
            of_word[first] = i
    order = np.argsort(np.array(pairs, np.int64))
    shared = docs.sparkSession.sparkContext.broadcast((number, of_word, np.array(pairs, np.int64)[order], np.array(of_pair, np.int64)[order]))
    n_terms = len(terms)
    single, double = config.ngram_lo <= 1, config.ngram_hi >= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, of_word, pairs, of_pair = shared.value
        none = len(number)
        for batch in batches:
            ids, lists = batch.columns
            sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            coded = lists.flatten().dictionary_encode()
            known = np.array([number.get(w, none) for w in coded.dictionary.to_pylist()] or [none], np.int64)
            code, row = known[coded.indices.to_numpy()], np.repeat(np.arange(len(sizes)), sizes)
            found = []
            if single:
                term = of_word[code]
                found.append((row * n_terms + term)[term >= 0])
            if double and len(pairs):
                both = np.flatnonzero((row[1:] == row[:-1]) & (code[1:] < none) & (code[:-1] < none))
                key = code[both] << 32 | code[both + 1]
                at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
                hit = pairs[at] == key
                found.append(row[both[hit]] * n_terms + of_pair[at[hit]])
            cell, times = _runs(np.sort(np.concatenate(found or [np.zeros(0, np.int64)])))
            some, width = _runs(cell // n_terms)
            ends = pa.array(np.concatenate([[0], np.cumsum(width)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(some)), pa.ListArray.from_arrays(ends, pa.array(cell % n_terms, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))],
                ["_id", "indices", "counts"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.mapInArrow(run, f"_id {kind}, indices array<int>, counts array<int>").withColumnRenamed("_id", id_col)


def long_cells(cells: DataFrame, id_col: str) -> DataFrame:
    return cells.select(id_col, F.inline(F.arrays_zip("indices", "counts")))


def by_document(cells: DataFrame, id_col: str) -> DataFrame:
    """One row per document: the counts of repeated ids, null too, are added up."""
    again = cells.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(id_col).alias("_id"))
    if again.isEmpty():
        return cells
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    sums = long_cells(cells.join(again, same, "left_semi"), id_col).groupBy(id_col, "indices").agg(F.sum("counts").cast("int").alias("counts"))
    one = F.array_sort(F.collect_list(F.struct("indices", "counts")))
    added = sums.groupBy(id_col).agg(one.alias("_c")).select(id_col, F.col("_c.indices").alias("indices"), F.col("_c.counts").alias("counts"))
    return cells.join(again, same, "left_anti").unionByName(added)


def _renumbered(cells: DataFrame, id_col: str, number: np.ndarray) -> DataFrame:
    """The cells of the terms that have a new number (others have -1), ascending; documents without one go."""
    shared = cells.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, indices, counts = batch.columns
            row = np.repeat(np.arange(len(ids)), np.diff(indices.offsets.to_numpy()))
            term = shared.value[indices.flatten().to_numpy()]
            kept = np.flatnonzero(term >= 0)
            kept = kept[np.lexsort((term[kept], row[kept]))]
            some, width = _runs(row[kept])
            ends = pa.array(np.concatenate([[0], np.cumsum(width)]), pa.int32())
            lists = (term[kept].astype(np.int32), counts.flatten().to_numpy()[kept])
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(some)), *(pa.ListArray.from_arrays(ends, pa.array(x)) for x in lists)], [id_col, "indices", "counts"])

    return cells.mapInArrow(run, cells.schema)


def fit_counts(docs: DataFrame, id_col: str, tokens: Column | str, choose, config: VocabConfig) -> tuple[DataFrame, DataFrame] | None:
    """The vocabulary and (id, indices, counts), the counts of its terms in every document that has one.

    ``choose`` makes the vocabulary (with ``term`` and ``term_id``) of (term, df, tf) rows; what it cannot
    choose is left out here. ``docs`` is read by several passes, so it should be a table. None
    where this way does not apply: more than two words a term, tokens that are null or hold
    a blank, more candidates than are sent to all tasks.
    """
    if config.ngram_hi > 2 or config.ngram_lo < 1:
        return None
    spark = docs.sparkSession
    toks = F.col(tokens) if isinstance(tokens, str) else tokens
    data = docs.select(id_col, toks.alias("_tokens"))
    lowest = config.min_df * data.count() if 0 < config.min_df < 1 else config.min_df
    least = None
    while True:
        if (found := _candidates(data.select("_tokens"), config, lowest, least)) is None:
            return None
        terms, least = found
        made = materialize(_cells(data, id_col, terms, config), "candidate-counts")
        cells = by_document(made, id_col)
        if cells is not made:
            cells = materialize(cells, "document-counts")
            discard(made)
        sums = long_cells(cells, id_col).groupBy("indices").agg(F.count(F.lit(1)).alias("df"), F.sum("counts").alias("tf"))
        named = spark.createDataFrame(list(enumerate(terms)), "indices int, term string")
        vocab = materialize(choose(sums.join(F.broadcast(named), "indices").where(F.col("tf") >= least).select("term", "df", "tf")), "vocabulary")
        chosen = {r["term"]: r["term_id"] for r in vocab.select("term", "term_id").collect()}
        if len(chosen) >= config.max_features or least <= max(1, lowest):
            break
        least = max(1, int(np.ceil(lowest)), least // 4)
        discard(cells, vocab)
    number = np.array([chosen.get(t, -1) for t in terms] or [-1], np.int64)
    counts = materialize(_renumbered(cells, id_col, number), "document-terms")
    discard(cells)
    return vocab, counts


def tfidf_values(sizes: np.ndarray, cols: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Sublinear tf times idf, documents of length one; all cells one after the other."""
    w = (1.0 + np.log(counts)) * idf[cols]
    some = np.flatnonzero(sizes)
    squares = np.zeros(len(sizes))
    if len(some):
        squares[some] = np.add.reduceat(w * w, (np.cumsum(sizes) - sizes)[some])
    return w / np.repeat(np.sqrt(squares), sizes)


def weighted_rows(cells: DataFrame, id_col: str, idf: np.ndarray) -> DataFrame:
    """(id, indices, values): the TF-IDF rows of counted documents, one narrow pass."""
    shared = cells.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, indices, counts = batch.columns
            offsets = indices.offsets
            cols = indices.flatten()
            values = tfidf_values(np.diff(offsets.to_numpy()), cols.to_numpy(), counts.flatten().to_numpy().astype(float), shared.value)
            yield pa.RecordBatch.from_arrays([ids, indices, pa.ListArray.from_arrays(offsets, pa.array(values))], [id_col, "indices", "values"])

    kind = cells.schema[id_col].dataType.simpleString()
    return cells.select(id_col, "indices", "counts").mapInArrow(run, f"`{id_col}` {kind}, indices array<int>, values array<double>")
