"""Quality classifier by co-training.

Two views see the same document: its words (relative frequencies of hashed words and
a few ratios) and its metadata (language, source, size and layout). Each view has a
logistic model. In every round each model scores all unlabelled documents and labels
those that it is surest of, for the other one to learn from. In the end both are
calibrated on labelled documents that took no part in the training, and the calibrated
views are combined by a small logistic model.

Only the labelled documents of the fit are a sample, of stated size, drawn in the order
of a hash of the id. The unlabelled ones all take part: tasks count their scores in bins,
the bounds of the surest share of each class are read from the counts, and tasks add up
the features of the documents beyond the bounds, per class and stratum (languages and
sources by a hash). What a view learns from are the labelled rows and these means. Counts
and sums are integers, so neither the order of rows nor their partitions changes the model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.shared import pieces_of, raw_texts
from threadloom.session import scratch_path

#: Labelled documents that the fit may use, at most.
LABELLED = 4000
#: Cells of hashed words and of metadata; rounds; share of the unlabelled documents that a view labels more in each round; least surety.
WORD_CELLS = 1 << 14
META_CELLS = 1 << 11
ROUNDS = 4
SHARE = 0.05
SURE = 0.9
#: What the documents a view was taught weigh together, beside the labelled ones, after the first round and per round.
TRUST = 0.07
#: Strata of documents whose features are added up apart; parts of a sum that travel together; salts of the first merge.
STRATA = 4
BLOCK = 1 << 11
SALTS = 256
#: Scores (log-odds) are counted in bins of this width between -EDGE and EDGE.
BIN = 1 / 64
EDGE = 40
#: Features are added up as whole numbers of this unit.
UNIT = 1 << 20
#: Share of labelled documents for calibration, and of good ones there that must be kept.
HELD_OUT = 0.3
KEEP_GOOD = 0.995

UPPER = bytes(range(65, 91))
MARKS = b"#*$%&|<>!{}[]=@^~"
RATIOS = 7


def cell(name: bytes, cells: int) -> int:
    return xxhash.xxh3_64_intdigest(name) % cells


def ratios(text: bytes, words: list[bytes]) -> list[float]:
    """What the words look like, each about between 0 and 1."""
    n = max(len(words), 1)
    size = max(len(text), 1)
    lines = text.split(b"\n")
    return [
        len(set(words)) / n,
        len(text.translate(None, UPPER)) / size,
        len(text.translate(None, MARKS)) / size,
        min(len(text) / n, 40) / 40,
        len(set(lines)) / len(lines),
        min(n, 50) / 50,
        1.0,
    ]


def meta_names(lang, source, n_chars, text: bytes) -> list[bytes]:
    """Metadata as names of cells; null is a value like any other."""
    size = len(text) if n_chars is None else int(n_chars)
    lines = text.count(b"\n") + 1
    lang, source = str(lang).encode(), str(source).encode()
    return [
        b"lang " + lang, b"source " + source, b"both " + lang + b" " + source,
        b"size %d" % int(2 * np.log2(max(size, 0) + 1)), b"lines %d" % int(2 * np.log2(lines)),
        b"line %d" % int(2 * np.log2(size / lines + 1 if size > 0 else 1)), b"bias",
    ]


@dataclass
class Rows:
    """Sparse rows: row starts, cells and values, and dense columns."""

    starts: np.ndarray
    cells: np.ndarray
    values: np.ndarray
    dense: np.ndarray

    def pick(self, rows: np.ndarray) -> "Rows":
        sizes = np.diff(self.starts)[rows]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Rows(starts, self.cells[at], self.values[at], self.dense[rows])


@dataclass
class Linear:
    weights: np.ndarray
    dense: np.ndarray

    def score(self, rows: Rows) -> np.ndarray:
        n = len(rows.starts) - 1
        row_of = np.repeat(np.arange(n), np.diff(rows.starts))
        return np.bincount(row_of, weights=rows.values * self.weights[rows.cells], minlength=n) + (rows.dense * self.dense).sum(axis=1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_linear(rows: Rows, labels: np.ndarray, mass: np.ndarray, cells: int, steps: int = 120, rate: float = 0.5, decay: float = 1e-4) -> Linear:
    """Logistic regression on rows of a given mass, both classes of equal weight; adaptive steps from zero.

    Steps of cells start small, so that a word of a single document can't take a large weight.
    """
    total = mass.sum()
    share = np.clip((labels * mass).sum() / total, 0.02, 0.98)
    weight = np.where(labels > 0.5, 0.5 / share, 0.5 / (1 - share)) * mass / total
    model = Linear(np.zeros(cells), np.zeros(rows.dense.shape[1]))
    seen_w, seen_d = np.full(cells, 1e-6), np.full(rows.dense.shape[1], 1e-10)
    row_of = np.repeat(np.arange(len(labels)), np.diff(rows.starts))
    for _ in range(steps):
        off = (sigmoid(model.score(rows)) - labels) * weight
        grad_w = np.bincount(rows.cells, weights=rows.values * off[row_of], minlength=cells) + decay * model.weights
        grad_d = off @ rows.dense
        seen_w += grad_w * grad_w
        seen_d += grad_d * grad_d
        model.weights -= rate * grad_w / np.sqrt(seen_w)
        model.dense -= rate * grad_d / np.sqrt(seen_d)
    return model


def fit_small(columns: np.ndarray, labels: np.ndarray, steps: int = 30) -> np.ndarray:
    """Logistic regression on a few columns by Newton steps, slightly held towards zero."""
    x = np.column_stack((columns, np.ones(len(columns))))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w - np.linalg.solve(hessian, x.T @ (p - labels) + 1e-2 * w)
    return w


@dataclass
class Model:
    content: Linear
    meta: Linear
    #: (slope, shift) of each calibrated view, (content, metadata, shift) of their combination.
    content_scale: np.ndarray
    meta_scale: np.ndarray
    combined: np.ndarray
    threshold: float


def calibrated(scale: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Calibrated log-odds."""
    return np.clip(scale[0] * scores + scale[1], -12, 12)


@dataclass
class Bounds:
    """Bins of scores: from ``good`` upwards a view is sure of good documents, up to ``bad`` of bad ones."""

    good: int
    bad: int


BINS = int(2 * EDGE / BIN)


def bins_of(scores: np.ndarray) -> np.ndarray:
    return np.floor((np.clip(scores, -EDGE, EDGE - BIN) + EDGE) / BIN).astype(np.int64)


def surest(counts: np.ndarray, share: float, good_share: float) -> Bounds:
    """The bins that hold the surest ``share`` of all counted documents, by class; the last bin is taken whole."""
    total = counts.sum()
    sure = np.log(SURE / (1 - SURE))
    from_top, from_bottom = np.cumsum(counts[::-1])[::-1], np.cumsum(counts)
    want_good, want_bad = max(1.0, share * total * good_share), max(1.0, share * total * (1 - good_share))
    good = max(int(np.flatnonzero(from_top >= want_good).max(initial=0)), int(bins_of(np.array([sure]))[0]))
    bad = min(int(np.flatnonzero(from_bottom >= want_bad).min(initial=BINS - 1)), int(bins_of(np.array([-sure]))[0]))
    return Bounds(good, bad)


def part_rows() -> list[tuple[str, int, int]]:
    """(view, class, stratum) of each sum, in a fixed order."""
    return [(view, label, stratum) for view in ("content", "meta") for label in (0, 1) for stratum in range(STRATA)]


def width_of(view: str) -> int:
    """Cells, dense columns and the count of documents, rounded up to whole blocks."""
    cells = WORD_CELLS if view == "content" else META_CELLS
    return -(-(cells + RATIOS + 1) // BLOCK) * BLOCK


def taught_sums(content: Rows, meta: Rows, strata: np.ndarray, views: dict, bounds: dict) -> dict[tuple[str, int, int], np.ndarray]:
    """Sums of whole numbers over the documents that each view teaches the other one."""
    sums = {}
    for teacher, pupil, seen, learnt in (("meta", "content", meta, content), ("content", "meta", content, meta)):
        bins = bins_of(views[teacher].score(seen))
        cells = WORD_CELLS if pupil == "content" else META_CELLS
        for label, chosen in ((1, bins >= bounds[teacher].good), (0, bins <= bounds[teacher].bad)):
            for stratum in range(STRATA):
                rows = np.flatnonzero(chosen & (strata == stratum))
                if not len(rows):
                    continue
                part = learnt.pick(rows)
                total = np.zeros(width_of(pupil), dtype=np.int64)
                total[:cells] = np.bincount(part.cells, weights=np.rint(part.values * UNIT), minlength=cells).astype(np.int64)
                total[cells : cells + part.dense.shape[1]] = np.rint(part.dense * UNIT).astype(np.int64).sum(axis=0)
                total[-1] = len(rows)
                sums[pupil, label, stratum] = total
    return sums


class LocalPool:
    """Unlabelled documents in memory: what tasks do, at once; for tests and for small data."""

    def __init__(self, content: Rows, meta: Rows, strata: np.ndarray):
        self.content, self.meta, self.strata = content, meta, strata

    def histograms(self, views: dict) -> dict[str, np.ndarray]:
        rows = {"content": self.content, "meta": self.meta}
        return {name: np.bincount(bins_of(view.score(rows[name])), minlength=BINS) for name, view in views.items()}

    def taught(self, views: dict, bounds: dict) -> dict[tuple[str, int, int], np.ndarray]:
        return taught_sums(self.content, self.meta, self.strata, views, bounds)


class SparkPool:
    """Unlabelled documents as a table of features; every pass is one job, and what it returns has a fixed size."""

    def __init__(self, table: DataFrame):
        self.table = table.where(F.col("good").isNull()).select("cells", "counts", "n_words", "dense", "meta", "stratum")
        self.sc = table.sparkSession.sparkContext

    def histograms(self, views: dict) -> dict[str, np.ndarray]:
        """Documents per bin of each view's scores."""
        sent = self.sc.broadcast(views)

        def run(batches):
            counts = {"content": np.zeros(BINS, dtype=np.int64), "meta": np.zeros(BINS, dtype=np.int64)}
            for batch in batches:
                content, meta, _ = unpacked(batch)
                for name, rows in (("content", content), ("meta", meta)):
                    counts[name] += np.bincount(bins_of(sent.value[name].score(rows)), minlength=BINS)
            for name, held in counts.items():
                at = np.flatnonzero(held)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(held[at])], ["view", "bin", "n"])

        found = {name: np.zeros(BINS, dtype=np.int64) for name in views}
        counted = self.table.mapInArrow(run, "view string, bin long, n long").groupBy("view", "bin").agg(F.sum("n").alias("n"))
        for row in counted.collect():  # two views, BINS bins at most
            found[row["view"]][row["bin"]] = row["n"]
        sent.unpersist()
        return found

    def taught(self, views: dict, bounds: dict) -> dict[tuple[str, int, int], np.ndarray]:
        """Sums over the documents that each view teaches; merged in blocks of cells, in two steps."""
        sent = self.sc.broadcast((views, bounds))
        keys = part_rows()

        def run(batches):
            held: dict = {}
            for batch in batches:
                for key, total in taught_sums(*unpacked(batch), *sent.value).items():
                    held[key] = held[key] + total if key in held else total
            out = [(keys.index(key), at, part.tobytes()) for key, total in held.items()
                   for at, part in enumerate(total.reshape(-1, BLOCK)) if part.any()]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))], ["part", "block", "sums"])

        def merge(rows):
            total = sum(np.frombuffer(s, dtype=np.int64) for s in rows["sums"])
            return rows[["part", "block"]].head(1).assign(sums=[total.tobytes()])

        shape = "part int, block int, sums binary"
        salted = self.table.mapInArrow(run, shape).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        merged = salted.groupBy("part", "block", "salt").applyInPandas(merge, shape).groupBy("part", "block").applyInPandas(merge, shape)
        sums: dict = {}
        for row in merged.collect():  # a block of fixed size for each place in the sums
            key = keys[row["part"]]
            total = sums.setdefault(key, np.zeros(width_of(key[0]), dtype=np.int64))
            total[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["sums"], dtype=np.int64)
        sent.unpersist()
        return sums


def means_of(sums: dict, view: str, dense: int) -> tuple[Rows, np.ndarray, np.ndarray]:
    """Mean rows of what a view was taught, their classes and numbers of documents."""
    cells = WORD_CELLS if view == "content" else META_CELLS
    own = [(label, sums[view, label, stratum]) for name, label, stratum in part_rows() if name == view and (view, label, stratum) in sums]
    counts = np.array([float(total[-1]) for _, total in own])
    filled = [np.flatnonzero(total[:cells]) for _, total in own]
    means = [total / (UNIT * n) for (_, total), n in zip(own, counts)]
    rows = Rows(
        np.concatenate(([0], np.cumsum([len(f) for f in filled]))).astype(np.int64), np.concatenate([*filled, np.empty(0, dtype=np.int64)]),
        np.concatenate([*[m[f] for m, f in zip(means, filled)], np.empty(0)]),
        np.stack([m[cells : cells + dense] for m in means]) if own else np.zeros((0, dense)),
    )
    return rows, np.array([float(label) for label, _ in own]), counts


def joined(first: Rows, second: Rows) -> Rows:
    return Rows(np.concatenate((first.starts, first.starts[-1] + second.starts[1:])), np.concatenate((first.cells, second.cells)),
                np.concatenate((first.values, second.values)), np.concatenate((first.dense, second.dense)))


def co_train(content: Rows, meta: Rows, labels: np.ndarray, pool, rounds: int = ROUNDS) -> Model | None:
    """Fit both views on labelled rows, in the order of a hash, and on a pool. None without labels of both kinds."""
    if len(labels) < 20 or len(np.unique(labels)) < 2:
        return None
    order = np.arange(len(labels))
    held, train = order[: int(len(order) * HELD_OUT)], order[int(len(order) * HELD_OUT) :]
    if len(np.unique(labels[held])) < 2 or len(np.unique(labels[train])) < 2:
        held = train = order
    good_share = labels[train].mean()
    known = {"content": content.pick(train), "meta": meta.pick(train)}

    def fit_view(name: str, sums: dict, turn: int) -> Linear:
        """Labelled rows of mass 1 each; the means share a mass that grows by the round, by their numbers."""
        rows, classes, counts = means_of(sums, name, known[name].dense.shape[1])
        taught = TRUST * turn * len(train) * counts / max(counts.sum(), 1.0)
        return fit_linear(joined(known[name], rows), np.concatenate((labels[train], classes)),
                          np.concatenate((np.ones(len(train)), taught)), WORD_CELLS if name == "content" else META_CELLS)

    views = {name: fit_view(name, {}, 0) for name in known}
    for turn in range(1, rounds + 1):
        counts = pool.histograms(views)
        if not all(c.sum() for c in counts.values()):
            break
        bounds = {name: surest(c, SHARE * turn, good_share) for name, c in counts.items()}
        sums = pool.taught(views, bounds)
        views = {name: fit_view(name, sums, turn) for name in known}
    truth = labels[held]
    c, m = views["content"].score(content.pick(held)), views["meta"].score(meta.pick(held))
    content_scale, meta_scale = fit_small(c[:, None], truth), fit_small(m[:, None], truth)
    both = np.column_stack((calibrated(content_scale, c), calibrated(meta_scale, m)))
    combined = fit_small(both, truth)
    p = sigmoid(both @ combined[:2] + combined[2])
    threshold = min(0.5, float(np.quantile(p[truth > 0.5], 1 - KEEP_GOOD)))
    return Model(views["content"], views["meta"], content_scale, meta_scale, combined, threshold)


def sample(docs: DataFrame, labels: DataFrame, labelled: int) -> DataFrame:
    """Ids and labels of the labelled documents that the fit uses, the first in the order of a hash of the id."""
    order = F.xxhash64("doc_id", F.lit(11))
    first = labels.where(F.col("doc_id").isNotNull() & F.col("good").isNotNull()).groupBy("doc_id").agg(F.max("good").alias("good"))
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull())
    return first.join(ids, "doc_id", "left_semi").orderBy(order, "doc_id").limit(labelled)


FEATURES = "doc_id long, good double, cells binary, counts binary, n_words long, dense binary, meta binary, stratum int"


def features(docs: DataFrame) -> DataFrame:
    """Both views of documents (doc_id, good, lang, source, n_chars, text) as packed numbers."""

    def run(batches):
        word_cells, meta_cells = Cells(WORD_CELLS), Cells(META_CELLS)
        for batch in batches:
            for part in pieces_of(batch):
                columns = {name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names) if name != "text"}
                out = []
                for i, text in enumerate(raw_texts(part)):
                    text = text or b""
                    words = text.split()
                    cells, counts = np.unique(np.fromiter(map(word_cells.__getitem__, words), dtype=np.uint16, count=len(words)), return_counts=True)
                    lang, source = columns["lang"][i], columns["source"][i]
                    meta = [meta_cells[n] for n in meta_names(lang, source, columns["n_chars"][i], text)]
                    out.append((
                        columns["doc_id"][i], columns["good"][i], cells.tobytes(), counts.astype(np.uint32).tobytes(), len(words),
                        np.array(ratios(text, words)).tobytes(), np.array(meta, dtype=np.uint16).tobytes(),
                        cell(f"{lang} {source}".encode(), STRATA),
                    ))
                types = [pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)],
                    ["doc_id", "good", "cells", "counts", "n_words", "dense", "meta", "stratum"])

    return docs.mapInArrow(run, FEATURES)


class Cells(dict):
    """Cells of names, looked up once; starts anew when full."""

    def __init__(self, cells: int, limit: int = 1 << 18):
        super().__init__()
        self.cells, self.limit = cells, limit

    def __missing__(self, name: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[name] = cell(name, self.cells)
        return value


def packed_column(batch: pa.RecordBatch, name: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """Where the rows of a column of packed numbers start, and all its numbers."""
    held = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    sizes = pa.compute.binary_length(held).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(kind).itemsize
    return np.concatenate(([0], np.cumsum(sizes))), np.frombuffer(b"".join(held.to_pylist()), dtype=kind)


def unpacked(batch: pa.RecordBatch) -> tuple[Rows, Rows, np.ndarray]:
    """Both views of the rows of a feature table, and their strata."""
    starts, cells = packed_column(batch, "cells", np.uint16)
    _, counts = packed_column(batch, "counts", np.uint32)
    n_words = batch.column(batch.schema.get_field_index("n_words")).to_numpy(zero_copy_only=False)
    _, dense = packed_column(batch, "dense", np.float64)
    meta_starts, meta = packed_column(batch, "meta", np.uint16)
    values = counts / np.repeat(np.maximum(n_words, 1), np.diff(starts))
    strata = batch.column(batch.schema.get_field_index("stratum")).to_numpy(zero_copy_only=False)
    n = len(n_words)
    return Rows(starts, cells.astype(np.int64), values, dense.reshape(n, RATIOS)), Rows(meta_starts, meta.astype(np.int64), np.ones(len(meta)), np.zeros((n, 1))), strata


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> Model | None:
    """Fit on at most ``labelled`` labelled documents, whose ids are broadcast, and on all other documents."""
    named = F.broadcast(sample(docs, labels, labelled))
    marked = docs.select("doc_id", "lang", "source", "n_chars", "text").join(named, "doc_id", "left")
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "features")
    features(marked.select("doc_id", "good", "lang", "source", "n_chars", "text")).write.parquet(path)
    try:
        return fit_table(spark.read.schema(FEATURES).parquet(path), rounds)
    finally:  # only the fit reads the table
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def fit_table(table: DataFrame, rounds: int = ROUNDS) -> Model | None:
    """Fit on a table of features: labelled rows, and those without a label as the pool."""
    own = table.where(F.col("good").isNotNull())
    kept = ["cells", "counts", "n_words", "dense", "meta", "stratum"]
    tie = F.struct(F.xxhash64(*kept).alias("h"), *kept)
    one = own.groupBy("doc_id").agg(F.max("good").alias("good"), F.min(tie).alias("row")).select("doc_id", "good", "row.*").drop("h")
    batch = one.toArrow().combine_chunks()  # ``labelled`` rows at most, a row no longer than all cells
    if not batch.num_rows:
        return None
    batch = batch.to_batches()[0]
    ids = batch.column(0).to_pylist()
    order = np.array(sorted(range(len(ids)), key=lambda i: (xxhash.xxh3_64_intdigest(b"%d" % ids[i]), ids[i])))
    content, meta, _ = unpacked(batch)
    truth = batch.column(1).to_numpy(zero_copy_only=False)[order]
    return co_train(content.pick(order), meta.pick(order), truth, SparkPool(table), rounds)


class WordWeights(dict):
    """Weights of words, looked up by their cell once; starts anew when full."""

    def __init__(self, weights: np.ndarray, limit: int = 1 << 18):
        super().__init__()
        self.weights, self.limit = weights, limit

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = float(self.weights[cell(word, len(self.weights))])
        return value


def score(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row with p_content, p_metadata, p_quality and kept; columns in ``keep`` are carried through."""
    needed = ["lang", "source", "n_chars", "text"]
    picked = docs.select(*keep, *[F.col(c).alias(f"_{c}") for c in needed])
    if model is None:
        empty = [F.lit(None).cast("double").alias(c) for c in ("p_content", "p_metadata", "p_quality")]
        return picked.select(*keep, *empty, F.lit(True).alias("kept"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = picked.select(*keep).schema
    for name in ("p_content", "p_metadata", "p_quality"):
        schema = schema.add(name, "double")
    schema = schema.add("kept", "boolean")

    def run(batches):
        fitted = sent.value
        weights = WordWeights(fitted.content.weights)
        meta_weights = WordWeights(fitted.meta.weights)
        for batch in batches:
            for part in pieces_of(batch, column="_text"):
                lang, source, n_chars = (part.column(part.schema.get_field_index(f"_{c}")).to_pylist() for c in needed[:3])
                content, meta = [], []
                for i, text in enumerate(raw_texts(part, "_text")):
                    text = text or b""
                    words = text.split()
                    content.append(sum(map(weights.__getitem__, words)) / max(len(words), 1) + float(np.dot(ratios(text, words), fitted.content.dense)))
                    meta.append(sum(map(meta_weights.__getitem__, meta_names(lang[i], source[i], n_chars[i], text))))
                c, m = calibrated(fitted.content_scale, np.array(content)), calibrated(fitted.meta_scale, np.array(meta))
                p = sigmoid(fitted.combined[0] * c + fitted.combined[1] * m + fitted.combined[2])
                own = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(sigmoid(c)), pa.array(sigmoid(m)), pa.array(p), pa.array(p >= fitted.threshold)], schema.names
                )

    return picked.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), labelled: int = LABELLED,
             rounds: int = ROUNDS) -> DataFrame:
    """Fit on labels (doc_id, good: 1.0, 0.0 or null) and score all of ``docs`` (doc_id, text, lang, source, n_chars).

    One row per row of ``docs``: the columns in ``keep``, the probability of each view and of both
    together, and ``kept``. Null, empty and very long texts are scored like others; null
    languages, sources and sizes are values of their own (a null size is the text's).
    Documents without a label, without an id, or beyond the ``labelled`` first ones are what the
    views label for each other. Of repeated labelled ids and labels one row each is used for the fit. Without at least 20 labels of both kinds the
    probabilities are null and every row is kept. Empty tables give no rows.
    """
    typed = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    return score(docs, fit(typed, labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("good").cast("double").alias("good")), labelled, rounds), keep)
