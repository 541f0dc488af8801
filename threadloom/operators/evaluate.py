"""Classifier measures as plans over (label, score) rows.

Scores are grouped first, so ties are one point, and running counts come from
``running_totals``, which never sorts all scores in one task.
"""

from __future__ import annotations

from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.numeric import argmax, negative_log_likelihood, running_totals
from threadloom.session import materialize


def score_counts(df: DataFrame, label: str, score: str, group: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """Positives and negatives per distinct score."""
    w = F.lit(1) if weight is None else weight
    return df.groupBy(*(group or []), F.col(score).alias("threshold")).agg(
        F.sum(F.when(F.col(label) == 1, w).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(label) != 1, w).otherwise(0)).cast("bigint").alias("neg"),
    )


def curve(df: DataFrame, label: str, score: str, group: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """True and false positives at every distinct score, with the totals.

    The counts per score are written once: cut points, range totals and running
    sums all read them, and the rows behind them are often fresh predictions.
    """
    return curve_of(materialize(score_counts(df, label, score, group, weight), "score-counts"), group)


def curve_of(counts: DataFrame, group: list[str] | None = None) -> DataFrame:
    """The same from counts per score."""
    ran = running_totals(counts, "threshold", {"pos": "tp", "neg": "fp"}, group)
    if not group:
        totals = counts.agg(
            F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t")
        ).scalar()
        return ran.withColumn("_t", totals).select(
            *ran.columns, F.col("_t.p").alias("total_pos"), F.col("_t.n").alias("total_neg")
        )
    totals = counts.groupBy(*group).agg(
        F.sum("pos").alias("total_pos"), F.sum("neg").alias("total_neg")
    )
    return ran.join(totals, group)


def _auc() -> Column:
    """Each score's negatives are beaten by the positives above it, and half by
    the positives tied with it."""
    won = F.sum(F.col("neg") * ((F.col("tp") - F.col("pos")).cast("double") + F.col("pos") / 2.0))
    pairs = F.max("total_pos").cast("double") * F.max("total_neg")
    return (won / F.nullif(pairs, F.lit(0.0))).alias("auc")


def _ap() -> Column:
    gain = F.col("pos") / F.nullif(F.col("total_pos"), F.lit(0)) * F.col("tp") / (F.col("tp") + F.col("fp"))
    return F.sum(F.when(F.col("pos") > 0, gain).otherwise(0.0)).alias("ap")


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", group: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """Area under the ROC curve; tied scores share their rank."""
    return curve(df, label, score, group, weight).groupBy(*(group or [])).agg(_auc())


def avg_precision(df: DataFrame, label: str = "label", score: str = "score", group: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """Sum of precision times the step in recall over the distinct scores."""
    return curve(df, label, score, group, weight).groupBy(*(group or [])).agg(_ap())


def measure(df: DataFrame, label: str = "label", score: str = "score", group: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """AUC and average precision from one curve; one row, or one per group."""
    return curve(df, label, score, group, weight).groupBy(*(group or [])).agg(_auc(), _ap())


def pr_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = F.col("tp") / F.nullif(F.col("total_pos"), F.lit(0))
    return (
        curve(df, label, score)
        .withColumn("precision", precision)
        .withColumn("recall", recall)
        .withColumn(
            "f1",
            2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-10),
        )
        .select("threshold", "precision", "recall", "f1")
    )


def best_threshold(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """The threshold with the largest F1; the lowest one among equals."""
    return pr_points(df, label, score).orderBy(F.desc("f1"), "threshold").limit(1)


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return curve(df, label, score).select(
        "threshold",
        (F.col("fp") / F.nullif(F.col("total_neg"), F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif(F.col("total_pos"), F.lit(0))).alias("tpr"),
    )


def predicted(score: str, threshold) -> Column:
    return (F.col(score) >= threshold).cast("int")


def confusion(df: DataFrame, threshold, label: str = "label", score: str = "score") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), predicted(score, threshold).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def accuracy(df: DataFrame, threshold, label: str = "label", score: str = "score") -> DataFrame:
    return df.agg(F.avg((F.col(label) == predicted(score, threshold)).cast("double")).alias("accuracy"))


def class_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Support-weighted precision, recall and F1, and accuracy; one row.

    All counts come from the small (label, prediction) table.
    """
    cells = df.groupBy(F.col(label).alias("y"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("y").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed"),
                         F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed"),
                         F.lit(0).cast("bigint").alias("hit")),
            )
        )
    )
    per = sides.groupBy("c").agg(F.sum("support").alias("s"), F.sum("claimed").alias("k"), F.sum("hit").alias("h"))
    p = F.when(F.col("k") > 0, F.col("h") / F.col("k")).otherwise(0.0)
    r = F.when(F.col("s") > 0, F.col("h") / F.col("s")).otherwise(0.0)
    scored = per.withColumn("_p", p).withColumn("_r", r).withColumn(
        "_f", F.when(F.col("_p") + F.col("_r") > 0, 2 * F.col("_p") * F.col("_r") / (F.col("_p") + F.col("_r"))).otherwise(0.0)
    )
    n = F.sum("s")
    return scored.agg(
        (F.sum("h") / n).alias("accuracy"),
        (F.sum(F.col("s") * F.col("_p")) / n).alias("precision_weighted"),
        (F.sum(F.col("s") * F.col("_r")) / n).alias("recall_weighted"),
        (F.sum(F.col("s") * F.col("_f")) / n).alias("f1_weighted"),
    )


def nll(df: DataFrame, probs: str = "probs", label: str = "label") -> DataFrame:
    return df.withColumn("nll", negative_log_likelihood(F.col(probs), F.col(label)))


def worst(df: DataFrame, k: int, id_col: str, loss: str = "nll") -> DataFrame:
    return df.orderBy(F.desc(loss), id_col).limit(k)


def focus_set(df: DataFrame, k: int, id_col: str, label: str = "label", probs: str = "probs", loss: str = "nll") -> DataFrame:
    """The first k misclassified ids and the k with the largest loss, once each."""
    wrong = df.where(argmax(probs) != F.col(label)).orderBy(id_col).limit(k)
    return wrong.select(id_col).union(worst(df, k, id_col, loss).select(id_col)).distinct()


def errors(df: DataFrame, threshold, label: str = "label", score: str = "score") -> DataFrame:
    """Wrong rows marked FP or FN."""
    kind = F.when((F.col(label) == 0) & (F.col(score) >= threshold), "FP").when(
        (F.col(label) == 1) & (F.col(score) < threshold), "FN"
    )
    return df.withColumn("error", kind).where(F.col("error").isNotNull())


def pick_failures(wrong: DataFrame, id_col: str, score: str = "score", lo: float = 0.35, hi: float = 0.45) -> DataFrame:
    """Surest false negative, first borderline and surest false positive."""
    fn = wrong.where(F.col("error") == "FN").orderBy(score, id_col).limit(1)
    fp = wrong.where(F.col("error") == "FP")
    edge = fp.where(F.col(score).between(lo, hi)).orderBy(id_col).limit(1)
    sure = fp.orderBy(F.desc(score), id_col).limit(1)
    tag = [("surest_fn", fn), ("borderline_fp", edge), ("surest_fp", sure)]
    out = None
    for name, part in tag:
        part = part.withColumn("example", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def extremes(wrong: DataFrame, id_col: str, score: str = "score") -> DataFrame:
    """Ids and scores of the surest false positive and false negative."""
    fp = F.col("error") == "FP"
    fn = F.col("error") == "FN"
    first_high = F.struct(-F.col(score), F.col(id_col))
    first_low = F.struct(F.col(score), F.col(id_col))
    return wrong.agg(
        F.min_by(F.when(fp, F.col(id_col)), F.when(fp, first_high)).alias("fp_id"),
        F.max(F.when(fp, F.col(score))).alias("fp_score"),
        F.min_by(F.when(fn, F.col(id_col)), F.when(fn, first_low)).alias("fn_id"),
        F.min(F.when(fn, F.col(score))).alias("fn_score"),
        F.count_if(fp).alias("n_fp"),
        F.count_if(fn).alias("n_fn"),
    )


# --- bootstrap --------------------------------------------------------------

# Cumulative Poisson(1) probabilities.
POISSON_STEPS = [
    0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
    0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999897508033253,
    0.9999988747974020, 0.9999998885745217, 0.9999999899522336, 0.9999999991683892,
]


def poisson_weights(ids: np.ndarray, n_boot: int, seed: int) -> np.ndarray:
    """Poisson(1) weights (rows x replicates), drawn from a hash of id, replicate and seed."""
    turns = np.arange(1, n_boot + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = ids.astype(np.int64).view(np.uint64)[:, None] + np.uint64(seed * 0xD1B54A32D192ED03 % 2**64) + turns[None, :]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.searchsorted(POISSON_STEPS, (x >> np.uint64(11)) / 2.0**53, side="right").astype(np.int64)


def _slices(batches, block: int):
    """(part, ids, labels, scores) of batches that are sorted by part, in slices of one part and at most ``block`` rows."""
    for batch in batches:
        part, i, y, s = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "i", "y", "s"))
        edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
        for start, end in zip(edges, [*edges[1:], len(part)]):
            for at in range(start, end, block):
                stop = min(at + block, end)
                yield int(part[at]), i[at:stop], y[at:stop].astype(bool), s[at:stop]


def bootstrap(
    df: DataFrame, id_col: str, label: str = "label", score: str = "score", n_boot: int = 1000, seed: int = 42,
    parts: int | None = None, block: int = 2000,
) -> DataFrame:
    """AUC and average precision of every replicate.

    NaN and null scores are left out. A row enters a replicate with a Poisson(1) weight drawn from a hash of its
    id, the usual way to resample rows that are spread over a cluster. Rows are
    cut into ranges of scores once; equal scores stay in one range. A first pass
    sums each range's weights per replicate, which gives the positives and
    negatives above every range; a second pass adds up each range's share of the
    measures with these. Between the passes only ranges x replicates numbers move,
    and the rows are never copied per replicate. A range is read in blocks.
    """
    spark = df.sparkSession
    ids = F.xxhash64(id_col).alias("i")
    rows = df.select(ids, (F.col(label) == 1).alias("y"), F.col(score).cast("double").alias("s")).where(F.col("s").isNotNull() & ~F.isnan("s"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, F.desc("s")).sortWithinPartitions(F.desc("s"))
    data = materialize(ranged.withColumn("part", F.spark_partition_id()), "bootstrap")
    ordered = data.repartition(parts, "part").sortWithinPartitions("part", F.desc("s"))
    schema = "part int, pos array<long>, neg array<long>"

    def sums(batches):
        for part, slices in groupby(_slices(batches, block), key=lambda x: x[0]):
            pos, neg = np.zeros(n_boot, dtype=np.int64), np.zeros(n_boot, dtype=np.int64)
            for _, i, y, _ in slices:
                w = poisson_weights(i, n_boot, seed)
                pos += w[y].sum(axis=0)
                neg += w[~y].sum(axis=0)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pos], kind), pa.array([neg], kind)], ["part", "pos", "neg"])

    found = sorted(ordered.mapInArrow(sums, schema).collect())
    if not found:
        return spark.createDataFrame([], "replicate int, auc double, ap double")
    above, tp, fp = {}, np.zeros(n_boot, dtype=np.int64), np.zeros(n_boot, dtype=np.int64)
    for row in found:
        above[row["part"]] = (tp, fp)
        tp, fp = tp + np.array(row["pos"]), fp + np.array(row["neg"])
    shared = spark.sparkContext.broadcast((above, tp, fp))

    def shares(batches):
        starts, n_pos, _ = shared.value
        for part, slices in groupby(_slices(batches, block), key=lambda x: x[0]):
            tp, fp = starts[part]
            auc, ap = np.zeros(n_boot), np.zeros(n_boot)
            score, pos, neg = None, 0, 0  # the score being summed up, which may go on in the next slice
            tail = ((part, np.zeros(0, np.int64), np.zeros(0, bool), np.array([np.nan])),)
            for _, i, y, s in chain(slices, tail):
                w = poisson_weights(i, n_boot, seed)
                edges = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
                for k, start in enumerate(edges):
                    if s[start] != score:
                        if score is not None:
                            auc = auc + neg * (tp + pos / 2.0)
                            tp, fp = tp + pos, fp + neg
                            ap = ap + np.where(pos > 0, pos / np.maximum(n_pos, 1) * tp / np.maximum(tp + fp, 1), 0.0)
                        score, pos, neg = s[start], 0, 0
                    rows = slice(start, edges[k + 1] if k + 1 < len(edges) else len(i))
                    pos = pos + w[rows][y[rows]].sum(axis=0)
                    neg = neg + w[rows][~y[rows]].sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(1, n_boot + 1, dtype=np.int32)), pa.array(auc), pa.array(ap)], ["replicate", "auc", "ap"]
            )

    parted = ordered.mapInArrow(shares, "replicate int, auc double, ap double")
    pairs = (tp.astype(float) * fp).tolist()
    totals = spark.createDataFrame([(r + 1, p) for r, p in enumerate(pairs)], "replicate int, pairs double")
    return parted.groupBy("replicate").agg(F.sum("auc").alias("auc"), F.sum("ap").alias("ap")).join(totals, "replicate").select(
        "replicate", (F.col("auc") / F.nullif("pairs", F.lit(0.0))).alias("auc"), "ap"
    )


def bootstrap_ci(df: DataFrame, id_col: str, label: str = "label", score: str = "score", n_boot: int = 1000, seed: int = 42) -> DataFrame:
    """Mean and 2.5/97.5 percentiles over the replicates, per metric."""
    runs = bootstrap(df, id_col, label, score, n_boot, seed)
    long = runs.select(
        F.inline(F.array(
            F.struct(F.lit("auc").alias("metric"), F.col("auc").alias("value")),
            F.struct(F.lit("ap").alias("metric"), F.col("ap").alias("value")),
        ))
    )
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"),
        F.expr("percentile(value, 0.025)").alias("lo"),
        F.expr("percentile(value, 0.975)").alias("hi"),
    )


