"""Stratified samples, splits and folds by seeded hash order.

Ranks of whole strata come from ``ranked_by_hash``, so a stratum with
half of all rows is still spread over all tasks, and a retried task draws the
same rows. A budgeted sample keeps the first rows of each task only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.functions.numeric import half_even, ranked_by_hash


def quotas(df: DataFrame, group: str, budget: int, floor: int) -> DataFrame:
    """Rows to draw per group: the floor plus a share of what is left over."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n_group"))
    total = counts.agg(
        F.struct(F.sum("n_group").alias("n"), F.count(F.lit(1)).alias("k")).alias("t")
    ).scalar()
    share = (budget - floor * F.col("_t.k")) * F.col("n_group") / F.col("_t.n")
    wanted = floor + half_even(share)
    return counts.withColumn("_t", total).select(
        group, "n_group", F.least(wanted, F.col("n_group")).alias("quota")
    )


def quota_sample(df: DataFrame, id_col: str, group: str, budget: int, floor: int, seed: int = 42) -> DataFrame:
    """Draw each group's quota in hash order.

    No quota exceeds the budget (or the floor), so every task keeps that many rows of a
    group at most before the shuffle, and no group is ranked as a whole.
    """
    if df.isEmpty():
        raise ValueError("no data to sample from")
    key = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    first = Window.partitionBy(group).orderBy("_key", id_col)
    least = df.withColumn("_key", key).withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= max(budget, floor))
    return (
        least.join(quotas(df, group, budget, floor).select(group, "quota"), group)
        .where(F.col("_rank") <= F.col("quota"))
        .drop("_key", "_rank", "quota")
    )


def stratified_split(
    df: DataFrame, id_col: str, label: str, shares: dict[str, float], seed: int = 42, out: str = "split"
) -> DataFrame:
    """Name a part per row; parts take their share of every class.

    ``shares`` maps names to fractions that add up to 1. Nested splits are
    fractions of fractions, e.g. train .72, validation .08, test .2.
    """
    ranked = ranked_by_hash(df, [label], id_col, seed, "_rank")
    place = (F.col("_rank") - 1) / F.col("_rank_of")
    edge, name = 0.0, None
    parts = list(shares.items())
    for part, share in parts[:-1]:
        edge += share
        hit = place < round(edge, 12)
        name = F.when(hit, part) if name is None else name.when(hit, part)
    last = parts[-1][0]
    named = F.lit(last) if name is None else name.otherwise(last)
    return ranked.withColumn(out, named).drop("_rank", "_rank_of")


def folds(df: DataFrame, id_col: str, label: str, k: int = 5, repeats: int = 2, seed: int = 42) -> DataFrame:
    """One row per (row, repeat) with its fold, balanced inside every class."""
    out = None
    for r in range(repeats):
        part = (
            ranked_by_hash(df, [label], id_col, seed + r, "_rank")
            .withColumn("repeat", F.lit(r))
            .withColumn("fold", ((F.col("_rank") - 1) % k).cast("int"))
            .drop("_rank", "_rank_of")
        )
        out = part if out is None else out.unionByName(part)
    return out


def fold_columns(df: DataFrame, id_col: str, label: str, k: int = 5, repeats: int = 2, seed: int = 42) -> DataFrame:
    """The same folds as columns ``fold_0``, ``fold_1``, ... of every row."""
    for r in range(repeats):
        df = ranked_by_hash(df, [label], id_col, seed + r, "_rank").withColumn(f"fold_{r}", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_rank_of")
    return df


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Add n / (classes * n_class). Classes are few, their counts are a bounded
    table; it comes in as one map, so the rows are not shuffled."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    table = counts.agg(
        F.struct(
            F.sum("_c").alias("n"),
            F.count(F.lit(1)).alias("k"),
            F.map_from_entries(F.collect_list(F.struct(F.col(label), F.col("_c")))).alias("per"),
        ).alias("t")
    ).scalar()
    weight: Column = F.col("_t.n") / (F.col("_t.k") * F.element_at("_t.per", F.col(label)))
    return df.withColumn("_t", table).withColumn(out, weight).drop("_t")
