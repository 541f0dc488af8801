"""Numeric functions and the exact distributed rank and running-total helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from threadloom.functions.text import as_column, let

EPS = 2.220446049250313e-16


def half_even(c: Column | str) -> Column:
    """Round to the nearest integer, ties to the even one."""
    return F.bround(as_column(c), 0).cast("bigint")


def to_number(c: Column | str) -> Column:
    """Numeric value or null."""
    return as_column(c).try_cast("double")


def finite_or_zero(c: Column | str) -> Column:
    c = as_column(c).cast("double")
    return F.when(c.isNull() | F.isnan(c), F.lit(0.0)).otherwise(c)


def damped_sigmoid(raw: Column, n_tokens: Column) -> Column:
    """Logistic of the raw score divided by a slowly growing length term."""
    damping = F.greatest(F.lit(1.0), F.pow(n_tokens.cast("double"), F.lit(0.3)))
    return 1.0 / (1.0 + F.exp(-raw / damping))


def severity_bucket(score: Column | str) -> Column:
    """Fifths of [0, 1) to 0-4; everything else, NaN too, gives 5."""
    s = as_column(score)
    inside = (s >= 0.0) & (s < 1.0) & ~F.isnan(s)
    step = (
        F.when(s < 0.2, 0).when(s < 0.4, 1).when(s < 0.6, 2).when(s < 0.8, 3).otherwise(4)
    )
    return F.when(inside, step).otherwise(5)


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def softmax(a: Column | str) -> Column:
    def body(arr: Column) -> Column:
        shifted = F.transform(arr, lambda x: F.exp(x.cast("double") - F.array_max(arr)))
        return let(shifted, lambda e: let(array_sum(e), lambda t: F.transform(e, lambda x: x / t)))

    return let(as_column(a), body)


def dot(a: Column, b: Column) -> Column:
    return array_sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l2_norm(a: Column | str) -> Column:
    a = as_column(a)
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column | str, b: Column | str) -> Column:
    a, b = as_column(a), as_column(b)
    floor = F.lit(EPS)
    return dot(a, b) / (F.greatest(l2_norm(a), floor) * F.greatest(l2_norm(b), floor))


def row_normalize(a: Column | str) -> Column:
    """Divide by the row sum, floored at the machine epsilon."""
    return let(
        as_column(a),
        lambda arr: let(
            F.greatest(array_sum(arr), F.lit(EPS)), lambda t: F.transform(arr, lambda x: x / t)
        ),
    )


def argmax(a: Column | str) -> Column:
    """Index of the first largest element."""
    return let(as_column(a), lambda arr: F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def negative_log_likelihood(probs: Column, label: Column) -> Column:
    p = F.get(probs, label.cast("int")).cast("double")
    return F.when(p <= 0, F.lit(float("inf"))).otherwise(-F.log(p))


def zscale(df: DataFrame, columns: list[str], suffix: str = "_z", fit_on: DataFrame | None = None) -> DataFrame:
    """Standardise with the population deviation; a constant column gives 0.

    The statistics are one scalar row, computed over ``fit_on`` when given.
    """
    stats = (df if fit_on is None else fit_on).agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_m") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_s") for c in columns],
        ).alias("stats")
    )
    scored = df.withColumn("_stats", stats.scalar())
    for c in columns:
        dev = F.col("_stats")[f"{c}_s"]
        centred = F.col(c) - F.col("_stats")[f"{c}_m"]
        scored = scored.withColumn(c + suffix, centred / F.when(dev > 0, dev).otherwise(1.0))
    return scored.drop("_stats")


def spread_by(df: DataFrame, key: str, size: Column, each: int, sized: DataFrame | None = None) -> DataFrame:
    """Deal rows over parts by ``key``, as many as the total of ``size`` over ``each`` asks for.

    A task's share stays the same however large the input is; the fixed number of shuffle
    partitions would let it grow. ``sized`` names another frame to add the sizes up over.
    """
    total = (df if sized is None else sized).agg(F.sum(size.cast("bigint")).alias("n")).first()["n"] or 0
    return df.repartition(max(1, -(-total // each)), key)


# ---------------------------------------------------------------------------
# Exact ranks and running totals without a single-task window
# ---------------------------------------------------------------------------


def ranked_by_hash(
    df: DataFrame,
    group: list[str],
    id_col: str,
    seed: int,
    out: str = "rank",
    digits: int = 3,
) -> DataFrame:
    """Number the rows of each group 1..n in the order of md5(id, seed).

    A group may hold most of all rows, so no task ever sorts a whole group. The
    leading hex digits of the hash cut each group into even buckets; a row's
    number is the size of the buckets before its own plus its place inside it.
    The bucket counts are groups x 16^digits rows.
    """
    keyed = df.withColumn(
        "_key", F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    ).withColumn("_bucket", F.substring("_key", 1, digits))
    cells = [*group, "_bucket"]
    counts = keyed.groupBy(*cells).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(cells)],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(W.partitionBy(*group)).alias(f"{out}_of"),
    )
    inside = W.partitionBy(*cells).orderBy("_key", id_col)
    same = reduce(
        lambda x, y: x & y,
        [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(cells)],
    )
    return (
        keyed.withColumn("_place", F.row_number().over(inside))
        .join(offsets, same)
        .withColumn(out, (F.col("_before") + F.col("_place")).cast("bigint"))
        .drop("_key", "_bucket", "_place", "_before", *[f"_g{i}" for i in range(len(cells))])
    )


def running_totals(
    df: DataFrame,
    order: str,
    sums: dict[str, str],
    group: list[str] | None = None,
    descending: bool = True,
) -> DataFrame:
    """Running sums over the distinct values of ``order``, split into ranges.

    ``df`` holds one row per (group, order value). The cut points are
    approximate quantiles of the values, so each range is small whatever the
    distribution; the sums themselves are exact for any cut points. Only the
    range totals (at most 256 per group) go through one ordered window. A value
    finds its range in two steps of sixteen cut points each.
    """
    group = group or []
    step = 16
    points = [i / (step * step) for i in range(1, step * step)]
    quantiles = F.percentile_approx(F.col(order).cast("double"), points, 10000)
    coarse = [i * step for i in range(1, step)]
    cuts = df.agg(F.coalesce(quantiles, F.array().cast("array<double>")).alias("q")).select(
        F.struct("q", F.array(*[F.try_element_at("q", F.lit(i)) for i in coarse]).alias("c")).alias("s")
    )

    def below(points: Column) -> Column:
        return F.aggregate(
            points, F.lit(0), lambda n, c: n + F.when(F.col(order) > c, 1).otherwise(0)
        )

    placed = (
        df.withColumn("_cuts", cuts.scalar())
        .withColumn("_coarse", below(F.col("_cuts.c")))
        .withColumn(
            "_range",
            F.col("_coarse") * step + below(F.slice("_cuts.q", F.col("_coarse") * step + 1, step)),
        )
        .drop("_cuts", "_coarse")
    )
    key = F.col(order).desc() if descending else F.col(order).asc()
    range_key = F.col("_range").desc() if descending else F.col("_range").asc()
    cells = [*group, "_range"]
    totals = placed.groupBy(*cells).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    earlier = W.partitionBy(*group).orderBy(range_key).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *cells, *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums]
    )
    inside = W.partitionBy(*cells).orderBy(key).rowsBetween(W.unboundedPreceding, 0)
    summed = placed.select(
        "*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in sums]
    ).join(offsets, cells)
    return summed.select(
        *df.columns, *[(F.col(f"_in_{c}") + F.col(f"_o_{c}")).alias(name) for c, name in sums.items()]
    )
