"""Profiles, counts, distributions and quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from threadloom.functions.text import text_length, text_or_empty, word_count
from threadloom.session import materialize


def _count() -> Column:
    return F.count(F.lit(1))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with their share in percent."""
    total = df.agg(_count().alias("n")).scalar()
    return df.groupBy(column).agg(_count().alias("n")).withColumn(
        "pct", F.col("n") * 100.0 / total
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percentage of every column, from one pass."""
    columns = df.columns
    row = df.agg(
        _count().alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns]
    )
    return row.select("_rows", F.explode(cells).alias("cell")).select(
        "cell.column",
        "cell.n_null",
        F.round(F.col("cell.n_null") * 100.0 / F.col("_rows"), 2).alias("pct_null"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Rows, columns, columns per type and missing cells as (metric, value)."""
    types: dict[str, int] = {}
    for _, kind in df.dtypes:
        types[kind] = types.get(kind, 0) + 1
    fixed = [("columns", len(df.columns))] + [(f"type:{k}", n) for k, n in types.items()]
    missing = sum(
        (F.count_if(F.col(c).isNull()) for c in df.columns[1:]), F.count_if(F.col(df.columns[0]).isNull())
    )
    row = df.agg(_count().alias("rows"), missing.alias("missing"))
    cells = [F.struct(F.lit("rows").alias("metric"), F.col("rows").alias("value")),
             F.struct(F.lit("missing").alias("metric"), F.col("missing").alias("value"))]
    cells += [
        F.struct(F.lit(m).alias("metric"), F.lit(v).cast("bigint").alias("value")) for m, v in fixed
    ]
    return row.select(F.inline(F.array(*cells)))


def linkage(posts: DataFrame, comments: DataFrame, host_prefix: str = "t3_") -> DataFrame:
    """How many posts have comments, and comments per post.

    The post counts are scalar subqueries beside the comment aggregate, so no
    join is involved.
    """
    n_posts = posts.agg(_count().alias("n")).scalar()
    linked = F.count_distinct(F.replace(F.col("link_id"), F.lit(host_prefix), F.lit("")))
    return (
        comments.agg(linked.alias("linked_posts"), _count().alias("n_comments"))
        .withColumn("n_posts", n_posts)
        .withColumn("linked_pct", F.col("linked_posts") * 100.0 / F.col("n_posts"))
        .withColumn("comments_per_post", F.col("n_comments") / F.col("n_posts"))
    )


def length_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and median length. The lengths are counted per value first, so the
    median's buffer grows with the longest text, not with the rows."""
    lens = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), text_length(c).alias("len")) for c in columns])
        ).alias("s")
    ).select("s.column", "s.len")
    per_value = lens.groupBy("column", "len").agg(_count().alias("n"))
    return per_value.groupBy("column").agg(
        (F.sum(F.col("len") * F.col("n")) / F.sum("n")).alias("mean_len"),
        F.expr("percentile(len, 0.5, n)").alias("median_len"),
    )


#: Buckets a value range is cut into per pass, and targets that are broadcast.
BUCKETS = 64
FEW_TARGETS = 100_000


def exact_quantiles(per_value: DataFrame, group: str, value: str, probs: list[float], n: str = "_n") -> DataFrame:
    """Sizes and exact quantiles of each group: the group, n, _q (interpolated between neighbours).

    ``per_value`` has one row per group and value with its count. All groups and
    quantiles are narrowed down at once: each pass counts the values between a target's
    bounds by bucket and goes on in the bucket that holds the wanted rank, until that
    holds one value. A task keeps bucket counts only, however large a group is. Null
    and NaN values do not count; a null group is a group.
    """
    v = F.col(value).cast("double")
    values = materialize(
        per_value.where(v.isNotNull() & ~F.isnan(v)).select(F.col(group).alias("g"), v.alias("v"), F.col(n).cast("long").alias("c")), "values"
    )
    sizes = materialize(values.groupBy("g").agg(F.sum("c").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "sizes")
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("n") - 1)).alias("at")) for i, p in enumerate(probs)])
    aims = sizes.select("g", "lo", "hi", "n", F.explode(wanted).alias("w")).select("g", "lo", "hi", "n", "w.i", "w.at")
    ranks = aims.select("g", "lo", "hi", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank")).distinct()
    targets = materialize(ranks.withColumn("before", F.lit(0).cast("long")), "targets")
    done = targets.where(F.col("lo") == F.col("hi"))
    targets = targets.where(F.col("lo") < F.col("hi"))
    up_to = W.partitionBy("g", "rank").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    while (left := targets.limit(FEW_TARGETS + 1).count()) > 0:
        asked = F.broadcast(targets) if left <= FEW_TARGETS else targets
        inside = values.withColumnRenamed("g", "vg").join(asked, F.col("vg").eqNullSafe(F.col("g")) & F.col("v").between(F.col("lo"), F.col("hi")))
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).alias("bucket")
        counts = inside.groupBy("g", "rank", "before", bucket).agg(F.sum("c").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        reached = counts.withColumn("to", F.col("before") + F.sum("c").over(up_to))
        hit = reached.where((F.col("to") > F.col("rank")) & (F.col("to") - F.col("c") <= F.col("rank")))
        found = materialize(hit.select("g", "lo", "hi", "rank", (F.col("to") - F.col("c")).alias("before")), "targets")
        done = done.unionByName(found.where(F.col("lo") == F.col("hi")))
        targets = found.where(F.col("lo") < F.col("hi"))
    at = done.select(F.col("g").alias("dg"), F.col("rank"), F.col("lo").alias("x"))
    for side, rank in (("below", F.floor("at")), ("above", F.ceil("at"))):
        one = at.select(F.col("dg").alias(f"{side}_g"), F.col("rank").alias(f"{side}_rank"), F.col("x").alias(side))
        aims = aims.join(one, F.col("g").eqNullSafe(F.col(f"{side}_g")) & (rank == F.col(f"{side}_rank")))
    part = F.col("at") - F.floor("at")
    x = F.when(F.col("below") == F.col("above"), F.col("below")).otherwise(F.col("below") * (1 - part) + F.col("above") * part)
    return aims.groupBy(F.col("g").alias(group), "n").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", x.alias("x")))), lambda s: s["x"]).alias("_q"))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles per group and the whiskers a box plot draws.

    A whisker ends at the outermost value within 1.5 times the quartile range.
    Values are counted first; everything after works on distinct values.
    """
    per_value = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(_count().alias("_n"))
    quart = materialize(exact_quantiles(per_value, group, value, [0.0, 0.25, 0.5, 0.75, 1.0]), "quartiles")
    reach = (F.col("_q")[3] - F.col("_q")[1]) * 1.5
    inside = F.col(value).between(F.col("_q")[1] - reach, F.col("_q")[3] + reach)
    ends = (
        per_value.join(quart, group)
        .where(inside)
        .groupBy(group)
        .agg(F.min(value).alias("whisker_lo"), F.max(value).alias("whisker_hi"))
    )
    return quart.join(ends, group).select(
        group, "n",
        F.col("_q")[0].alias("min_value"), F.col("_q")[1].alias("q1"),
        F.col("_q")[2].alias("median"), F.col("_q")[3].alias("q3"),
        F.col("_q")[4].alias("max_value"), "whisker_lo", "whisker_hi",
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between smallest and largest value, right end closed."""
    c = F.col(column).cast("double")
    span = df.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias("span")).scalar()
    lo, width = F.col("_span.lo"), (F.col("_span.hi") - F.col("_span.lo")) / bins
    index = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((c - lo) / width), F.lit(bins - 1))
    )
    return (
        df.where(c.isNotNull())
        .withColumn("_span", span)
        .groupBy(index.cast("int").alias("bin"), F.col("_span.lo").alias("_lo"), width.alias("_width"))
        .agg(_count().alias("n"))
        .select("bin", (F.col("_lo") + F.col("bin") * F.col("_width")).alias("left_edge"), "n")
    )


def rates_by_group(
    df: DataFrame, group: str, positive: Column, rating: str, prefix: str
) -> DataFrame:
    """Positive rate in percent, mean rating and rows per group, rounded to 2."""
    return df.groupBy(group).agg(
        F.round(F.avg(positive.cast("double")) * 100.0, 2).alias(f"{prefix}_rate"),
        F.round(F.avg(F.col(rating).cast("double")), 2).alias(f"{prefix}_mean"),
        F.count("post_id").alias(f"{prefix}_count"),
    )


def crosstab_long(df: DataFrame, row: str, column: str) -> DataFrame:
    """Cell counts with row and column totals, from one small grouped table."""
    cells = df.groupBy(row, column).agg(_count().alias("n"))
    rows = cells.groupBy(row).agg(F.sum("n").alias("row_total"))
    cols = cells.groupBy(column).agg(F.sum("n").alias("col_total"))
    return cells.join(rows, row).join(cols, column)


def crosstab(df: DataFrame, row: str, column: str, values: list | None = None) -> DataFrame:
    """Wide counts, absent cells 0, rows and columns by falling total.

    The pivoted column has to be narrow: its distinct values become columns.
    """
    if values is None:
        order = df.groupBy(column).agg(_count().alias("n")).orderBy(F.desc("n"), column)
        values = [r[0] for r in order.limit(10001).collect()]
        if len(values) > 10000:
            raise ValueError(f"{column} has too many values to become columns")
    cells = df.groupBy(row, column).agg(_count().alias("n"))
    wide = cells.groupBy(row).pivot(column, values).agg(F.sum("n")).na.fill(0)
    names = [c for c in wide.columns if c != row]
    total = sum((F.col(f"`{c}`") for c in names[1:]), F.col(f"`{names[0]}`"))
    return wide.withColumn("total", total).orderBy(F.desc("total"), row)


def coverage(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("earliest"), F.max(ts).alias("latest"))


def distinct_groups(df: DataFrame, group: str) -> DataFrame:
    return df.select(group).distinct()


def top_groups(df: DataFrame, group: str, n: int = 10) -> DataFrame:
    return df.groupBy(group).agg(_count().alias("n")).orderBy(F.desc("n"), group).limit(n)


def score_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.min(column).alias("min_value"), F.max(column).alias("max_value"), F.avg(column).alias("mean_value")
    )


def quality(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Uniqueness of ids and missing texts, one row."""

    def empty(c: str) -> Column:
        return F.count_if(text_or_empty(c) == "")

    from_comments = comments.agg(
        F.struct(
            _count().alias("n"),
            F.count_distinct("comment_id").alias("ids"),
            empty("body").alias("no_body"),
        ).alias("c")
    ).scalar()
    return (
        posts.agg(
            _count().alias("n_posts"),
            F.count_distinct("post_id").alias("unique_posts"),
            empty("title").alias("missing_title"),
            empty("selftext").alias("missing_selftext"),
        )
        .withColumn("_c", from_comments)
        .select(
            "n_posts", "unique_posts", "missing_title", "missing_selftext",
            (F.col("missing_title") * 100.0 / F.col("n_posts")).alias("missing_title_pct"),
            (F.col("missing_selftext") * 100.0 / F.col("n_posts")).alias("missing_selftext_pct"),
            F.col("_c.n").alias("n_comments"),
            F.col("_c.ids").alias("unique_comments"),
            F.col("_c.no_body").alias("missing_body"),
            (F.col("_c.no_body") * 100.0 / F.col("_c.n")).alias("missing_body_pct"),
        )
    )


def recent_counts(df: DataFrame, end: Column, days: int, group: str, ts: str) -> DataFrame:
    """Rows of the trailing window per group, and the rate per second of it."""
    start = end - F.make_dt_interval(F.lit(days))
    return (
        df.where((F.col(ts) >= start) & (F.col(ts) <= end))
        .groupBy(group)
        .agg(_count().alias("n"))
        .withColumn("per_second", F.col("n") / F.lit(days * 86400.0))
    )


def datacard(df: DataFrame, ts: str, texts: list[str], id_col: str) -> DataFrame:
    """Counts, date range, missing values and text quality as (metric, value)."""
    row = df.agg(
        _count().cast("double").alias("rows"),
        F.count_distinct(id_col).cast("double").alias("unique_ids"),
        F.min(F.unix_seconds(ts)).cast("double").alias("earliest_epoch"),
        F.max(F.unix_seconds(ts)).cast("double").alias("latest_epoch"),
        *[F.count_if(F.col(c).isNull()).cast("double").alias(f"null_{c}") for c in df.columns],
        *[F.count_if(text_or_empty(c) == "").cast("double").alias(f"empty_{c}") for c in texts],
        *[F.avg(word_count(c)).alias(f"mean_words_{c}") for c in texts],
    )
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in row.columns]
    return row.select(F.inline(F.array(*cells)))
