"""Quality rules: fixed limits first, then robust multivariate outliers.

Per document a few counts become a vector of transformed statistics. Per language
and source the minimum covariance determinant is searched: from each start, the rows
nearest to the centre (a fixed share) give the next centre and covariance, over and
over; of the starts the one with the smallest determinant stays. Rows too far from
the centre in Mahalanobis distance are rejected.

Everything is DataFrame expressions. Only counts of documents are shuffled, never
texts; group estimates are sums, combined before the shuffle, so a group may hold
most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.session import materialize

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8

#: Share of a group's rows in the inner set, steps from each start, and rows a group needs.
INNER = 0.75
STEPS = 4
LEAST_ROWS = 60
#: Least standard deviation of each statistic, so that a constant one cannot reject by itself.
LEAST_SPREAD = {"s_words": 0.25, "s_length": 0.05, "s_symbols": 0.4, "s_lines": 0.5, "s_repeats": 0.5, "s_upper": 0.3}
STATS = list(LEAST_SPREAD)
#: Squared distance beyond which a row is rejected, and the chi-square median of six statistics.
CUTOFF = 80.0
CHI_MEDIAN = 5.348


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds the counts of a text; ``docs`` has a ``text`` column. Null counts as no text.

    A window's hash is made of the hashes of its words. Texts without a repeated
    window, most of them, stop at comparing the number of distinct hashes; the
    others sort (hash, place) pairs and add up the places that are covered.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    with_words = docs.withColumn("_t", text).withColumn(
        "_w", F.filter(F.split("_t", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    )
    hashed = with_words.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    windows = hashed.withColumn(
        "_g",
        F.when(
            F.size("_h") >= WINDOW,
            F.transform(
                F.slice("_h", F.lit(1), F.size("_h") - (WINDOW - 1)),
                lambda h, i: F.xxhash64(h, *[F.get(F.col("_h"), i + k) for k in range(1, WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    pairs = F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    repeated = windows.withColumn("_p", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), pairs))
    places = F.array_sort(F.transform(
        F.filter(
            "_p",
            lambda p, k: ((k > 0) & (F.get(F.col("_p"), F.when(k > 0, k - 1).otherwise(0))["g"] == p["g"]))
            | (F.coalesce(F.get(F.col("_p"), k + 1)["g"] == p["g"], F.lit(False))),
        ),
        lambda p: p["i"],
    ))
    placed = repeated.withColumn("_i", places)
    covered = F.aggregate(
        "_i",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct(
            (a["n"] + (i + WINDOW) - F.greatest(a["end"], i)).cast("bigint").alias("n"), (i + WINDOW).alias("end")
        ),
        lambda a: a["n"],
    )
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    counted = placed.withColumn("_l", lines)
    return counted.select(
        *[c for c in docs.columns],
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        (F.length("_t") - F.length(F.translate("_t", UPPER, ""))).cast("long").alias("n_upper"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def with_statistics(counted: DataFrame) -> DataFrame:
    """Adds the transformed statistics; logarithms make their bulk near normal."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return counted.withColumns({
        "s_words": F.log1p("n_words"),
        "s_length": F.log(chars / words),
        "s_symbols": F.log1p(1000 * F.col("n_symbols") / chars),
        "s_lines": F.log1p("n_dup_lines"),
        "s_repeats": F.log1p(100 * F.col("n_repeat_words") / words),
        "s_upper": F.log1p(100 * F.col("n_upper") / chars),
    })


def grouped(rows: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Adds ``_key``: language and source, or for the rows of small groups their language, or else one group for all.

    The rows of small groups are pooled; sizes are counts per group, not rows.
    """
    pair = F.struct(F.coalesce("lang", F.lit("")).alias("l"), F.coalesce("source", F.lit("")).alias("s"))
    keyed = rows.withColumn("_pair", F.to_json(pair)).withColumn("_lang", F.to_json(F.struct(F.coalesce("lang", F.lit("")).alias("l"))))
    sizes = keyed.groupBy("_pair", "_lang").agg(F.count("*").alias("_n"))
    small = sizes.where(F.col("_n") < least_rows).groupBy("_lang").agg(F.sum("_n").alias("_m"))
    choice = sizes.join(small, "_lang", "left").select(
        "_pair",
        F.when(F.col("_n") >= least_rows, F.col("_pair"))
        .when(F.col("_m") >= least_rows, F.col("_lang"))
        .otherwise(F.lit("{}")).alias("_key"),
    )
    return keyed.join(choice, "_pair").drop("_pair", "_lang")


def pairs_of_stats() -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(STATS) for b in STATS[: i + 1]]


def estimates() -> list[Column]:
    """Centre and covariance of the rows at hand, with the least spread added."""
    out = [F.avg(s).alias(f"m_{s}") for s in STATS]
    for a, b in pairs_of_stats():
        cov = F.covar_pop(a, b) + (F.lit(LEAST_SPREAD[a] ** 2) if a == b else F.lit(0.0))
        out.append(cov.alias(f"c_{a}_{b}"))
    return out


def with_factor(params: DataFrame) -> DataFrame:
    """Adds the lower triangular factor of the covariance and the logarithm of its determinant."""
    for i, a in enumerate(STATS):
        for j, b in enumerate(STATS[: i + 1]):
            rest = F.col(f"c_{a}_{b}")
            for k in STATS[:j]:
                rest = rest - F.col(f"l_{a}_{k}") * F.col(f"l_{b}_{k}")
            value = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l_{b}_{b}")
            params = params.withColumn(f"l_{a}_{b}", value)
    logs = [2 * F.log(F.col(f"l_{a}_{a}")) for a in STATS]
    return params.withColumn("logdet", sum(logs[1:], logs[0])).drop(*[f"c_{a}_{b}" for a, b in pairs_of_stats()])


def with_distance(rows: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared distance under the factor that is joined to each row."""
    for i, a in enumerate(STATS):
        rest = F.col(a) - F.col(f"m_{a}")
        for b in STATS[:i]:
            rest = rest - F.col(f"l_{a}_{b}") * F.col(f"z_{b}")
        rows = rows.withColumn(f"z_{a}", rest / F.col(f"l_{a}_{a}"))
    squares = [F.col(f"z_{a}") * F.col(f"z_{a}") for a in STATS]
    return rows.withColumn("d2", sum(squares[1:], squares[0])).drop(*[f"z_{a}" for a in STATS])


def starts(rows: DataFrame) -> DataFrame:
    """Two starts per group: medians with independent spreads, and all rows' centre and covariance."""
    quartiles = [F.percentile_approx(s, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10000).alias(f"q_{s}") for s in STATS]
    middle = rows.groupBy("_key").agg(*quartiles)
    spread = {s: (F.col(f"q_{s}")[2] - F.col(f"q_{s}")[0]) / 1.349 for s in STATS}
    medians = middle.select(
        "_key", F.lit(0).alias("_start"), *[F.col(f"q_{s}")[1].alias(f"m_{s}") for s in STATS],
        *[
            (spread[a] * spread[a] + LEAST_SPREAD[a] ** 2 if a == b else F.lit(0.0)).alias(f"c_{a}_{b}")
            for a, b in pairs_of_stats()
        ],
    )
    whole = rows.groupBy("_key").agg(*estimates()).withColumn("_start", F.lit(1))
    return medians.unionByName(whole)


def robust_estimates(rows: DataFrame, inner: float = INNER, steps: int = STEPS) -> DataFrame:
    """Per ``_key`` the centre, factor and scale with the smallest determinant of the inner rows' covariance.

    Every step is one pass over the statistics. The few numbers of each group are
    written between steps, so plans stay small and a lost executor repeats one step.
    """
    params = materialize(with_factor(starts(rows)), "mcd")
    for _ in range(steps):
        far = with_distance(rows.join(params, "_key")).select("_key", "_start", "d2", *STATS)
        limits = far.groupBy("_key", "_start").agg(F.percentile_approx("d2", F.lit(inner), 10000).alias("_q"))
        near = far.join(limits, ["_key", "_start"]).where(F.col("d2") <= F.col("_q"))
        params = materialize(with_factor(near.groupBy("_key", "_start").agg(*estimates())), "mcd")
    best = params.groupBy("_key").agg(F.min(F.struct("logdet", "_start")).getField("_start").alias("_start"))
    chosen = params.join(best, ["_key", "_start"]).drop("_start")
    scale = with_distance(rows.join(chosen, "_key")).groupBy("_key").agg(
        (F.percentile_approx("d2", F.lit(0.5), 10000) / CHI_MEDIAN).alias("_scale")
    )
    return materialize(chosen.join(scale, "_key"), "mcd")


def judge_quality(docs: DataFrame, cutoff: float = CUTOFF, inner: float = INNER, steps: int = STEPS,
                  least_rows: int = LEAST_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Counts, ``base_failed``, ``distance`` and ``kept`` for every row of ``docs`` (doc_id, text, lang, source).

    Estimates use the rows that pass the base limits. A null or empty text has no
    words and fails the base limits; null languages and sources count as one group;
    null ids and repeated rows stay as they are. Empty tables give no rows. Columns
    in ``keep`` are carried through; others are not read.
    """
    picked = docs.select("doc_id", "lang", "source", "text", *[c for c in keep if c not in ("doc_id", "lang", "source", "text")])
    counted = with_statistics(base_counts(picked).withColumn("base_failed", base_failed()))
    if "text" not in keep:
        counted = counted.drop("text")
    rows = materialize(counted, "quality")
    passed = grouped(rows.where(~F.col("base_failed")).select("lang", "source", *STATS), least_rows)
    stats = materialize(passed.select("_key", "lang", "source", *STATS), "quality")
    found = robust_estimates(stats, inner, steps)
    groups = stats.select("_key", F.coalesce("lang", F.lit("")).alias("_l"), F.coalesce("source", F.lit("")).alias("_s")).distinct()
    limits = groups.join(found, "_key").drop("_key", "logdet")
    judged = with_distance(
        rows.withColumns({"_l": F.coalesce("lang", F.lit("")), "_s": F.coalesce("source", F.lit(""))}).join(limits, ["_l", "_s"], "left")
    )
    distance = F.col("d2") / F.greatest("_scale", F.lit(1.0))
    return judged.withColumn("distance", distance).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)
    ).drop("_l", "_s", "_scale", "d2", *STATS, *[c for c in limits.columns if c.startswith(("m_", "l_"))])
