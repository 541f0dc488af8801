"""URL filters: listed rules first, then association rules mined from labels.

Every URL becomes a set of tokens (scheme, host, domain, top-level domain, first
directory, file extension, query keys, fragment). FP-growth over the labelled URLs
finds token combinations; those that imply the bad label more often than not, and
surely more often than any URL does, become rules.
A rule is posted in an inverted index under its rarest token, so a URL meets only
the rules whose rarest token it holds, and the rest of the rule is then compared.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BAD = "label=bad"

#: (host, path, verdict), as stated for the query.
LISTED = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Least share of the labelled URLs, least number of them, and least share of bad ones among those that a rule fits.
MIN_SUPPORT = 0.002
MIN_PAGES = 5
MIN_CONFIDENCE = 0.5
#: Deviations of the lower bound of a rule's confidence, which must lie above the share of bad URLs in all.
DEVIATIONS = 1.96
#: Parts over which pages with one token set are dealt.
SALTS = 32


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one and for null."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; both empty where the URL is null or has no ``://``."""
    rest = after_scheme(F.col(url))
    return pages.withColumn("_rest", rest).withColumns({
        "host": ascii_lower(F.regexp_extract("_rest", r"^([^/?#]*)", 1)),
        "path": F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1),
    }).drop("_rest")


def listed_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, rule_host + rule_path).otherwise(text)
        verdict = F.when(fits, says).otherwise(verdict)
    return text, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL, sorted; empty without a host."""
    def tagged(tag: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(tag + "="), value))

    first_dir = F.regexp_extract(path, r"^/([^/]+)/", 1)
    extension = ascii_lower(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1))
    arguments = F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1)
    keys = F.transform(
        F.regexp_extract_all(arguments, F.lit(r"(?:^|&)([^=&]+)"), F.lit(1)), lambda k: F.concat(F.lit("key="), k)
    )
    single = F.array_compact(F.array(
        tagged("scheme", ascii_lower(F.regexp_extract(url, r"^([^:]*)://", 1))),
        tagged("host", host),
        tagged("domain", F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)),
        tagged("tld", F.regexp_extract(host, r"([^.]+)$", 1)),
        tagged("dir", first_dir),
        tagged("ext", extension),
        F.when(F.contains(url, F.lit("#")), F.lit("fragment")),
    ))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.concat(single, keys))))


def lower_bound(bad: Column, held: Column, deviations: float = DEVIATIONS) -> Column:
    """Lower end of the score interval for the share ``bad / held``."""
    z2 = deviations * deviations
    share = bad / held
    spread = F.sqrt(share * (1 - share) / held + z2 / (4 * held * held))
    return (share + z2 / (2 * held) - deviations * spread) / (1 + z2 / held)


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               min_pages: int = MIN_PAGES, deviations: float = DEVIATIONS) -> DataFrame:
    """Rules (antecedent, confidence, support, n_bad, posted_under) from ``labelled`` (tokens, bad).

    A rule is pruned by support: the bad URLs that hold all of its tokens must be a
    share of the labelled ones and a number. It is pruned by confidence: at least
    ``min_confidence``, and its lower bound above the share of bad URLs in all.
    An empty or unlabelled table gives no rules.
    """
    transactions = labelled.where(F.size("tokens") > 0).select(
        "bad", F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items")
    )
    total, all_bad = transactions.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    support = min(1.0, max(min_support, (min_pages - 0.5) / max(total, 1)))  # a half less, as shares are rounded up
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(transactions)
    counts = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("item"), "freq")
    n_bad = F.round(F.col("support") * total)
    held = F.round(F.col("support") * total / F.col("confidence"))
    rules = (
        model.associationRules.where(F.col("consequent")[0] == BAD)
        .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support", n_bad.cast("long").alias("n_bad"))
        .where((F.col("n_bad") >= min_pages) & (lower_bound(n_bad, held, deviations) > all_bad / max(total, 1)))
    )
    rarest = (
        rules.select("antecedent", F.explode("antecedent").alias("item"))
        .join(counts, "item")
        .groupBy("antecedent")
        .agg(F.min(F.struct("freq", "item")).getField("item").alias("posted_under"))
    )
    return rules.join(rarest, "antecedent")


def match_rules(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The strongest rule for each of the distinct ``tokens`` that fits one.

    Columns: tokens, mined_rule (its tokens joined by a blank), mined_confidence.
    """
    index = rules.select("posted_under", "antecedent", "confidence")
    hits = (
        token_sets.select("tokens", F.explode("tokens").alias("posted_under"))
        .join(index, "posted_under")
        .where(F.size(F.array_except("antecedent", "tokens")) == 0)
    )
    best = F.max(F.struct(F.col("confidence").alias("c"), (-F.size("antecedent")).alias("n"), F.concat_ws(" ", "antecedent").alias("r")))
    return hits.groupBy("tokens").agg(best.alias("best")).select(
        "tokens", F.col("best.r").alias("mined_rule"), F.col("best.c").alias("mined_confidence")
    )


def filter_urls(pages: DataFrame, labels: DataFrame, rules=LISTED, min_support: float = MIN_SUPPORT,
                min_confidence: float = MIN_CONFIDENCE, min_pages: int = MIN_PAGES, id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """A verdict for every page: page_id, host, path, rule, verdict, mined_rule.

    ``labels`` has one row or more per id, with ``bad``. The listed rule decides
    where one fits; else a mined rule that fits blocks; else the page is allowed.
    A null URL or one without ``://`` has an empty host and path, no tokens and the
    verdict allow. Repeated rows and ids give repeated rows; a null id stays null
    and has no label. An empty page table gives no rows, an empty label table no
    mined rules. Other columns are not read. Pages with one token set are dealt over
    ``SALTS`` parts before they meet its rule.
    """
    picked = with_host_and_path(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")))
    tokened = picked.withColumn("tokens", url_tokens(F.col("url"), F.col("host"), F.col("path")))
    known = labels.select(F.col("id").alias("page_id"), "bad").where(F.col("bad").isNotNull())
    rules_found = mine_rules(tokened.select("page_id", "tokens").join(known, "page_id"), min_support, min_confidence, min_pages)
    matched = match_rules(tokened.select("tokens").distinct(), rules_found)
    copies = matched.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = tokened.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    text, listed = listed_rule(F.col("host"), F.col("path"), rules)
    return dealt.join(copies, ["tokens", "_salt"], "left").select(
        "page_id", "host", "path", text.alias("rule"),
        F.coalesce(listed, F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "mined_rule",
    )
