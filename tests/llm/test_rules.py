"""URL filters and quality rules against plain versions."""

import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import quality_rules, url_filters

WORD = re.compile(r"[^\x20\x09-\x0D]+")
URLS = [
    "https://www.Example.com/en/a.html?x=1&y=2#top", "http://example.com/en/1", "https://EXAMPLE.COM/fr/", "https://a.b.net/es/7",
    "http://net/fr/", "http://notnet/fr/", "http://x.net", "ftp://x.net/es", "no scheme", "", None, "://", "http://com", "http://com/",
    "http://a?b/c", "http://É.org/en/x.PDF", "x://h//es/", "http://h.net/es/a://b.com/", "http://h.org/d/e/f?k=1", "http://h.org/d/e/f?k=1",
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    best = None
    for rule_host, rule_path, says in url_filters.LISTED:
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            if best is None or len(rule_host + rule_path) > len(best[0]):
                best = (rule_host + rule_path, says)
    return best


@pytest.fixture
def pages(spark):
    rows = [(i if i != 3 else None, u) for i, u in enumerate(URLS)] + [(5, URLS[5])]
    df = spark.createDataFrame(rows, "page_id long, url string")
    return df.withColumns({"host": F.lit(1), "tokens": F.lit("clash"), "verdict": F.lit("x"), "bad": F.lit(0)})


def test_listed_rules(spark, pages):
    none = spark.createDataFrame([], "id long, bad boolean")
    got = url_filters.filter_urls(pages, none).collect()
    assert len(got) == len(URLS) + 1
    want = []
    for page, url in [(i if i != 3 else None, u) for i, u in enumerate(URLS)] + [(5, URLS[5])]:
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        want.append((page, host, path, rule and rule[0], rule[1] if rule else "allow"))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)


def test_mined_rules_equal_all_combinations(spark):
    urls = [f"http://h{i % 4}.org/{'ab'[i % 2]}/p{i}{'.html' if i % 3 else ''}" for i in range(48)]
    rows = [(i, u) for i, u in enumerate(urls)]
    bad = [(i, i % 4 == 1 and i % 3 != 0 or i % 16 == 0) for i in range(48)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    parts = url_filters.with_host_and_path(pages)
    tokens = {r["page_id"]: r["t"] for r in parts.select("page_id", url_filters.url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("t")).collect()}
    held = {}
    for i, is_bad in bad:
        for n in range(1, len(tokens[i]) + 1):
            for part in combinations(tokens[i], n):
                both = held.setdefault(part, [0, 0])
                both[0] += 1
                both[1] += is_bad
    base, z2 = sum(b for _, b in bad) / len(bad), url_filters.DEVIATIONS**2

    def least(b, n):
        c = b / n
        return (c + z2 / (2 * n) - (z2 * (c * (1 - c) / n + z2 / (4 * n * n))) ** 0.5) / (1 + z2 / n)

    rules = {p: b / n for p, (n, b) in held.items() if b >= 6 and b / n >= 0.7 and least(b, n) > base}
    got = url_filters.filter_urls(pages, spark.createDataFrame(bad, "id long, bad boolean"), rules=[], min_support=0.01, min_confidence=0.7, min_pages=6)
    verdicts = {r["page_id"]: r["verdict"] for r in got.collect()}
    assert rules and verdicts == {i: "block" if any(set(p) <= set(tokens[i]) for p in rules) else "allow" for i in tokens}


def test_rules_fire_on_the_given_tables(spark):
    """Counts as the plain search over all token combinations gives them (see the SQL twin)."""
    pages, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("pages", "labels"))
    known = labels.select(F.col("doc_id").alias("id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    got = url_filters.filter_urls(pages, known)
    by_rule = got.where("mined_rule IS NOT NULL").groupBy("mined_rule").count().collect()
    assert {r["mined_rule"]: r["count"] for r in by_rule} == {
        "dir=en host=blog.tionsh.example.net scheme=https": 12,
        "dir=en host=blog.tionsh.example.net": 6,
        "dir=en fragment scheme=https": 12,
    }
    assert got.where("mined_rule IS NOT NULL AND rule IS NULL AND verdict = 'block'").count() == 27


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)


TEXTS = [
    None, "", " \n\t", "one two", "a b c d e f g h " * 5, "x " * 30, "a b c d e f g h i a b c d e f g h", "l1 w\nl1 w\n\n \nl1 w\r\n#|<>",
    " ".join(f"w{i}" for i in range(100)) + " " + " ".join(f"w{i}" for i in range(5, 20)), "é😀 ü " * 7, "z" * 50000,
    " ".join(f"q{i}" for i in range(4000)), "x a b c d e f g a b c d e f g a b c d e f g " + " ".join(f"k{i}" for i in range(60)),
]


def test_base_counts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = quality_rules.base_counts(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("f", quality_rules.base_failed())
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "f"]
    assert {r["doc_id"]: tuple(r[c] for c in names) for r in got.collect()} == {i: plain_counts(t) for i, t in rows}


def test_outliers_of_a_group_are_rejected(spark):
    rnd = np.random.default_rng(3)
    words = [f"word{i}" for i in range(500)]
    rows = []
    for i in range(300):
        text = " ".join(rnd.choice(words, rnd.integers(60, 200)))
        rows.append((i, text if i % 30 else re.sub(" ", "### ", text.upper()), "en" if i % 2 else "fr", None if i % 5 == 0 else "hot"))
    rows += [(900, None, None, None), (901, "", "en", "rare"), (5, rows[5][1], "fr", "hot"), (None, rows[7][1], "en", "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({"kept": F.lit("clash"), "_key": F.lit(1), "d2": F.lit(0)})
    got = quality_rules.judge_quality(docs).collect()
    assert len(got) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert all(kept[i] == bool(i % 30) for i in range(300)) and not kept[900] and not kept[901] and kept[None]
    assert sum(r["doc_id"] == 5 for r in got) == 2


def test_distance_equals_the_matrix_form(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(200, len(quality_rules.STATS)))
    rows = spark.createDataFrame([("k", *map(float, r)) for r in x], ["_key", *quality_rules.STATS])
    params = quality_rules.with_factor(rows.groupBy("_key").agg(*quality_rules.estimates()))
    got = [r["d2"] for r in quality_rules.with_distance(rows.join(params, "_key")).orderBy(quality_rules.STATS[0]).collect()]
    cov = np.cov(x.T, bias=True) + np.diag([quality_rules.LEAST_SPREAD[s] ** 2 for s in quality_rules.STATS])
    off = x[np.argsort(x[:, 0])] - x.mean(axis=0)
    assert np.allclose(got, np.einsum("id,de,ie->i", off, np.linalg.inv(cov), off))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality_rules.judge_quality(none).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.filter_urls(pages, spark.createDataFrame([], "id long, bad boolean")).count() == 0
