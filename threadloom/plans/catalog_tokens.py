"""Queries on text functions, tokens, stop words and language."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom import reference_tables as ref
from threadloom.functions import text as tx, tokens as tk
from threadloom.operators import features as feat
from threadloom.operators.stems import stem_tokens
from threadloom.plans.catalog_corpus import NON_SPACE, SPACE, sql_clean
from threadloom.plans.registry import query
from threadloom.plans.tables import PROFILES, detected, with_ctes


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(quoted(w) for w in words) + ")"


TAIL = " I’m sure it's 100 mg or 10 mg, (can't've) 250 % http://x.y/z [removed] <b> so i'm sad — Ma'am "
DECORATED = f"text || {quoted(TAIL)} || CAST(doc_id AS VARCHAR) || ' mg'"
CONTRACTION_RE = "(" + "|".join(ref.CONTRACTIONS) + ")"
CONTRACTION_MAP = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in ref.CONTRACTIONS.items()) + "}"


def decorated(t):
    return t.texts().select(
        "doc_id", F.concat("text", F.lit(TAIL), F.col("doc_id").cast("string"), F.lit(" mg")).alias("text")
    )


def joined(c, name="tokens"):
    return F.md5(F.array_join(c, " ")).alias(name)


def size(c, name="n"):
    return F.size(c).cast("bigint").alias(name)


@query("clean_text", f"SELECT doc_id, md5({sql_clean('t')}) AS clean FROM (SELECT doc_id, text || ' See HTTP://a.b/c www.x.org/q u/Bob-1 you/me  OK' AS t FROM documents)")
def clean_text(t):
    docs = t.texts().select(
        "doc_id", F.concat("text", F.lit(" See HTTP://a.b/c www.x.org/q u/Bob-1 you/me  OK")).alias("text")
    )
    return docs.select("doc_id", F.md5(tx.clean_text("text")).alias("clean"))


@query(
    "contractions",
    f"""WITH s AS (SELECT doc_id, lower({DECORATED}) AS t FROM documents),
    p AS (SELECT doc_id, regexp_split_to_array(t, {quoted(CONTRACTION_RE)}) AS gaps, regexp_extract_all(t, {quoted(CONTRACTION_RE)}) AS hits FROM s)
    SELECT doc_id, md5(list_aggregate(list_transform(range(1, len(gaps) + 1), lambda i: gaps[i] || coalesce({CONTRACTION_MAP}[hits[i]], '')), 'string_agg', '')) AS expanded FROM p""",
)
def contractions(t):
    return decorated(t).select("doc_id", F.md5(tx.expand_contractions("text")).alias("expanded"))


def _nested_replace(c: str) -> str:
    for k, v in ref.SCORER_CONTRACTIONS.items():
        c = f"replace({c}, {quoted(k)}, {quoted(v)})"
    return c


@query("contractions_sequential", f"SELECT doc_id, md5({_nested_replace(DECORATED)}) AS expanded FROM documents")
def contractions_sequential(t):
    return decorated(t).select("doc_id", F.md5(tx.expand_sequential("text")).alias("expanded"))


@query(
    "remove_urls",
    r"SELECT page_id, md5(regexp_replace(url || ' ' || html, 'http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+', '', 'g')) AS cleaned FROM pages",
)
def remove_urls(t):
    return t.read("pages").select("page_id", F.md5(tx.remove_urls(F.concat_ws(" ", "url", "html"))).alias("cleaned"))


_CONTR = "contr(k, v) AS (VALUES " + ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in ref.CONTRACTIONS.items()) + ")"
_FRAGMENTS = " OR ".join(f"contains(w, {quoted(f)})" for f in ref.NORMALISER_FRAGMENTS)
NORMALIZED = f"""raw AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM (SELECT doc_id, regexp_extract_all(t, '{NON_SPACE}+') AS ws FROM src)),
low AS (SELECT doc_id, pos, lower(trim(translate(w, {quoted(ref.CURLY)}, {quoted(ref.STRAIGHT)}), {quoted(ref.NORMALISER_TRIM)})) AS w FROM raw),
near AS (SELECT *, lag(w) OVER o AS p, lead(w) OVER o AS n FROM low WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
norm AS (SELECT doc_id, pos, CASE
    WHEN w = '' THEN NULL
    WHEN k IS NOT NULL THEN v
    WHEN w IN {in_list(ref.NORMALISER_JUNK)} OR {_FRAGMENTS} OR starts_with(w, '<') OR ends_with(w, '>') OR w IN {in_list(ref.NORMALISER_LITERALS)} THEN NULL
    WHEN w IN {in_list(ref.UNITS)} AND coalesce(regexp_matches(p, '^\\p{{Nd}}{{3,}}$'), false) THEN p || w
    WHEN regexp_matches(w, '^\\p{{Nd}}{{3,}}$') AND coalesce(n IN {in_list(ref.UNITS)}, false) THEN NULL
    WHEN length(w) < 3 AND w NOT IN {in_list(ref.KEEP_SHORT)} THEN NULL
    ELSE w END AS tok FROM near LEFT JOIN contr ON k = w)"""


@query(
    "normalize_tokens",
    with_ctes(
        f"src AS (SELECT doc_id, {DECORATED} AS t FROM documents)", _CONTR, NORMALIZED,
        "SELECT doc_id, md5(string_agg(tok, ' ' ORDER BY pos)) AS tokens, CAST(sum(1 + length(tok) - length(replace(tok, ' ', ''))) AS BIGINT) AS n FROM norm WHERE tok IS NOT NULL GROUP BY doc_id",
    ),
)
def normalize_tokens(t):
    return decorated(t).withColumn("k", tk.normalize_tokens("text")).select("doc_id", joined("k"), size("k"))


@query(
    "join_units",
    with_ctes(
        "src AS (SELECT item_id AS doc_id, CAST(item_id * 41 AS VARCHAR) || ' mg ' || text || ' 500 kg 12 bpm 300 mcg mg' AS t FROM benchmark)", _CONTR, NORMALIZED,
        r"SELECT doc_id, string_agg(tok, ' ' ORDER BY pos) AS glued FROM norm WHERE regexp_matches(tok, '^\d+(mg|mcg|bpm|kg|lbs|%)$') GROUP BY doc_id",
    ),
)
def join_units(t):
    items = t.read("benchmark").select(
        F.col("item_id").alias("doc_id"),
        F.concat((F.col("item_id") * 41).cast("string"), F.lit(" mg "), "text", F.lit(" 500 kg 12 bpm 300 mcg mg")).alias("text"),
    )
    glued = F.filter(tk.normalize_tokens("text"), lambda w: w.rlike(r"^\d+(mg|mcg|bpm|kg|lbs|%)$"))
    return items.select("doc_id", F.array_join(glued, " ").alias("glued"))


def sql_simple(source: str) -> str:
    return (
        f"list_filter(list_transform(regexp_extract_all({source}, '{NON_SPACE}+'), "
        f"lambda w: lower(trim(w, {quoted(ref.TOKENIZER_TRIM)}))), "
        f"lambda w: w <> '' AND w NOT IN {in_list(ref.TOKENIZER_JUNK)} AND (length(w) >= 3 OR w IN {in_list(ref.KEEP_SHORT)}))"
    )


@query("simple_tokens", f"SELECT doc_id, md5(array_to_string(k, ' ')) AS tokens, len(k) AS n FROM (SELECT doc_id, {sql_simple(DECORATED)} AS k FROM documents)")
def simple_tokens(t):
    return decorated(t).withColumn("k", tk.simple_tokens("text")).select("doc_id", joined("k"), size("k"))


@query("alpha_tokens", "SELECT doc_id, md5(array_to_string(k, ' ')) AS tokens, len(k) AS n FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS k FROM documents)")
def alpha_tokens(t):
    return t.texts().withColumn("k", tk.alpha_tokens("text")).select("doc_id", joined("k"), size("k"))


@query(
    "casual_tokens",
    f"SELECT doc_id, md5(array_to_string(k, ' ')) AS tokens, len(k) AS n FROM (SELECT doc_id, list_transform(regexp_extract_all({DECORATED}, {quoted(tk.CASUAL_PATTERN)}), lambda w: lower(w)) AS k FROM documents)",
)
def casual_tokens(t):
    return decorated(t).withColumn("k", tk.casual_tokens("text")).select("doc_id", joined("k"), size("k"))


@query("strip_digits", "SELECT page_id, md5(array_to_string(list_transform(string_split(url, '/'), lambda w: regexp_replace(w, '[0-9]+', '', 'g')), ' ')) AS tokens FROM pages")
def strip_digits(t):
    return t.read("pages").select("page_id", joined(tk.strip_digits(F.split("url", "/"))))


_STOPS = ["the", "and", "of", "le", "la", "der", "ou"]


@query(
    "filter_stops",
    f"""SELECT doc_id, md5(array_to_string(k, ' ')) AS tokens, len(k) AS n FROM (SELECT doc_id, list_filter(string_split(lower(text), ' '),
      lambda w: w NOT IN {in_list(_STOPS + ref.ASCII_PUNCTUATION)} AND length(w) > 1) AS k FROM documents)""",
)
def filter_stops(t):
    toks = tk.filter_stops(F.split(F.lower("text"), " "), _STOPS)
    return t.texts().withColumn("k", toks).select("doc_id", joined("k"), size("k"))


@query(
    "light_filter",
    f"""SELECT doc_id, md5(array_to_string(k, ' ')) AS tokens, len(k) AS n FROM (SELECT doc_id, list_filter(regexp_extract_all(text || ' really <cmt> just', '{NON_SPACE}+'),
      lambda w: w NOT IN {in_list(ref.CUSTOM_STOPS)} AND length(w) > 1) AS k FROM documents)""",
)
def light_filter(t):
    toks = tk.light_filter(tx.words(F.concat("text", F.lit(" really <cmt> just"))))
    return t.texts().withColumn("k", toks).select("doc_id", joined("k"), size("k"))


@query(
    "lemmas",
    """WITH lem(word, lemma) AS (VALUES ('is', 'be'), ('are', 'be'), ('having', 'have'), ('les', 'le'), ('the', 'thee')),
    raw AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM documents))
    SELECT doc_id, md5(string_agg(coalesce(lemma, w), ' ' ORDER BY pos)) AS tokens FROM raw LEFT JOIN lem ON word = w GROUP BY doc_id""",
)
def lemmas(t):
    table = t.spark.createDataFrame(
        [("is", "v", "be"), ("are", "v", "be"), ("having", "v", "have"), ("les", "n", "le"), ("the", "a", "thee"), ("are", "n", "are-unit")],
        "word string, pos string, lemma string",
    )
    docs = t.texts().select("doc_id", tk.alpha_tokens("text").alias("k"))
    return feat.lemmatize(docs, "doc_id", "k", table).where(F.size("lemmas") > 0).select("doc_id", joined("lemmas"))


@query("stems")
def stems(t):
    """Distinct words of the documents with their stems."""
    vocab = t.texts().select(F.explode(tk.alpha_tokens("text")).alias("word")).distinct()
    return vocab.select("word", F.get(stem_tokens(F.array("word")), 0).alias("stem"))


@query("process_text")
def process_text(t):
    out = feat.process_text(t.texts(), "text")
    return out.select("doc_id", joined("tokens"), size("tokens"))


@query("process_text_tfidf")
def process_text_tfidf(t):
    out = feat.process_text_tfidf(t.texts(), "doc_id", "text", ["ation"])
    return out.select("doc_id", joined("tokens"), size("tokens"))


PARAGRAPHS = f"""list_filter(list_transform(regexp_split_to_array(t, '\\n{{2,}}'), lambda p: regexp_replace(p, '^{SPACE}+|{SPACE}+$', '', 'g')), lambda p: p <> '')"""
# documents hold single line ends; every second one becomes a paragraph break
PARA_SRC = "regexp_replace(text, '\\.\\n', '.' || chr(10) || chr(10), 'g')"


def with_breaks(t):
    return t.texts().select("doc_id", F.replace("text", F.lit(".\n"), F.lit(".\n\n")).alias("text"))


@query(
    "paragraphs",
    f"SELECT doc_id, len(p) AS n, md5(array_to_string(p, '|')) AS paras FROM (SELECT doc_id, {PARAGRAPHS} AS p FROM (SELECT doc_id, {PARA_SRC} AS t FROM documents))",
)
def paragraphs(t):
    return with_breaks(t).withColumn("p", tx.paragraphs("text")).select(
        "doc_id", size("p"), F.md5(F.array_join("p", "|")).alias("paras")
    )


PARA_TERMS = f"""paras AS (SELECT doc_id, len(p) AS n, unnest(p) AS para, unnest(range(len(p))) AS i FROM (SELECT doc_id, {PARAGRAPHS} AS p FROM (SELECT doc_id, {PARA_SRC} AS t FROM documents))),
terms AS (SELECT DISTINCT doc_id, n, i, unnest(regexp_extract_all(lower(para), '[\\p{{L}}\\p{{N}}\\p{{M}}_]{{2,}}')) AS term FROM paras)"""


@query(
    "auto_stop_by_doc",
    with_ctes(
        PARA_TERMS,
        "idfs AS (SELECT doc_id, term, ln((1.0 + max(n)) / (1.0 + count(*))) + 1 AS idf FROM terms GROUP BY doc_id, term)",
        "cuts AS (SELECT doc_id, quantile_cont(idf, 0.1) AS cut FROM idfs GROUP BY doc_id)",
        "SELECT doc_id, count(*) AS n, round(max(idf), 6) AS max_idf FROM idfs JOIN cuts USING (doc_id) WHERE idf <= cut GROUP BY doc_id",
    ),
)
def auto_stop_by_doc(t):
    out = feat.auto_stop_by_doc(with_breaks(t), "doc_id", "text")
    return out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("idf"), 6).alias("max_idf"))


@query(
    "auto_stop_corpus",
    with_ctes(
        PARA_TERMS,
        "total AS (SELECT count(*) AS n FROM paras)",
        "idfs AS (SELECT term, count(*) AS df, ln((1.0 + (SELECT n FROM total)) / (1.0 + count(*))) + 1 AS idf FROM terms GROUP BY term)",
        "SELECT term, df, round(idf, 6) AS idf FROM idfs WHERE idf <= (SELECT quantile_cont(idf, 0.1) FROM idfs)",
    ),
)
def auto_stop_corpus(t):
    return feat.auto_stop_corpus(with_breaks(t), "text").withColumn("idf", F.round("idf", 6))


@query(
    "stop_table",
    f"""WITH w AS (SELECT unnest([{', '.join(quoted(w) for w in ref.CUSTOM_STOPS)}]) AS word UNION SELECT unnest([{', '.join(quoted(w) for w in ref.DOMAIN_STOPS)}])),
    n AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)
    SELECT word, count(*) AS n FROM n JOIN w USING (word) GROUP BY word""",
)
def stop_table(t):
    """How often the united stop words occur."""
    table = feat.stop_table(t.spark, ref.CUSTOM_STOPS, ref.DOMAIN_STOPS)
    words = t.texts().select(F.explode(tk.alpha_tokens("text")).alias("word"))
    return words.join(F.broadcast(table), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "url_flags",
    "SELECT page_id, contains(lower(html), 'http') AS has_url, contains(lower(url), 'anx') OR contains(lower(url), 'panic') AS is_anx FROM pages",
)
def url_flags(t):
    return t.read("pages").select("page_id", tx.has_url("html").alias("has_url"), tx.is_anxiety_category("url").alias("is_anx"))


@query(
    "permalink_id",
    """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR) ELSE 'plain-' || source END AS post_id FROM documents""",
)
def permalink_id(t):
    i = F.col("doc_id")
    link = F.when(i % 2 == 0, F.concat(F.lit("https://h/r/"), "source", F.lit("/comments/"), i.cast("string"), F.lit("/title/"))).otherwise(
        F.concat(F.lit("plain-"), "source")
    )
    return t.texts().select("doc_id", tx.post_id_from_url(link).alias("post_id"))


@query(
    "smart_truncate",
    """SELECT doc_id, CASE WHEN length(text) <= 100 THEN text ELSE substring(text, 1, 58) || '...[truncated]...' || right(text, 25) END AS cut,
      length(text) // 3 AS est_tokens, CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END AS preview FROM documents""",
)
def smart_truncate(t):
    return t.texts().select(
        "doc_id", tx.smart_truncate("text", 100).alias("cut"), tx.estimate_tokens("text").alias("est_tokens"),
        tx.preview("text").alias("preview"),
    )


@query(
    "topic_label",
    """WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS k FROM documents),
    p AS (SELECT doc_id, k, CASE WHEN len(list_filter(k, lambda x: length(x) > 2)) > 0 THEN list_filter(k, lambda x: length(x) > 2) ELSE k END AS f FROM w),
    j AS (SELECT doc_id, k, array_to_string(list_slice(f, 1, 3), ' / ') AS s FROM p)
    SELECT doc_id, CASE WHEN len(k) = 0 THEN 'empty_topic' WHEN length(s) > 20 THEN substring(s, 1, 20) || '...' ELSE s END AS label FROM j""",
)
def topic_label(t):
    return t.texts().select("doc_id", tx.topic_label(tk.alpha_tokens("text"), 3, 20).alias("label"))


@query(
    "lang_id",
    with_ctes(PROFILES, detected("found", "documents", "doc_id", "text", 0), "SELECT k AS doc_id, l AS detected FROM found"),
)
def lang_id(t):
    docs = t.texts().select("doc_id", feat.lang_column("text", t.profiles()).alias("detected"))
    return docs.where(F.col("detected").isNotNull())
