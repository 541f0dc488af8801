"""Queries on vocabulary, TF-IDF, topics and coherence."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom import reference_tables as ref
from threadloom.config import NmfConfig, VocabConfig
from threadloom.functions import tokens as tk
from threadloom.operators import density, features as feat, merge, models, profile, topics as tp
from threadloom.plans.catalog_tokens import in_list, size
from threadloom.plans.registry import query
from threadloom.plans.tables import with_ctes
from threadloom.session import discard, materialize

# Documents with tokens and a fixed topic, one of them the outlier topic -1.
DOCS = """docs AS (SELECT doc_id, source, CAST(n_chars % 6 - 1 AS INTEGER) AS topic, regexp_extract_all(lower(text), '[a-z]+') AS toks FROM documents)"""
LONG = """docs AS (SELECT doc_id, source, CAST(n_chars % 6 - 1 AS INTEGER) AS topic, list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda w: length(w) >= 6) AS toks FROM documents)"""
FLAT = "flat AS (SELECT doc_id, topic, unnest(toks) AS term, unnest(range(len(toks))) AS pos FROM docs)"
CELLS = """cells AS (SELECT topic, term, count(*) AS tf FROM flat GROUP BY topic, term)"""
TOP = """top AS (SELECT topic, term, n, rank FROM (SELECT topic, term, tf AS n, row_number() OVER (PARTITION BY topic ORDER BY tf DESC, term) AS rank FROM cells) WHERE rank <= 8 AND topic >= 0)"""

# up to three words of more than two letters, or of any length if a topic has no longer ones
LABELS = """k AS (SELECT topic, list(term ORDER BY rank) AS k FROM top GROUP BY topic),
f AS (SELECT topic, CASE WHEN len(list_filter(k, lambda x: length(x) > 2)) > 0 THEN list_filter(k, lambda x: length(x) > 2) ELSE k END AS f FROM k),
j AS (SELECT topic, array_to_string(list_slice(f, 1, 3), ' / ') AS s FROM f)"""


def docs(t, min_len: int = 1):
    toks = tk.alpha_tokens("text")
    if min_len > 1:
        toks = F.filter(toks, lambda w: F.length(w) >= min_len)
    return t.texts().select(
        "doc_id", "source", (F.col("n_chars") % 6 - 1).cast("int").alias("topic"), toks.alias("toks")
    )


def top_words(t, d, n: int = 8):
    return feat.top_tokens(d.where("topic >= 0"), "topic", "toks", n)


def r6(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, 6))
    return df


@query("doc_freq", with_ctes(DOCS, FLAT, "SELECT term, count(DISTINCT doc_id) AS df FROM flat GROUP BY term"))
def doc_freq(t):
    return feat.doc_freq(docs(t), "toks")


@query("top_tokens", with_ctes(DOCS, FLAT, CELLS, TOP, "SELECT topic, term, n, CAST(rank AS INTEGER) AS rank FROM top"))
def top_tokens(t):
    return top_words(t, docs(t))


@query(
    "ngrams",
    with_ctes(
        DOCS, FLAT,
        "g AS (SELECT doc_id, term AS a, lead(term) OVER w AS b, lead(term, 2) OVER w AS c FROM flat WINDOW w AS (PARTITION BY doc_id ORDER BY pos))",
        """u AS (SELECT doc_id, a AS g FROM g UNION ALL SELECT doc_id, a || ' ' || b FROM g WHERE b IS NOT NULL UNION ALL SELECT doc_id, a || ' ' || b || ' ' || c FROM g WHERE c IS NOT NULL)""",
        "SELECT doc_id, md5(string_agg(g, '|' ORDER BY g)) AS grams, count(*) AS n FROM u GROUP BY doc_id",
    ),
)
def ngrams(t):
    # a text has n-grams if it has a word; sort_array orders without calling a comparison function
    some = docs(t).where(F.size("toks") > 0)
    out = some.withColumn("g", F.sort_array(tk.ngrams("toks", 1, 3)))
    return out.select("doc_id", F.md5(F.array_join("g", "|")).alias("grams"), size("g"))


VOCAB_STOPS = ["the", "and", "of"]
TOPIC_VOCAB = VocabConfig()
TERMS = f"""kept AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS pos FROM flat WHERE term NOT IN {in_list(VOCAB_STOPS)}),
grams AS (SELECT doc_id, term FROM kept UNION ALL SELECT doc_id, term || ' ' || nxt FROM (SELECT doc_id, term, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM kept) WHERE nxt IS NOT NULL),
dt AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
vocab AS (SELECT *, row_number() OVER (ORDER BY term) - 1 AS term_id, ln((1 + nd) / (1.0::DOUBLE + df)) + 1 AS idf FROM
  (SELECT term, count(*) AS df, sum(tf) AS tf, (SELECT count(*) FROM documents) AS nd FROM dt GROUP BY term
   HAVING count(*) >= 12 AND count(*) <= 0.4::DOUBLE * (SELECT count(*) FROM documents) ORDER BY sum(tf) DESC, term LIMIT 10000))"""


def _terms(t):
    return feat.model_terms(docs(t), "doc_id", "toks", VOCAB_STOPS, TOPIC_VOCAB)


def _vocab(t, terms):
    n = t.texts().agg(F.count(F.lit(1)).alias("n")).scalar()
    return feat.fit_vocab(terms, n, TOPIC_VOCAB)


@query("vocabulary", with_ctes(DOCS, FLAT, TERMS, "SELECT term, df, CAST(tf AS BIGINT) AS tf, CAST(term_id AS INTEGER) AS term_id, round(idf, 6) AS idf FROM vocab"))
def vocabulary(t):
    return r6(_vocab(t, _terms(t)), "idf")


@query(
    "tfidf",
    with_ctes(
        DOCS, FLAT, TERMS,
        "w AS (SELECT doc_id, term, (1 + ln(dt.tf)) * idf AS w FROM dt JOIN vocab USING (term))",
        "SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w",
    ),
)
def tfidf(t):
    base = materialize(docs(t).select("doc_id", "toks"), "tokens")  # read for the vocabulary and for the counts
    vocab, cells = feat.fit_terms(base, "doc_id", "toks", VOCAB_STOPS, TOPIC_VOCAB)
    discard(base)
    return r6(feat.counted_tfidf(cells, vocab, "doc_id").select("doc_id", "term", "weight"), "weight")


@query(
    "lift_terms",
    with_ctes(
        DOCS, FLAT, CELLS,
        "sums AS (SELECT term, sum(tf) AS s FROM cells GROUP BY term)",
        """SELECT topic, term, CAST(rank AS INTEGER) AS rank, round(lift, 6) AS lift FROM (SELECT topic, term, tf / (s + 2.220446049250313e-16) AS lift,
          row_number() OVER (PARTITION BY topic ORDER BY tf / (s + 2.220446049250313e-16) DESC, term) AS rank FROM cells JOIN sums USING (term)) WHERE rank <= 12""",
    ),
)
def lift_terms(t):
    cells = _cells(t)
    sums = cells.groupBy("term").agg(F.sum("weight").alias("term_sum"))
    return r6(tp.top_terms_by_lift(cells, sums).select("topic", "term", "rank", "lift"), "lift")


def _cells(t):
    cells = tp.c_tfidf(docs(t), "topic", "toks").select("topic", "term", F.col("tf").cast("double").alias("weight"))
    return materialize(cells, "topic-words")


@query("cross_topic_stops", with_ctes(DOCS, FLAT, CELLS, TOP, "SELECT term, count(*) AS n_topics FROM top GROUP BY term HAVING count(*) >= 2"))
def cross_topic_stops(t):
    return tp.auto_cross_stop(top_words(t, docs(t)), 5)


@query(
    "topic_similarity",
    with_ctes(
        DOCS, FLAT, CELLS,
        "norms AS (SELECT topic, sqrt(sum(tf * tf)) AS n FROM cells GROUP BY topic)",
        """SELECT a.topic AS i, b.topic AS j, round(coalesce(sum(x.tf * y.tf), 0) / (any_value(a.n) * any_value(b.n)), 6) AS sim
        FROM norms a JOIN norms b ON a.topic < b.topic JOIN cells x ON x.topic = a.topic LEFT JOIN cells y ON y.topic = b.topic AND y.term = x.term GROUP BY a.topic, b.topic""",
    ),
)
def topic_similarity(t):
    return r6(tp.topic_similarity(_cells(t)).select("i", "j", "sim"), "sim")


@query(
    "mean_topic_cosine",
    with_ctes(
        DOCS, FLAT, CELLS,
        "norms AS (SELECT topic, sqrt(sum(tf * tf)) AS n FROM cells GROUP BY topic)",
        """sims AS (SELECT coalesce(sum(x.tf * y.tf), 0) / (any_value(a.n) * any_value(b.n)) AS sim
        FROM norms a JOIN norms b ON a.topic < b.topic JOIN cells x ON x.topic = a.topic LEFT JOIN cells y ON y.topic = b.topic AND y.term = x.term GROUP BY a.topic, b.topic)""",
        "SELECT round(avg(sim), 6) AS mean_cosine FROM sims",
    ),
)
def mean_topic_cosine(t):
    return r6(tp.mean_topic_cosine(_cells(t)), "mean_cosine")


@query(
    "centroid_similarity",
    """WITH flat AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS pos FROM embeddings WHERE label IN (SELECT label FROM embeddings GROUP BY label ORDER BY count(*) DESC, label LIMIT 30)),
    m AS (SELECT label, pos, avg(x) AS x FROM flat GROUP BY label, pos),
    n AS (SELECT label, sqrt(sum(x * x)) AS n FROM m GROUP BY label)
    SELECT a.label AS i, b.label AS j, round(sum(a.x * b.x) / (any_value(na.n) * any_value(nb.n)), 5) AS sim FROM m a JOIN m b ON a.pos = b.pos AND a.label < b.label
    JOIN n na ON na.label = a.label JOIN n nb ON nb.label = b.label GROUP BY a.label, b.label""",
)
def centroid_similarity(t):
    out = tp.centroid_similarity(t.read("embeddings"), "label", "embedding")
    return out.select("i", "j", F.round("sim", 5).alias("sim"))


WEIGHTS = """wts AS (SELECT doc_id, n_chars % 7 + 1.0 AS a, doc_id % 5 + 0.0 AS b, n_chars % 11 + 0.0 AS c FROM documents),
asg AS (SELECT doc_id, CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS topic, greatest(a, b, c)::DOUBLE / (a + b + c)::DOUBLE AS conf FROM wts)"""
NAMES = {0: "alpha", 1: "beta", 2: "gamma"}


def weighted(t):
    w = F.array(F.col("n_chars") % 7 + 1.0, F.col("doc_id") % 5 + 0.0, F.col("n_chars") % 11 + 0.0)
    return t.texts().select("doc_id", "text", w.alias("topics"))


def names(t):
    return t.spark.createDataFrame(list(NAMES.items()), "topic int, topic_name string")


@query(
    "assign_topics",
    with_ctes(WEIGHTS, "SELECT doc_id, topic, round(conf, 6) AS conf, CASE topic WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END AS topic_name FROM asg"),
)
def assign_topics(t):
    return r6(tp.assign_topics(weighted(t), names(t)).select("doc_id", "topic", "conf", "topic_name"), "conf")


@query("purity", with_ctes(WEIGHTS, "SELECT round(avg(CAST(conf >= 0.5 AS INTEGER)), 6) AS purity FROM asg"))
def purity(t):
    return r6(tp.purity(weighted(t), threshold=0.5), "purity")


@query(
    "topic_stats",
    with_ctes(
        WEIGHTS,
        """SELECT topic, count(*) AS n, round(avg(conf), 3) AS avg_confidence, round(stddev_samp(conf), 3) AS conf_std,
          round(avg(len(regexp_extract_all(lower(text), '[a-z]+'))), 3) AS avg_doc_length, CASE topic WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END AS topic_name
        FROM asg JOIN documents USING (doc_id) GROUP BY topic""",
    ),
)
def topic_stats(t):
    assigned = tp.assign_topics(weighted(t), names(t)).drop("topic_name")
    return tp.topic_stats(assigned, names(t), F.size(tk.alpha_tokens("text")))


@query(
    "attach_topics",
    with_ctes(WEIGHTS, "SELECT doc_id AS post_id, topic FROM documents LEFT JOIN (SELECT * FROM asg WHERE conf >= 0.5) USING (doc_id)"),
)
def attach_topics(t):
    """Documents left out of the model keep a null topic."""
    modelled = tp.assign_topics(weighted(t), names(t)).where("conf >= 0.5").select(F.col("doc_id").alias("post_id"), "topic")
    return merge.attach_topics(t.texts().select(F.col("doc_id").alias("post_id")), modelled)


@query(
    "topic_names",
    with_ctes(
        DOCS, FLAT, CELLS, TOP,
        LABELS,
        "SELECT topic, CASE WHEN length(s) > 35 THEN substring(s, 1, 35) || '...' ELSE s END AS topic_name FROM j",
    ),
)
def topic_names(t):
    return tp.topic_names(top_words(t, docs(t)))


@query(
    "label_words",
    with_ctes(
        DOCS, FLAT, CELLS, TOP,
        LABELS,
        "w AS (SELECT unnest(string_split(CASE WHEN length(s) > 35 THEN substring(s, 1, 35) || '...' ELSE s END, ' ')) AS word FROM j)",
        f"SELECT word, count(*) AS n FROM w WHERE word <> '' AND lower(word) NOT IN {in_list(ref.LABEL_NOISE)} GROUP BY word",
    ),
)
def label_words(t):
    return tp.label_words(tp.topic_names(top_words(t, docs(t))), ref.LABEL_NOISE)


@query(
    "cooccurrence",
    with_ctes(
        DOCS, FLAT, CELLS, TOP,
        "seen AS (SELECT DISTINCT doc_id, term FROM flat)",
        "pairs AS (SELECT a.topic, a.term AS w1, b.term AS w2 FROM top a JOIN top b ON a.topic = b.topic AND a.rank < b.rank)",
        """SELECT p.topic, p.w1, p.w2, count(y.doc_id) AS n FROM pairs p LEFT JOIN seen x ON x.term = p.w1 LEFT JOIN seen y ON y.term = p.w2 AND y.doc_id = x.doc_id GROUP BY ALL""",
    ),
)
def cooccurrence(t):
    d = docs(t)
    pairs = tp.cooccurrence(d, "doc_id", "toks", top_words(t, d))
    return pairs.where("r1 < r2").select("topic", "w1", "w2", "n")


@query(
    "coherence_npmi",
    with_ctes(
        DOCS, FLAT, CELLS, TOP,
        "seen AS (SELECT DISTINCT doc_id, term FROM flat)",
        "df AS (SELECT term, count(*) AS df FROM seen GROUP BY term)",
        "pairs AS (SELECT a.topic, a.term AS w1, b.term AS w2 FROM top a JOIN top b ON a.topic = b.topic AND a.rank < b.rank)",
        "co AS (SELECT p.topic, p.w1, p.w2, count(*) AS n FROM pairs p JOIN seen x ON x.term = p.w1 JOIN seen y ON y.term = p.w2 AND y.doc_id = x.doc_id GROUP BY ALL HAVING count(*) >= 2)",
        "p AS (SELECT topic, n / nd AS p12, a.df / nd AS p1, b.df / nd AS p2 FROM (SELECT *, (SELECT count(*) FROM documents)::DOUBLE AS nd FROM co) JOIN df a ON a.term = w1 JOIN df b ON b.term = w2)",
        "SELECT topic, round(avg(ln(p12 / (p1 * p2)) / -ln(p12)), 6) AS npmi, count(*) AS n_pairs FROM p WHERE p12 < 1 GROUP BY topic",
    ),
)
def coherence_npmi(t):
    d = docs(t)
    return r6(tp.coherence_npmi(d, "doc_id", "toks", top_words(t, d)), "npmi")


@query(
    "coherence_cv",
    with_ctes(
        DOCS, FLAT, CELLS, TOP,
        "lens AS (SELECT doc_id, len(toks) AS l, greatest(len(toks) - 110, 0) AS last FROM docs WHERE len(toks) > 0)",
        "total AS (SELECT sum(last + 1)::DOUBLE AS n FROM lens)",
        "occ AS (SELECT DISTINCT f.doc_id, f.term, unnest(range(greatest(f.pos - 109, 0), least(f.pos, l.last) + 1)) AS s FROM flat f JOIN lens l USING (doc_id) WHERE f.term IN (SELECT term FROM top))",
        "single AS (SELECT term, count(*) AS n FROM occ GROUP BY term)",
        "co AS (SELECT a.term AS w1, b.term AS w2, count(*) AS n FROM occ a JOIN occ b ON a.doc_id = b.doc_id AND a.s = b.s GROUP BY a.term, b.term)",
        """m AS (SELECT a.topic, a.term AS w1, b.term AS w2, ln(coalesce(co.n, 0) / (SELECT n FROM total) + 1e-12::DOUBLE) AS l12,
            (s1.n / (SELECT n FROM total)) * (s2.n / (SELECT n FROM total)) AS den
          FROM top a JOIN top b ON a.topic = b.topic JOIN single s1 ON s1.term = a.term JOIN single s2 ON s2.term = b.term
          LEFT JOIN co ON co.w1 = a.term AND co.w2 = b.term)""",
        "npmi AS (SELECT topic, w1, w2, (l12 - ln(den)) / -l12 AS v FROM m)",
        "tot AS (SELECT topic, w2, sum(v) AS v FROM npmi GROUP BY topic, w2)",
        """cosines AS (SELECT n.topic, n.w1, sum(n.v * t.v) / (sqrt(sum(n.v * n.v)) * sqrt(sum(t.v * t.v))) AS c FROM npmi n JOIN tot t ON t.topic = n.topic AND t.w2 = n.w2 GROUP BY n.topic, n.w1)""",
        "SELECT topic, round(avg(c), 5) AS c_v FROM cosines GROUP BY topic",
    ),
)
def coherence_cv(t):
    d = docs(t)
    out = tp.coherence_cv(d, "doc_id", "toks", top_words(t, d))
    return out.select("topic", F.round("c_v", 5).alias("c_v"))


def _ctfidf_sql(local: str, spread: str) -> str:
    return with_ctes(
        DOCS, FLAT, CELLS,
        "lens AS (SELECT topic, sum(tf) AS l FROM cells GROUP BY topic)",
        "freq AS (SELECT term, sum(tf) AS f FROM cells GROUP BY term)",
        "avgl AS (SELECT floor(avg(l)) AS a FROM lens)",
        f"SELECT topic, term, tf, round({local} * {spread}, 9) AS weight FROM cells JOIN lens USING (topic) JOIN freq USING (term), avgl",
    )


def _ctfidf(t, **kw):
    return tp.c_tfidf(docs(t), "topic", "toks", **kw).withColumn("weight", F.round("weight", 9))


@query("c_tfidf", _ctfidf_sql("(tf / l)", "ln(1 + a / f)"))
def c_tfidf(t):
    return _ctfidf(t)


@query("c_tfidf_bm25", _ctfidf_sql("sqrt(tf / l)", "ln(1 + (a - f + 0.5) / (f + 0.5))"))
def c_tfidf_bm25(t):
    return _ctfidf(t, sqrt_tf=True, bm25=True)


@query(
    "topic_metrics",
    with_ctes(
        DOCS, FLAT, CELLS, TOP,
        """SELECT round((SELECT avg(CAST(topic = -1 AS INTEGER)) FROM docs), 6) AS outlier_fraction,
          round(count(DISTINCT term) / (count(DISTINCT topic) * 8.0), 6) AS topic_diversity, count(DISTINCT topic) AS n_topics FROM top""",
    ),
)
def topic_metrics(t):
    d = docs(t)
    return r6(tp.topic_metrics(d, top_words(t, d), 8), "outlier_fraction", "topic_diversity")


@query(
    "compare_configs",
    with_ctes(
        DOCS.replace("docs AS", "docs_a AS"), LONG.replace("docs AS", "docs_b AS"),
        """words AS (SELECT 'all_words' AS config, topic, unnest(toks) AS term FROM docs_a UNION ALL SELECT 'long_words', topic, unnest(toks) FROM docs_b)""",
        "best AS (SELECT config, topic, term FROM (SELECT config, topic, term, row_number() OVER (PARTITION BY config, topic ORDER BY count(*) DESC, term) AS r FROM words WHERE topic >= 0 GROUP BY config, topic, term) WHERE r <= 8)",
        "SELECT config, round((SELECT avg(CAST(topic = -1 AS INTEGER)) FROM docs_a), 6) AS outlier_fraction, round(count(DISTINCT term) / (count(DISTINCT topic) * 8.0), 6) AS topic_diversity, count(DISTINCT topic) AS n_topics FROM best GROUP BY config",
    ),
)
def compare_configs(t):
    runs = {}
    for name, length in (("all_words", 1), ("long_words", 6)):
        d = docs(t, length)
        runs[name] = r6(tp.topic_metrics(d, top_words(t, d), 8), "outlier_fraction", "topic_diversity")
    return tp.compare_configs(runs)


@query(
    "document_info",
    with_ctes(WEIGHTS, "SELECT d.doc_id, lang, topic, round(conf, 6) AS conf, CASE topic WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END AS topic_name FROM documents d JOIN asg USING (doc_id)"),
)
def document_info(t):
    assigned = tp.assign_topics(weighted(t), names(t)).drop("text")
    source = t.texts().select("doc_id", "lang", "n_chars")
    return r6(tp.document_info(source, assigned, "doc_id", ["topics", "n_chars"]), "conf")


@query(
    "topic_crosstab",
    with_ctes(
        DOCS,
        """SELECT source, topic, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY source) AS BIGINT) AS row_total,
          CAST(sum(count(*)) OVER (PARTITION BY topic) AS BIGINT) AS col_total FROM docs GROUP BY source, topic""",
    ),
)
def topic_crosstab(t):
    return profile.crosstab_long(docs(t), "source", "topic").select("source", "topic", "n", "row_total", "col_total")


# --- fitted models, rows only ------------------------------------------------

TOPIC_NMF = NmfConfig()  # the stopping tolerance decides the passes


def fitted(t):
    base = materialize(docs(t).select("doc_id", "toks"), "tokens")
    model = models.fit_topics(base, "doc_id", "toks", VOCAB_STOPS, TOPIC_VOCAB, TOPIC_NMF)
    discard(base)
    return t.texts().select("doc_id"), model


@query("nmf_topics")
def nmf_topics(t):
    """Topic words and names of a factorisation of all documents."""
    model = fitted(t)[1]
    return r6(model.top.join(model.names, "topic"), "weight", "lift")


@query("nmf_assignment")
def nmf_assignment(t):
    """Each document's topic under the fitted model."""
    base, model = fitted(t)
    vectors = models.document_vectors(base, "doc_id", "toks", model, TOPIC_VOCAB, TOPIC_NMF, VOCAB_STOPS, model.doc_cells)
    assigned = tp.assign_topics(vectors.select("doc_id", "topics"), model.names)
    return r6(assigned.select("doc_id", "topic", "conf", "topic_name"), "conf")


@query("embed_cluster")
def embed_cluster(t):
    out = tp.cluster_embeddings(t.read("embeddings"), "embedding", k=10, components=8)
    return r6(out.select("vec_id", "label", "topic", "distance", "prob"), "distance", "prob")




@query("density_clusters")
def density_clusters(t):
    reduced = density.principal(t.read("embeddings"), "embedding", 5)
    return r6(density.cluster_density(reduced, "vec_id", "embedding", 15), "prob")
