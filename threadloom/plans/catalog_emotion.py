"""Queries on lexicon scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom import reference_tables as ref
from threadloom.functions import numeric as num, tokens as tk
from threadloom.operators import emotion as emo, profile
from threadloom.plans.catalog_tokens import in_list, quoted
from threadloom.plans.registry import query
from threadloom.plans.tables import with_ctes

# A lexicon of words that occur in the tables and their frames.
LEXICON = [
    ("the", "anticipation", "1"), ("the", "positive", "1"), ("and", "trust", "1"),
    ("of", "fear", "1"), ("of", "negative", "1"), ("scared", "fear", "1"),
    ("scared", "negative", "1"), ("happy", "joy", "1"), ("happy", "positive", "1"),
    ("le", "sadness", "1"), ("de", "anger", "1"), ("que", "surprise", "1"),
    ("Der", "disgust", "1"), ("with", "joy", "0"), ("with", "other", "1"),
]
HEAD = "So the never of "
TAIL = " i am very scared and not happy, hardly ever really happy"


def lexicon(t):
    return emo.build_lexicon(t.spark.createDataFrame(LEXICON, "word string, emotion string, score string"))


EDGES = [(-1, ""), (-2, "123 456"), (-3, "never very scared")]  # texts that the table may not hold


def framed(t):
    """All texts in their frame, and a few edge texts."""
    edges = t.spark.createDataFrame(EDGES, "doc_id long, text string")
    return t.texts().select("doc_id", F.concat(F.lit(HEAD), "text", F.lit(TAIL)).alias("text")).unionByName(edges)


LEX = "lex(word, emotion) AS (VALUES " + ", ".join(
    f"({quoted(w.lower())}, {quoted(e)})" for w, e, s in LEXICON if s == "1" and e in ref.EMOTIONS
) + ")"
TOKENS = f"""framed AS (SELECT doc_id, {quoted(HEAD)} || text || {quoted(TAIL)} AS text FROM documents
    UNION ALL SELECT * FROM (VALUES {", ".join(f"({i}, {quoted(x)})" for i, x in EDGES)}) AS edges(doc_id, text)),
src AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM framed),
toks AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM src),
flags AS (SELECT *, max(CASE WHEN word IN {in_list(ref.NEGATORS)} THEN 1 ELSE 0 END) OVER w AS neg,
    max(CASE WHEN word IN {in_list(ref.INTENSIFIERS)} THEN 1 ELSE 0 END) OVER w AS strong
  FROM toks WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
hits AS (SELECT doc_id, pos, word, emotion, (CASE WHEN strong = 1 THEN 1.5::DOUBLE ELSE 1 END) * (CASE WHEN neg = 1 THEN -1 ELSE 1 END) AS weight
  FROM flags JOIN lex USING (word)),
per AS (SELECT doc_id, emotion, sum(weight) AS w FROM hits GROUP BY doc_id, emotion)"""

WEIGHTS = "wt(emotion, c) AS (VALUES " + ", ".join(f"({quoted(e)}, {c}::DOUBLE)" for e, c in ref.EMOTION_WEIGHTS.items()) + ")"
SCORES = """raws AS (SELECT s.doc_id, len(s.ws) AS n_tokens, coalesce(r.raw, 0) AS raw FROM src s LEFT JOIN
    (SELECT doc_id, sum(w * c) AS raw FROM per JOIN wt USING (emotion) GROUP BY doc_id) r USING (doc_id)),
scores AS (SELECT *, CASE WHEN n_tokens = 0 THEN 0 ELSE 1 / (1 + exp(-raw / greatest(1, n_tokens ** 0.3::DOUBLE))) END AS norm FROM raws)"""
BUCKET = "CASE WHEN norm >= 0 AND norm < 0.2 THEN 0 WHEN norm >= 0.2 AND norm < 0.4 THEN 1 WHEN norm >= 0.4 AND norm < 0.6 THEN 2 WHEN norm >= 0.6 AND norm < 0.8 THEN 3 WHEN norm >= 0.8 AND norm < 1 THEN 4 ELSE 5 END"


@query(
    "emotion_matches",
    with_ctes(LEX, TOKENS, "SELECT doc_id, CAST(pos AS INTEGER) AS pos, word, count(*) AS n_emotions, max(weight) AS weight FROM hits GROUP BY doc_id, pos, word"),
)
def emotion_matches(t):
    found = emo.matches(framed(t), lexicon(t), "doc_id", tk.alpha_tokens("text"))
    return found.where(F.col("emotions").isNotNull()).select(
        "doc_id", "pos", "word", F.size("emotions").cast("bigint").alias("n_emotions"), "weight"
    )


@query(
    "modifier_flags",
    with_ctes(LEX, TOKENS, "SELECT doc_id, CAST(sum(coalesce(neg, 0)) AS BIGINT) AS n_negated, CAST(sum(coalesce(strong, 0)) AS BIGINT) AS n_strong FROM flags GROUP BY doc_id"),
)
def modifier_flags(t):
    rows = framed(t).select("doc_id", F.explode(emo.marked_tokens(tk.alpha_tokens("text"))).alias("m"))
    return rows.groupBy("doc_id").agg(
        F.count_if("m.negated").alias("n_negated"), F.count_if("m.intensified").alias("n_strong")
    )


@query(
    "emotion_counts",
    with_ctes(
        LEX, TOKENS,
        "emos AS (SELECT unnest([" + ", ".join(quoted(e) for e in ref.EMOTIONS) + "]) AS emotion)",
        """SELECT s.doc_id, e.emotion, CAST(greatest(0, round_even(coalesce(p.w, 0), 0)) AS INTEGER) AS n
        FROM src s CROSS JOIN emos e LEFT JOIN per p ON p.doc_id = s.doc_id AND p.emotion = e.emotion""",
    ),
)
def emotion_counts(t):
    scored = emo.score_emotions(framed(t), lexicon(t), "doc_id")
    return scored.select("doc_id", F.explode("emo_counts").alias("emotion", "n"))


@query(
    "emotion_score",
    with_ctes(LEX, TOKENS, WEIGHTS, SCORES, f"SELECT doc_id, n_tokens, round(raw, 6) AS raw, round(norm, 6) AS norm, {BUCKET} AS label FROM scores"),
)
def emotion_score(t):
    scored = emo.score_emotions(framed(t), lexicon(t), "doc_id")
    return scored.select(
        "doc_id", F.greatest("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"),
        F.round("raw", 6).alias("raw"), F.round("norm", 6).alias("norm"), "label",
    )


@query(
    "emotion_score_custom",
    with_ctes(
        LEX, TOKENS, "wt(emotion, c) AS (VALUES ('fear', 2.0::DOUBLE), ('joy', -1.0::DOUBLE))",
        "kept AS (SELECT * FROM per WHERE emotion IN ('fear', 'joy', 'trust'))",
        SCORES.replace("FROM per JOIN", "FROM kept JOIN"),
        "SELECT doc_id, round(raw, 6) AS raw, round(norm, 6) AS norm FROM scores",
    ),
)
def emotion_score_custom(t):
    scored = emo.score_emotions(
        framed(t), lexicon(t), "doc_id", emotions=["fear", "joy", "trust"], weights={"fear": 2.0, "joy": -1.0}
    )
    return scored.select("doc_id", F.round("raw", 6).alias("raw"), F.round("norm", 6).alias("norm"))


@query(
    "emotion_diagnostics",
    with_ctes(
        LEX, TOKENS,
        """found AS (SELECT doc_id, count(DISTINCT word) AS n_matched_words, array_to_string(list_sort(list(DISTINCT word)), ' ') AS matched_words FROM hits GROUP BY doc_id)""",
        """cnt AS (SELECT doc_id, emotion, round_even(w, 0) AS n FROM per WHERE round_even(w, 0) > 0)""",
        "emos AS (SELECT unnest([" + ", ".join(quoted(e) for e in ref.EMOTIONS) + "]) AS emotion, unnest(range(10)) AS i)",
        """best AS (SELECT doc_id, string_agg(emotion || ':' || CAST(CAST(n AS BIGINT) AS VARCHAR), ' ' ORDER BY rn) AS top FROM
          (SELECT doc_id, emotion, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, i) AS rn FROM cnt JOIN emos USING (emotion)) WHERE rn <= 3 GROUP BY doc_id)""",
        """SELECT s.doc_id, len(s.ws) AS total_words, coalesce(n_matched_words, 0) AS n_matched_words,
          round(coalesce(n_matched_words, 0) / greatest(1, len(s.ws)), 6) AS match_rate, coalesce(matched_words, '') AS matched_words,
          coalesce(top, '') AS top FROM src s LEFT JOIN found USING (doc_id) LEFT JOIN best USING (doc_id)""",
    ),
)
def emotion_diagnostics(t):
    out = emo.emotion_diagnostics(framed(t), lexicon(t), "doc_id")
    top = F.transform("top_emotions", lambda s: F.concat(s["emotion"], F.lit(":"), s["count"].cast("string")))
    return out.select(
        "doc_id", F.col("total_words").cast("bigint").alias("total_words"),
        F.col("n_matched_words").cast("bigint").alias("n_matched_words"),
        F.round("match_rate", 6).alias("match_rate"),
        F.array_join("matched_words", " ").alias("matched_words"), F.array_join(top, " ").alias("top"),
    )


@query(
    "enrich_scores",
    with_ctes(
        LEX, TOKENS, WEIGHTS, SCORES,
        f"SELECT doc_id, round(norm, 6) AS anxiety_score, {BUCKET} AS anxiety_label FROM scores",
    ),
)
def enrich_scores(t):
    base = framed(t).select("doc_id", F.col("text").alias("text_all"), F.lit("").alias("text_main"))
    out = emo.add_label(emo.add_scores(base, lexicon(t), "doc_id"))
    return out.select("doc_id", F.round("anxiety_score", 6).alias("anxiety_score"), "anxiety_label")


@query(
    "emotion_range",
    with_ctes(LEX, TOKENS, WEIGHTS, SCORES, "SELECT round(min(norm), 6) AS min_value, round(max(norm), 6) AS max_value, round(avg(norm), 6) AS mean_value FROM scores"),
)
def emotion_range(t):
    scored = emo.score_emotions(framed(t), lexicon(t), "doc_id")
    out = profile.score_range(scored, "norm")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(
    "buckets_and_rounding",
    """SELECT event_id, CAST(round_even(value / 2, 0) AS BIGINT) AS even, CASE WHEN v >= 0 AND v < 0.2 THEN 0 WHEN v >= 0.2 AND v < 0.4 THEN 1
      WHEN v >= 0.4 AND v < 0.6 THEN 2 WHEN v >= 0.6 AND v < 0.8 THEN 3 WHEN v >= 0.8 AND v < 1 THEN 4 ELSE 5 END AS bucket,
      round(ln(1 + value), 6) AS logged FROM (SELECT event_id, round(value) AS value, value / 100 AS v FROM events)""",
)
def buckets_and_rounding(t):
    e = t.read("events").select("event_id", F.round("value", 0).alias("r"), (F.col("value") / 100).alias("v"))
    return e.select(
        "event_id", num.half_even(F.col("r") / 2).alias("even"), num.severity_bucket("v").alias("bucket"),
        F.round(F.log1p("r"), 6).alias("logged"),
    )
