"""Queries on labels, prompts, answers, labeller comparison, samples, measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import numeric as num
from threadloom.operators import calibration, evaluate as ev, features as feat, labels as lb, merge, sampling as sp
from threadloom.plans.catalog_tokens import sql_simple
from threadloom.plans.registry import query
from threadloom.plans.tables import AI, HAND, POSTS, SCORED, with_ctes

HAND_LABELS = "hl AS (SELECT post_id, CAST(coalesce(TRY_CAST(anxiety_rating AS DOUBLE) >= 4, false) AS INTEGER) AS label FROM hand)"
AI_LABELS = """al AS (SELECT post_id, CAST((contains(lower(ai_category), 'anx') OR contains(lower(ai_category), 'panic'))
  AND coalesce(TRY_CAST(ai_severity AS DOUBLE), 0) >= 4 AND coalesce(ai_confidence, 0) >= 0.5 AS INTEGER) AS label FROM ai)"""
COMBINED = """comb AS (SELECT post_id, label FROM hl UNION ALL SELECT post_id, label FROM al WHERE post_id NOT IN (SELECT post_id FROM hl))"""
SETS = (HAND, AI, HAND_LABELS, AI_LABELS, COMBINED)


def rounded(df, *columns, digits=6):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


@query("hand_labels", with_ctes(HAND, HAND_LABELS, "SELECT * FROM hl"))
def hand_labels(t):
    return lb.hand_labels(t.hand())


@query("ai_labels", with_ctes(AI, AI_LABELS, "SELECT * FROM al"))
def ai_labels(t):
    return lb.ai_labels(t.ai())


@query("combined_labels", with_ctes(*SETS, "SELECT * FROM comb"))
def combined_labels(t):
    return lb.combined(lb.hand_labels(t.hand()), lb.ai_labels(t.ai()))


@query(
    "label_set_stats",
    with_ctes(
        *SETS,
        "o AS (SELECT count(*) AS o FROM hl JOIN al USING (post_id))",
        """SELECT source, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, round(avg(label), 6) AS rate, (SELECT o FROM o) AS overlap FROM
        (SELECT 'hand' AS source, label FROM hl UNION ALL SELECT 'ai', label FROM al UNION ALL SELECT 'combined', label FROM comb) GROUP BY source""",
    ),
)
def label_set_stats(t):
    return rounded(lb.label_set_stats(lb.hand_labels(t.hand()), lb.ai_labels(t.ai())), "rate")


@query(
    "binary_severity",
    with_ctes(AI, "SELECT post_id, CAST(coalesce(TRY_CAST(ai_severity AS DOUBLE) >= 3, false) AS INTEGER) AS anxiety_level FROM ai"),
)
def binary_severity(t):
    return lb.binary_from_severity(t.ai()).select("post_id", "anxiety_level")


@query("attach_labels", with_ctes(POSTS, *SETS, "SELECT post_id, subreddit, label FROM posts JOIN comb USING (post_id)"))
def attach_labels(t):
    labels = lb.combined(lb.hand_labels(t.hand()), lb.ai_labels(t.ai()))
    return merge.attach_labels(t.posts().select("post_id", "subreddit"), labels)


@query(
    "with_text",
    with_ctes(POSTS, HAND, "SELECT h.post_id, length(p.selftext) AS n FROM hand h LEFT JOIN (SELECT * FROM posts WHERE score > 500) p USING (post_id)"),
)
def with_text(t):
    long_posts = t.posts().where("score > 500").withColumnRenamed("selftext", "text_all")
    return merge.with_text(t.hand(), long_posts).select("post_id", F.length("text_all").cast("bigint").alias("n"))


@query("pending_labels", with_ctes(POSTS, AI, "SELECT post_id, subreddit FROM posts WHERE post_id NOT IN (SELECT post_id FROM ai)"))
def pending_labels(t):
    return merge.pending(t.posts(), t.ai()).select("post_id", "subreddit")


@query(
    "merged_results",
    with_ctes(POSTS, AI, "SELECT 'done' AS state, post_id FROM ai UNION ALL SELECT 'new', post_id FROM posts WHERE post_id NOT IN (SELECT post_id FROM ai)"),
)
def merged_results(t):
    done = t.ai().select(F.lit("done").alias("state"), "post_id")
    fresh = merge.pending(t.posts(), t.ai()).select(F.lit("new").alias("state"), "post_id")
    return merge.merge_results(done, fresh)


@query("pending_ids", with_ctes(POSTS, AI, "SELECT post_id FROM posts EXCEPT SELECT post_id FROM ai"))
def pending_ids(t):
    return merge.pending_ids(t.posts(), t.ai())


@query("common_ids", with_ctes(HAND, AI, "SELECT post_id FROM hand INTERSECT SELECT post_id FROM ai"))
def common_ids(t):
    return merge.common_ids(t.hand(), t.ai())


@query("tagged_union", with_ctes(HAND, AI, "SELECT post_id, 'hand' AS source FROM hand UNION ALL SELECT post_id, 'ai' FROM ai"))
def tagged_union(t):
    return merge.tagged_union({"hand": t.hand().select("post_id"), "ai": t.ai().select("post_id")})


# --- prompts and answers ----------------------------------------------------

_CUT = """CASE WHEN length(selftext) <= {n} THEN selftext ELSE substring(selftext, 1, {h}) || '...[truncated]...' || right(selftext, {t}) END"""
_FILL = "'G ' || subreddit || ' T ' || substring(title, 1, 200) || ' X ' || {cut}"


@query(
    "prompt",
    with_ctes(
        POSTS,
        f"""full_prompt AS (SELECT *, {_FILL.format(cut=_CUT.format(n=1000, h=688, t=295))} AS p,
          {_FILL.format(cut=_CUT.format(n=500, h=338, t=145))} AS q FROM posts)""",
        "SELECT post_id, md5(CASE WHEN length(p) // 3 > 390 THEN q ELSE p END) AS prompt, length(CASE WHEN length(p) // 3 > 390 THEN q ELSE p END) AS n FROM full_prompt",
    ),
)
def prompt(t):
    out = lb.build_prompt(t.posts(), "G %1$s T %2$s X %3$s", text="selftext", max_tokens=390)
    return out.select("post_id", F.md5("prompt").alias("prompt"), F.length("prompt").cast("bigint").alias("n"))


@query(
    "parse_response",
    """WITH r AS (SELECT event_id, event_id % 10 AS k, CAST(json_extract_string(props, '$.k') AS INTEGER) AS v FROM events)
    SELECT event_id,
      CASE k WHEN 0 THEN 'ANXIETY' WHEN 1 THEN 'NOT_ANXIETY' WHEN 2 THEN 'ERROR' WHEN 3 THEN 'UNKNOWN' WHEN 4 THEN 'UNKNOWN' WHEN 5 THEN 'ANXIETY' WHEN 7 THEN NULL WHEN 8 THEN 'PANIC' ELSE 'ERROR' END AS ai_category,
      CAST(CASE WHEN k IN (0, 1, 5) THEN v % 6 WHEN k = 7 THEN NULL WHEN k = 8 THEN v % 6 + 0.7 ELSE 0 END AS DOUBLE) AS ai_severity,
      CASE WHEN k IN (0, 1) THEN round(v / 100.0::DOUBLE, 2) WHEN k IN (3, 7) THEN 0.5 ELSE 0.0 END AS ai_confidence FROM r""",
)
def parse_response(t):
    """Clean, fenced, malformed and incomplete answers built from ``props``."""
    v = F.get_json_object("props", "$.k").cast("int")
    k = F.col("event_id") % 10

    def answer(category: str):
        return F.format_string('{"category": "' + category + '", "severity": %d, "confidence": %.2f}', v % 6, v / 100.0)

    raw = (
        F.when(k == 0, answer("ANXIETY"))
        .when(k == 1, F.concat(F.lit("```json\n"), answer("NOT_ANXIETY"), F.lit("\n```")))
        .when(k == 2, F.concat(F.lit("oops "), "props"))
        .when(k == 3, F.lit('{"confidence": 0.5}'))
        .when(k == 4, F.col("props"))
        .when(k == 5, F.concat(F.lit("```\n"), F.format_string('{"category": "ANXIETY", "severity": %d}', v % 6), F.lit("\n```")))
        .when(k == 6, F.lit("null"))
        .when(k == 7, F.lit('{"category": null, "severity": null, "confidence": 0.5}'))
        .when(k == 8, F.format_string('{"category": "PANIC", "severity": %d.7}', v % 6))
        .otherwise(F.lit("{}"))
    )
    events = t.read("events").select("event_id", raw.alias("raw"))
    return lb.parse_response(events).drop("raw")


@query(
    "truncation_stats",
    with_ctes(
        POSTS, AI,
        """SELECT count(*) FILTER (WHERE done) AS already_labeled, count(*) FILTER (WHERE NOT done) AS new_processed,
          count(*) FILTER (WHERE NOT done AND length(title) > 200) AS title_truncated, count(*) FILTER (WHERE NOT done AND length(selftext) > 1000) AS text_truncated,
          round(count(*) FILTER (WHERE NOT done AND length(title) > 200) * 100.0 / count(*) FILTER (WHERE NOT done), 6) AS title_pct,
          round(count(*) FILTER (WHERE NOT done AND length(selftext) > 1000) * 100.0 / count(*) FILTER (WHERE NOT done), 6) AS text_pct
        FROM (SELECT *, post_id IN (SELECT post_id FROM ai) AS done FROM posts)""",
    ),
)
def truncation_stats(t):
    return rounded(lb.truncation_stats(t.posts(), t.ai(), text="selftext"), "title_pct", "text_pct")


@query(
    "label_summary",
    with_ctes(AI, "SELECT ai_category, count(*) AS n, round(avg(ai_confidence), 6) AS mean_confidence, round((SELECT avg(ai_confidence) FROM ai), 6) AS overall_confidence FROM ai GROUP BY ai_category"),
)
def label_summary(t):
    return rounded(lb.label_summary(t.ai()), "mean_confidence", "overall_confidence")


# --- comparison -------------------------------------------------------------

# one group more on either side, so that each side has one that the other lacks
ONLY_AI, ONLY_HAND = "only-ai", "only-hand"
AI_MORE = f"ai_more AS (SELECT subreddit, ai_category, ai_severity FROM ai UNION ALL SELECT '{ONLY_AI}', 'ANXIETY', '3')"
HAND_MORE = f"hand_more AS (SELECT subreddit, anxiety_level, anxiety_rating FROM hand UNION ALL SELECT '{ONLY_HAND}', 1, '4')"


def ai_more(t):
    more = t.spark.createDataFrame([("x1", ONLY_AI, "ANXIETY", "3")], "post_id string, subreddit string, ai_category string, ai_severity string")
    return t.ai().select(more.columns).unionByName(more)


def hand_more(t):
    more = t.spark.createDataFrame([("x2", ONLY_HAND, 1, "4")], "post_id string, subreddit string, anxiety_level int, anxiety_rating string")
    return t.hand().select(more.columns).unionByName(more)


GROUP_STATS = f"""{AI_MORE},
{HAND_MORE},
a AS (SELECT subreddit, round(avg(CAST(ai_category = 'ANXIETY' AS INTEGER)) * 100, 2) AS ai_rate,
  round(avg(TRY_CAST(ai_severity AS DOUBLE)), 2) AS ai_mean, count(*) AS ai_count FROM ai_more GROUP BY subreddit),
h AS (SELECT subreddit, round(avg(anxiety_level) * 100, 2) AS human_rate, round(avg(TRY_CAST(anxiety_rating AS DOUBLE)), 2) AS human_mean, count(*) AS human_count
  FROM hand_more GROUP BY subreddit),
cmp AS (SELECT subreddit, coalesce(ai_rate, 0) AS ai_rate, coalesce(ai_mean, 0) AS ai_mean, coalesce(ai_count, 0) AS ai_count,
  coalesce(human_rate, 0) AS human_rate, coalesce(human_mean, 0) AS human_mean, coalesce(human_count, 0) AS human_count FROM a FULL JOIN h USING (subreddit))"""


def _group_stats(t):
    from threadloom.operators.profile import rates_by_group

    ai = ai_more(t).withColumn("sev", num.to_number("ai_severity"))
    hand = hand_more(t).withColumn("rating", num.to_number("anxiety_rating"))
    return lb.compare_groups(
        rates_by_group(ai, "subreddit", lb.is_positive_category(), "sev", "ai"),
        rates_by_group(hand, "subreddit", F.col("anxiety_level") == 1, "rating", "human"),
    )


@query("label_rates", with_ctes(HAND, AI, GROUP_STATS, "SELECT * FROM cmp"))
def label_rates(t):
    return _group_stats(t)


@query(
    "largest_differences",
    with_ctes(HAND, AI, GROUP_STATS, "SELECT subreddit, round(ai_rate - human_rate, 6) AS rate_difference FROM cmp"),
)
def largest_differences(t):
    out = lb.largest_diff(_group_stats(t), "ai_rate", "human_rate")
    return rounded(out.select("subreddit", "rate_difference"), "rate_difference")


BOTH = """lboth AS (SELECT a.post_id, CAST(ai_category = 'ANXIETY' AS INTEGER) AS ai_binary, anxiety_level AS human_binary FROM ai a JOIN hand h USING (post_id))"""


@query("label_overlap", with_ctes(HAND, AI, BOTH, "SELECT * FROM lboth"))
def label_overlap(t):
    return lb.overlap(t.ai(), t.hand()).select("post_id", "ai_binary", "human_binary")


@query(
    "agreement",
    with_ctes(HAND, AI, BOTH, "SELECT count(*) AS n, round(avg(CAST(ai_binary = human_binary AS INTEGER)), 6) AS agreement, count(*) FILTER (WHERE ai_binary <> human_binary) AS disagreements FROM lboth"),
)
def agreement(t):
    return rounded(lb.agreement(lb.overlap(t.ai(), t.hand())), "agreement")


@query("disagreement_sample", with_ctes(HAND, AI, BOTH, "SELECT post_id FROM lboth WHERE ai_binary <> human_binary ORDER BY post_id LIMIT 3"))
def disagreement_sample(t):
    return lb.disagreement_sample(lb.overlap(t.ai(), t.hand())).select("post_id")


@query(
    "edge_cases",
    with_ctes(
        HAND, AI,
        """SELECT count(*) FILTER (WHERE ai_confidence < 0.8 AND s >= 4) AS low_conf_high_sev,
          count(*) FILTER (WHERE ai_confidence > 0.9 AND s <= 1 AND ai_category = 'ANXIETY') AS high_conf_low_sev,
          count(*) FILTER (WHERE ai_category = 'NOT_ANXIETY' AND s > 2) AS not_anx_high_sev,
          (SELECT count(*) FROM hand WHERE anxiety_level = 0 AND TRY_CAST(anxiety_rating AS DOUBLE) > 2) AS human_none_high,
          (SELECT count(*) FROM hand WHERE anxiety_level = 1 AND TRY_CAST(anxiety_rating AS DOUBLE) = 0) AS human_anx_zero
        FROM (SELECT *, TRY_CAST(ai_severity AS DOUBLE) AS s FROM ai)""",
    ),
)
def edge_cases(t):
    return lb.edge_cases(t.ai(), t.hand())


@query(
    "confidence",
    with_ctes(
        AI,
        """SELECT min(ai_confidence)::DOUBLE AS min_conf, max(ai_confidence)::DOUBLE AS max_conf, round(avg(ai_confidence) FILTER (WHERE ai_category = 'ANXIETY'), 6) AS anxiety_conf,
          round(avg(ai_confidence) FILTER (WHERE ai_category = 'NOT_ANXIETY'), 6) AS not_anxiety_conf, count(*) FILTER (WHERE ai_confidence < 0.85) AS n_low,
          round(count(*) FILTER (WHERE ai_confidence < 0.85) * 100.0 / count(*), 6) AS low_pct,
          round(corr(ai_confidence, TRY_CAST(ai_severity AS DOUBLE)), 6) AS corr_conf_sev FROM ai""",
    ),
)
def confidence(t):
    return rounded(lb.confidence_stats(t.ai()), "anxiety_conf", "not_anxiety_conf", "low_pct", "corr_conf_sev")


@query("confidence_by_severity", with_ctes(AI, "SELECT ai_severity, count(*) AS n, round(avg(ai_confidence), 6) AS mean_confidence FROM ai GROUP BY ai_severity"))
def confidence_by_severity(t):
    return rounded(lb.conf_by_severity(t.ai()), "mean_confidence")


@query(
    "share_compare",
    with_ctes(
        HAND, AI, AI_MORE,
        "l AS (SELECT subreddit, count(*) AS n FROM ai_more GROUP BY subreddit)",
        "r AS (SELECT subreddit, count(*) AS n FROM hand GROUP BY subreddit)",
        """SELECT subreddit, round(coalesce(l.n / (SELECT sum(n) FROM l), 0), 6) AS share_left, round(coalesce(r.n / (SELECT sum(n) FROM r), 0), 6) AS share_right
        FROM l FULL JOIN r USING (subreddit)""",
    ),
)
def share_compare(t):
    return rounded(lb.share_compare(ai_more(t), t.hand()), "share_left", "share_right")


@query(
    "share_compare_top",
    with_ctes(
        HAND, AI,
        "l AS (SELECT subreddit, count(*) AS n FROM ai GROUP BY subreddit)", "r AS (SELECT subreddit, count(*) AS n FROM hand GROUP BY subreddit)",
        """SELECT subreddit, round(l.n / (SELECT sum(n) FROM l), 6) AS share_left, round(r.n / (SELECT sum(n) FROM r), 6) AS share_right
        FROM l JOIN r USING (subreddit) ORDER BY l.n + r.n DESC, subreddit LIMIT 5""",
    ),
)
def share_compare_top(t):
    return rounded(lb.share_compare(t.ai(), t.hand(), top_n=5), "share_left", "share_right")


@query(
    "dataset_summary",
    with_ctes(
        HAND, AI,
        """SELECT 'ai' AS dataset, count(*) AS n, round(avg(CAST(ai_category = 'ANXIETY' AS INTEGER)) * 100, 6) AS rate_pct,
          round(avg(TRY_CAST(ai_severity AS DOUBLE)), 6) AS mean_value, round(stddev_samp(TRY_CAST(ai_severity AS DOUBLE)), 6) AS std_value FROM ai
        UNION ALL SELECT 'human', count(*), round(avg(anxiety_level) * 100, 6), round(avg(TRY_CAST(anxiety_rating AS DOUBLE)), 6),
          round(stddev_samp(TRY_CAST(anxiety_rating AS DOUBLE)), 6) FROM hand""",
    ),
)
def dataset_summary(t):
    return rounded(lb.summary(t.ai(), t.hand()), "rate_pct", "mean_value", "std_value")


# --- samples and splits -----------------------------------------------------

_HASHED = "(SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{s}'), doc_id) AS r, count(*) OVER (PARTITION BY {g}) AS n FROM {t})"


@query(
    "quota_sample",
    with_ctes(
        "q AS (SELECT lang, least(count(*), 5 + CAST(round_even((100 - 5 * (SELECT count(DISTINCT lang) FROM documents)) * count(*) / (SELECT count(*) FROM documents), 0) AS BIGINT)) AS quota FROM documents GROUP BY lang)",
        f"SELECT doc_id, lang FROM {_HASHED.format(g='lang', s=42, t='documents')} d JOIN q USING (lang) WHERE r <= quota",
    ),
)
def quota_sample(t):
    return sp.quota_sample(t.read("documents").select("doc_id", "lang"), "doc_id", "lang", 100, 5)


@query(
    "stratified_split",
    f"""SELECT doc_id, toxic, CASE WHEN (r - 1) / n < 0.72 THEN 'train' WHEN (r - 1) / n < 0.8 THEN 'validation' ELSE 'test' END AS split
    FROM {_HASHED.format(g='toxic', s=42, t='labels')}""",
)
def stratified_split(t):
    return sp.stratified_split(
        t.read("labels").select("doc_id", "toxic"), "doc_id", "toxic", {"train": 0.72, "validation": 0.08, "test": 0.2}
    )


@query(
    "kfold",
    f"""SELECT doc_id, toxic, 0 AS repeat, CAST((r - 1) % 5 AS INTEGER) AS fold FROM {_HASHED.format(g='toxic', s=42, t='labels')}
    UNION ALL SELECT doc_id, toxic, 1, CAST((r - 1) % 5 AS INTEGER) FROM {_HASHED.format(g='toxic', s=43, t='labels')}""",
)
def kfold(t):
    return sp.folds(t.read("labels").select("doc_id", "toxic"), "doc_id", "toxic")


@query(
    "class_weights",
    "SELECT doc_id, round((SELECT count(*) FROM labels) / (2.0 * count(*) OVER (PARTITION BY toxic)), 6) AS weight FROM labels",
)
def class_weights(t):
    return rounded(sp.class_weights(t.read("labels"), "toxic").select("doc_id", "weight"), "weight")


# --- measures ---------------------------------------------------------------

CURVE = """pts AS (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY score),
curve AS (SELECT *, sum(pos) OVER o AS tp, sum(neg) OVER o AS fp, (SELECT sum(pos) FROM pts) AS p, (SELECT sum(neg) FROM pts) AS n FROM pts WINDOW o AS (ORDER BY threshold DESC)),
pr AS (SELECT threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM curve),
f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-10) AS f1 FROM pr)"""
THR = 0.5


@query(
    "roc_auc",
    with_ctes(
        SCORED,
        "ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored)",
        "SELECT round((sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0) / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)), 6) AS auc FROM ranked",
    ),
)
def roc_auc(t):
    return rounded(ev.roc_auc(t.scored()), "auc")


@query("avg_precision", with_ctes(SCORED, CURVE, "SELECT round(sum((pos / p) * (tp / (tp + fp))), 6) AS ap FROM curve"))
def avg_precision(t):
    return rounded(ev.avg_precision(t.scored()), "ap")


@query("pr_points", with_ctes(SCORED, CURVE, "SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f"))
def pr_points(t):
    return rounded(ev.pr_points(t.scored()), "precision", "recall", "f1")


@query("best_threshold", with_ctes(SCORED, CURVE, "SELECT threshold, round(f1, 6) AS f1 FROM f ORDER BY f.f1 DESC, threshold LIMIT 1"))
def best_threshold(t):
    return rounded(ev.best_threshold(t.scored()), "f1").select("threshold", "f1")


@query("roc_points", with_ctes(SCORED, CURVE, "SELECT threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM curve"))
def roc_points(t):
    return rounded(ev.roc_points(t.scored()), "fpr", "tpr")


@query("confusion", with_ctes(SCORED, f"SELECT label, CAST(score >= {THR} AS INTEGER) AS pred, count(*) AS n FROM scored GROUP BY ALL"))
def confusion(t):
    return ev.confusion(t.scored(), THR)


@query("accuracy", with_ctes(SCORED, f"SELECT round(avg(CAST(label = CAST(score >= {THR} AS INTEGER) AS INTEGER)), 6) AS accuracy FROM scored"))
def accuracy(t):
    return rounded(ev.accuracy(t.scored(), THR), "accuracy")


@query(
    "class_report",
    with_ctes(
        SCORED,
        f"""per AS (SELECT c, count(*) FILTER (WHERE label = c) AS s, count(*) FILTER (WHERE pred = c) AS k, count(*) FILTER (WHERE label = c AND pred = c) AS h
          FROM (SELECT label, CASE WHEN score >= {THR} THEN 1 WHEN score < 0.1 THEN 2 ELSE 0 END AS pred FROM scored), (SELECT unnest([0, 1, 2]) AS c) GROUP BY c)""",
        "m AS (SELECT s, h, CASE WHEN k > 0 THEN h / k ELSE 0 END AS p, CASE WHEN s > 0 THEN h / s ELSE 0 END AS r FROM per)",
        """SELECT round(sum(h) / sum(s), 6) AS accuracy, round(sum(s * p) / sum(s), 6) AS precision_weighted, round(sum(s * r) / sum(s), 6) AS recall_weighted,
          round(sum(s * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / sum(s), 6) AS f1_weighted FROM m""",
    ),
)
def class_report(t):
    pred = F.when(F.col("score") >= THR, 1).when(F.col("score") < 0.1, 2).otherwise(0)
    out = ev.class_report(t.scored().withColumn("pred", pred))
    return rounded(out, *out.columns)


def _probs(t):
    logits = F.array(F.lit(0.0), (F.col("score") - 0.4) * 6)
    return ev.nll(t.scored().withColumn("probs", num.softmax(logits)))


NLL = """probs AS (SELECT doc_id, label, 1 / (1 + exp(-(score - 0.4) * 6)) AS p1 FROM scored),
loss AS (SELECT *, -ln(CASE WHEN label = 1 THEN p1 ELSE 1 - p1 END) AS nll, CAST(p1 > 0.5 AS INTEGER) AS pred FROM probs)"""


@query("nll", with_ctes(SCORED, NLL, "SELECT doc_id, round(p1, 6) AS p1, round(nll, 6) AS nll FROM loss"))
def nll(t):
    return _probs(t).select("doc_id", F.round(F.col("probs")[1], 6).alias("p1"), F.round("nll", 6).alias("nll"))


@query("worst_rows", with_ctes(SCORED, NLL, "SELECT doc_id FROM loss ORDER BY nll DESC, doc_id LIMIT 20"))
def worst_rows(t):
    return ev.worst(_probs(t).withColumn("nll", F.col("nll")), 20, "doc_id").select("doc_id")


@query(
    "focus_set",
    with_ctes(
        SCORED, NLL,
        "SELECT doc_id FROM (SELECT doc_id FROM loss WHERE pred <> label ORDER BY doc_id LIMIT 20) UNION SELECT doc_id FROM (SELECT doc_id FROM loss ORDER BY nll DESC, doc_id LIMIT 20)",
    ),
)
def focus_set(t):
    return ev.focus_set(_probs(t), 20, "doc_id")


ERRORS = f"err AS (SELECT *, CASE WHEN label = 0 THEN 'FP' ELSE 'FN' END AS error FROM scored WHERE label <> CAST(score >= {THR} AS INTEGER))"


@query("error_rows", with_ctes(SCORED, ERRORS, "SELECT doc_id, error FROM err"))
def error_rows(t):
    return ev.errors(t.scored(), THR).select("doc_id", "error")


@query(
    "failure_examples",
    with_ctes(
        SCORED, ERRORS,
        """SELECT 'surest_fn' AS example, doc_id, score FROM (SELECT * FROM err WHERE error = 'FN' ORDER BY score, doc_id LIMIT 1)
        UNION ALL SELECT 'borderline_fp', doc_id, score FROM (SELECT * FROM err WHERE error = 'FP' AND score BETWEEN 0.5 AND 0.6 ORDER BY doc_id LIMIT 1)
        UNION ALL SELECT 'surest_fp', doc_id, score FROM (SELECT * FROM err WHERE error = 'FP' ORDER BY score DESC, doc_id LIMIT 1)""",
    ),
)
def failure_examples(t):
    return ev.pick_failures(ev.errors(t.scored(), THR), "doc_id", lo=0.5, hi=0.6).select("example", "doc_id", "score")


@query(
    "extreme_errors",
    with_ctes(
        SCORED, ERRORS,
        """SELECT (SELECT doc_id FROM err WHERE error = 'FP' ORDER BY score DESC, doc_id LIMIT 1) AS fp_id, (SELECT max(score) FROM err WHERE error = 'FP') AS fp_score,
          (SELECT doc_id FROM err WHERE error = 'FN' ORDER BY score, doc_id LIMIT 1) AS fn_id, (SELECT min(score) FROM err WHERE error = 'FN') AS fn_score,
          (SELECT count(*) FROM err WHERE error = 'FP') AS n_fp, (SELECT count(*) FROM err WHERE error = 'FN') AS n_fn""",
    ),
)
def extreme_errors(t):
    return ev.extremes(ev.errors(t.scored(), THR), "doc_id")


@query(
    "zscale",
    """SELECT event_id, round((value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events), 6) AS value_z,
      round((user_id - (SELECT avg(user_id) FROM events)) / (SELECT stddev_pop(user_id) FROM events), 6) AS user_id_z, 0.0::DOUBLE AS one_z FROM events""",
)
def zscale(t):
    out = num.zscale(t.read("events").withColumn("one", F.lit(1.0)), ["value", "user_id", "one"])
    return rounded(out.select("event_id", "value_z", "user_id_z", "one_z"), "value_z", "user_id_z")


@query(
    "row_vectors",
    """SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 5) AS norm,
      CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best,
      round(exp(list_max(embedding)::DOUBLE) / list_sum(list_transform(embedding, lambda x: exp(x::DOUBLE))), 6) AS top_prob FROM embeddings""",
)
def row_vectors(t):
    return t.read("embeddings").select(
        "vec_id", F.round(num.l2_norm("embedding"), 5).alias("norm"), num.argmax("embedding").alias("best"),
        F.round(F.array_max(num.softmax("embedding")), 6).alias("top_prob"),
    )


@query(
    "meta_features",
    f"SELECT doc_id, round(ln(1 + len({sql_simple('text')})), 6) AS doc_len, CAST(contains(lower(text), 'http') AS INTEGER)::DOUBLE AS has_url, 0.0::DOUBLE AS emotion_score FROM documents",
)
def meta_features(t):
    docs = t.read("documents").select("doc_id", F.col("text").alias("text_all"))
    out = feat.meta_features(docs, "text_all")
    return rounded(out.select("doc_id", "doc_len", "has_url", "emotion_score"), "doc_len")


@query(
    "isotonic_fit",
    """WITH p AS (SELECT n_chars AS x, sum(quality) AS total, count(*) AS w FROM documents JOIN labels USING (doc_id) GROUP BY n_chars),
    c AS (SELECT *, row_number() OVER (ORDER BY x) AS i, sum(total) OVER (ORDER BY x) AS cy, sum(w) OVER (ORDER BY x) AS cw FROM p),
    pair AS (SELECT a.i AS a, b.i AS b, (b.cy - a.cy + a.total)::DOUBLE / (b.cw - a.cw + a.w) AS m FROM c a JOIN c b ON a.i <= b.i),
    low AS (SELECT a, b AS i, min(m) OVER (PARTITION BY a ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS m FROM pair)
    SELECT x::DOUBLE AS score, w AS weight, round(max(m), 6) AS calibrated FROM low JOIN c USING (i) GROUP BY x, w""",
)
def isotonic_fit(t):
    """The rising step function of quality over text length; the twin is the max-min formula."""
    rows = t.read("documents").join(t.read("labels"), "doc_id")
    return calibration.isotonic_fit(rows, "n_chars", "quality").withColumn("calibrated", F.round("calibrated", 6))
