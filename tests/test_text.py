import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from threadloom.functions import numeric as num, text as tx, tokens as tk
from threadloom.operators.stems import stem_tokens, stem_word


def test_clean_text(one):
    assert one(tx.clean_text("t"), t="See http://a.b/c u/Bob-1 you/me  OK") == "see yo ok"
    assert one(tx.clean_text("t"), t="A B\x1c\n  C") == "a b c"
    assert one(tx.clean_text(F.lit(None).cast("string"))) == ""


def test_contractions_take_the_first_alternative(one):
    table = {"i'm": "I am", "can't": "cannot", "can't've": "cannot have"}
    got = one(tx.expand_contractions("t", table), t="so I'm sure I can't've it")
    assert got == "so I am sure i cannot've it"
    assert one(tx.expand_contractions("t"), t="Plain text") == "plain text"
    assert one(tx.expand_contractions("t"), t="xcan'ty 'cause") == "xcannoty because"


def test_contraction_table_without_apostrophes(one):
    assert one(tx.expand_contractions("t", {"ab": "X", "abc": "Y"}), t="abcab") == "XcX"


def test_sequential_contractions_are_case_sensitive(one):
    assert one(tx.expand_sequential("t"), t="don't Don't i'm") == "do not Don't i am"


def test_remove_urls(one):
    assert one(tx.remove_urls("t"), t="see https://a.B/c?x=1! now~http://q") == "see  now~"


@pytest.mark.parametrize(
    "text, want",
    [
        ("100 mg dose", ["100mg", "dose"]),
        ("10 mg dose", ["dose"]),
        ("I’m sad", ["I", "am", "sad"]),
        ("500 250 % kg", ["500", "250%"]),
        ("see http://x.y <b> [removed] faq text", ["see", "removed"]),
        ("(hello), world!", ["hello", "world"]),
        ("", []),
    ],
)
def test_normalize_tokens(one, text, want):
    assert one(tk.normalize_tokens("t"), t=text) == want


def test_simple_tokens(one):
    assert one(tk.simple_tokens("t"), t="The (ECG) is a -- [removed] ok mom's") == ["the", "ecg", "removed", "mom's"]


def test_casual_tokens(one):
    got = one(tk.casual_tokens("t"), t="Don't go... @me 3.5 <ok>!")
    assert got == ["don't", "go", "...", "@me", "3.5", "<", "ok", ">", "!"]


def test_ngrams(one):
    toks = F.array(*map(F.lit, "abc"))
    assert one(tk.ngrams(toks, 1, 3)) == ["a", "b", "c", "a b", "b c", "a b c"]
    assert one(tk.ngrams(F.array().cast("array<string>"), 1, 2)) == []


def test_paragraphs(one):
    assert one(tx.paragraphs("t"), t=" a \n\n\n b\nc \n\n ") == ["a", "b\nc"]
    assert one(tx.paragraphs("t"), t="   ") == ["   "]
    assert one(tx.paragraphs("t"), t="") == []


def test_smart_truncate(one):
    text = "abcdefghijklmnopqrstuvwxyz0123456789ABCD"
    assert one(tx.smart_truncate("t", 29), t=text) == "abcdefgh...[truncated]...ABCD"
    assert one(tx.smart_truncate("t", 40), t=text) == text
    assert one(tx.smart_truncate("t", 10), t=text) == "abcdefg..."


def test_topic_label(one):
    def label(words, **kw):
        return one(tx.topic_label(F.array(*map(F.lit, words)), **kw))

    assert label(["I", "am", "panic", "attack", "night", "sleep"]) == "panic / attack / night"
    assert label(["I", "am"]) == "I / am"
    assert label(["abcdefghij", "klmnopqrst"], limit=12) == "abcdefghij /..."
    assert one(tx.topic_label(F.array().cast("array<string>"))) == "empty_topic"


def test_post_id_from_url(one):
    assert one(tx.post_id_from_url("t"), t="https://h/r/x/comments/abc1/title/") == "abc1"
    assert one(tx.post_id_from_url("t"), t="abc1") == "abc1"


def test_months_before_keeps_the_time(spark):
    row = spark.sql("SELECT timestamp'2024-01-31 10:20:30' AS ts").select(
        F.date_format(tx.months_before(F.col("ts"), 2), "yyyy-MM-dd HH:mm:ss").alias("x")
    ).first()
    assert row["x"] == "2023-11-30 10:20:30"


@pytest.mark.parametrize("value, want", [(0.5, 0), (1.5, 2), (2.5, 2), (-0.5, 0)])
def test_half_even(one, value, want):
    assert one(num.half_even("v"), v=value) == want


@pytest.mark.parametrize("value, want", [(-0.1, 5), (0.0, 0), (0.2, 1), (0.5, 2), (0.79, 3), (0.8, 4), (1.0, 5), (float("nan"), 5)])
def test_severity_bucket(one, value, want):
    assert one(num.severity_bucket("v"), v=value) == want


def test_vectors(one):
    a = F.array(F.lit(3.0), F.lit(4.0))
    assert one(num.l2_norm(a)) == 5.0
    assert one(num.cosine(a, a)) == pytest.approx(1.0)
    assert one(num.argmax(F.array(F.lit(1.0), F.lit(2.0), F.lit(2.0)))) == 1
    assert one(num.softmax(F.array(F.lit(0.0), F.lit(0.0)))) == [0.5, 0.5]


STEMS = {
    "running": "run", "happiness": "happi", "generously": "generous", "consistently": "consist",
    "cried": "cri", "hopping": "hop", "hoped": "hope", "relational": "relat", "ties": "tie",
    "gas": "gas", "kiwis": "kiwi", "luxuriated": "luxuri", "controlled": "control", "try": "tri",
    "say": "say", "enjoy": "enjoy", "because": "becaus", "people": "peopl", "adoption": "adopt",
    "national": "nation", "communication": "communic", "sky": "sky", "proceeding": "proceed",
}


@pytest.mark.parametrize("word, want", STEMS.items())
def test_stem_word(word, want):
    assert stem_word(word) == want


def test_stem_tokens_keeps_lists(spark):
    rows = spark.createDataFrame([(1, ["running", "by"]), (2, []), (3, None), (4, ["running"])], "i int, t array<string>")
    got = {r["i"]: r["s"] for r in rows.select("i", stem_tokens("t").alias("s")).collect()}
    assert got == {1: ["run", "by"], 2: [], 3: [], 4: ["run"]}


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-50, 50), min_size=1, max_size=6))
def test_softmax_sums_to_one(spark, values):
    got = spark.range(1).select(num.softmax(F.array(*map(F.lit, values))).alias("x")).first()["x"]
    assert sum(got) == pytest.approx(1.0)
