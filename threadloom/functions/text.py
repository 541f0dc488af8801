"""String functions: cleaning, contractions, truncation, small parsers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from threadloom import reference_tables as ref

# The characters Unicode counts as white space, spelled out because regex
# engines disagree about \s: once as a class, once as a list for trimming.
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NON_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A plain Python variable would repeat the expression at every use.
    """
    return F.get(F.transform(F.array(value), body), 0)


def one_of(c: Column, words) -> Column:
    """Membership in a fixed list; false for null."""
    return F.coalesce(c.isin(list(words)), F.lit(False))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(as_column(c), F.lit(""))


def strip(c: Column) -> Column:
    """Trim white space of any kind at both ends."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def words(c: Column | str) -> Column:
    """Split at white space, no empty strings."""
    return F.regexp_extract_all(text_or_empty(c), F.lit(f"{NON_SPACE}+"), F.lit(0))


def word_count(c: Column | str) -> Column:
    return F.regexp_count(text_or_empty(c), F.lit(f"{NON_SPACE}+"))


def text_length(c: Column | str) -> Column:
    return F.length(text_or_empty(c))


def clean_text(c: Column | str) -> Column:
    """Lower case, links and user mentions out, white space collapsed.

    The two removals run only on texts holding their literal part.
    """

    def links(s: Column) -> Column:
        found = F.contains(s, F.lit("http")) | F.contains(s, F.lit("www."))
        return F.when(
            found, F.regexp_replace(s, rf"http{NON_SPACE}+|www\.{NON_SPACE}+", " ")
        ).otherwise(s)

    def mentions(s: Column) -> Column:
        return F.when(
            F.contains(s, F.lit("u/")), F.regexp_replace(s, "u/[A-Za-z0-9_-]+", " ")
        ).otherwise(s)

    s = let(let(F.lower(text_or_empty(c)), links), mentions)
    return F.trim(F.regexp_replace(s, f"{SPACE}+", " "))


def clean_word_count(c: Column) -> Column:
    """Words of an already cleaned text, where single blanks part them."""
    return F.when(c == "", 0).otherwise(F.size(F.split(c, " ")))


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def expand_contractions(c: Column | str, table: dict[str, str] | None = None) -> Column:
    """Single pass, leftmost match, alternatives tried in table order.

    The text is lowercased first. Rows without an apostrophe skip the work
    when every key of the table holds one.
    """
    table = ref.CONTRACTIONS if table is None else table
    return let(F.lower(text_or_empty(c)), lambda s: replace_contractions(s, table))


def replace_contractions(s: Column, table: dict[str, str]) -> Column:
    """Replace table keys in a lower-case text in one pass.

    Where every key has its first apostrophe behind letters only, texts without
    one are left alone, and the alternatives are tried only where letters lead
    up to one.
    """
    pattern = "(?:" + "|".join(table) + ")"
    spelled = all(key.partition("'")[1] and (key.partition("'")[0] + "a").isalpha() for key in table)
    if spelled:
        pattern = "(?=[a-z]*')" + pattern
    mapping = _lookup(table)
    gaps = F.split(s, pattern, -1)
    hits = F.regexp_extract_all(s, F.lit(pattern), F.lit(0))
    joined = F.array_join(
        F.zip_with(gaps, hits, lambda g, h: F.concat(g, F.coalesce(mapping[h], F.lit("")))), ""
    )
    return F.when(F.contains(s, F.lit("'")), joined).otherwise(s) if spelled else joined


def expand_sequential(c: Column | str, table: dict[str, str] | None = None) -> Column:
    """Case-sensitive literal replacements, one after the other."""
    table = ref.SCORER_CONTRACTIONS if table is None else table
    return reduce(
        lambda s, kv: F.replace(s, F.lit(kv[0]), F.lit(kv[1])),
        table.items(),
        text_or_empty(c),
    )


def remove_urls(c: Column | str) -> Column:
    """Delete ``http(s)://`` and the run of URL characters behind it.

    The run takes every character from ``$`` to ``_``, lower-case letters and
    the exclamation mark.
    """
    return F.regexp_replace(text_or_empty(c), r"https?://[a-z!$-_]+", "")


def compose_main(title_clean: Column, body_clean: Column) -> Column:
    return strip(F.concat(text_or_empty(title_clean), F.lit("\n\n"), text_or_empty(body_clean)))


def compose_all(main: Column, comments: Column) -> Column:
    return strip(F.concat(text_or_empty(main), F.lit("\n\n"), text_or_empty(comments)))


def compose_full(title: Column, body: Column) -> Column:
    return F.concat(text_or_empty(title), F.lit(" "), text_or_empty(body))


def paragraphs(c: Column | str) -> Column:
    """Split at two or more newlines; a text of blanks only stays whole."""

    def cut(s: Column) -> Column:
        parts = F.filter(F.transform(F.split(s, "\n{2,}", -1), strip), lambda p: p != "")
        return (
            F.when(s == "", F.array().cast("array<string>"))
            .when(F.size(parts) == 0, F.array(s))
            .otherwise(parts)
        )

    return let(text_or_empty(c), cut)


def has_url(c: Column | str) -> Column:
    return F.contains(F.lower(text_or_empty(c)), F.lit("http"))


def is_anxiety_category(c: Column | str) -> Column:
    low = F.lower(text_or_empty(c))
    return F.contains(low, F.lit("anx")) | F.contains(low, F.lit("panic"))


def smart_truncate(c: Column | str, limit: int) -> Column:
    """Keep 70 % of the room at the front and the rest at the end."""
    s = text_or_empty(c)
    mark = ref.TRUNCATION_MARK
    room = limit - len(mark)
    head = int(room * 0.7)
    tail = room - head
    if room <= 0 or tail <= 0:
        cut = F.concat(F.substring(s, 1, max(limit - 3, 0)), F.lit("..."))
    else:
        cut = F.concat(F.substring(s, 1, head), F.lit(mark), F.right(s, F.lit(tail)))
    return F.when(F.length(s) <= limit, s).otherwise(cut)


def estimate_tokens(c: Column | str) -> Column:
    return F.floor(F.length(text_or_empty(c)) / 3).cast("bigint")


def preview(c: Column | str, limit: int = 200) -> Column:
    s = text_or_empty(c)
    return F.when(
        F.length(s) > limit, F.concat(F.substring(s, 1, limit), F.lit("..."))
    ).otherwise(s)


def post_id_from_url(c: Column | str) -> Column:
    """The segment behind ``/comments/``, else the input itself."""
    s = as_column(c)
    found = F.nullif(F.regexp_extract(s, "/comments/([^/]*)", 1), F.lit(""))
    return F.coalesce(found, s)


def topic_label(terms: Column, n: int = 3, limit: int = 35) -> Column:
    """First ``n`` words longer than two characters, joined and cut."""
    long_words = F.filter(terms, lambda w: F.length(w) > 2)
    picked = F.when(F.size(long_words) > 0, long_words).otherwise(terms)
    joined = F.array_join(F.slice(picked, 1, n), " / ")
    cut = F.when(
        F.length(joined) > limit, F.concat(F.substring(joined, 1, limit), F.lit("..."))
    ).otherwise(joined)
    return F.when(F.size(terms) > 0, cut).otherwise(F.lit("empty_topic"))


def to_timestamp(epoch: Column | str) -> Column:
    """Seconds since 1970 to a timestamp; anything else gives null."""
    return F.timestamp_seconds(as_column(epoch).try_cast("double"))


def format_day(ts: Column | str) -> Column:
    return F.date_format(as_column(ts), "yyyy-MM-dd")


def months_before(ts: Column, months: int) -> Column:
    """Calendar months back, time of day kept."""
    return ts - F.make_ym_interval(F.lit(0), F.lit(months))
