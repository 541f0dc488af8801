"""Token functions on ``array<string>`` columns. None of them shuffles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threadloom import reference_tables as ref
from threadloom.functions.text import (
    _lookup,
    as_column,
    let,
    one_of,
    replace_contractions,
    text_or_empty,
    words,
)


def alpha_tokens(c: Column | str) -> Column:
    """Lower-case runs of the letters a to z."""
    return F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit("[a-z]+"), F.lit(0))


def simple_tokens(c: Column | str) -> Column:
    """White-space words without outer punctuation, three characters or kept."""
    trimmed = F.transform(
        words(c), lambda w: F.lower(F.btrim(w, F.lit(ref.TOKENIZER_TRIM)))
    )
    return F.filter(
        trimmed,
        lambda w: (w != "")
        & ~one_of(w, ref.TOKENIZER_JUNK)
        & ((F.length(w) >= 3) | one_of(w, ref.KEEP_SHORT)),
    )


def join_units(lows: Column, junk=None, table: dict[str, str] | None = None) -> Column:
    """Filter trimmed tokens and glue a number to the unit behind it.

    A number counts only when it would be kept by itself, so it needs three
    digits; the pair comes out as one token. Looking one token back is enough,
    because a glued pair is no number any more.
    """
    table = ref.CONTRACTIONS if table is None else table
    junk = ref.NORMALISER_JUNK if junk is None else junk
    parts = F.create_map(
        *[x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v.split())))]
    )
    empty = F.array().cast("array<string>")

    def is_number(w: Column) -> Column:
        return F.coalesce(w.rlike(r"^\p{Nd}{3,}$"), F.lit(False))

    def bad(w: Column) -> Column:
        fragment = F.lit(False)
        for piece in ref.NORMALISER_FRAGMENTS:
            fragment = fragment | F.contains(w, F.lit(piece))
        return (
            one_of(w, junk)
            | fragment
            | F.startswith(w, F.lit("<"))
            | F.endswith(w, F.lit(">"))
            | one_of(w, ref.NORMALISER_LITERALS)
        )

    def pick(arr: Column):
        def one(w: Column, i: Column) -> Column:
            before = F.get(arr, i - 1)
            after = F.get(arr, i + 1)
            opens = is_number(w) & one_of(after, ref.UNITS)
            closes = one_of(w, ref.UNITS) & is_number(before)
            return (
                F.when(w == "", empty)
                .when(
                    F.contains(w, F.lit("'")) & one_of(w, table),
                    parts[w],
                )
                .when(bad(w), empty)
                .when(closes, F.array(F.concat(before, w)))
                .when(opens, empty)
                .when((F.length(w) < 3) & ~one_of(w, ref.KEEP_SHORT), empty)
                .otherwise(F.array(w))
            )

        return F.flatten(F.transform(arr, one))

    return let(lows, pick)


def normalize_tokens(c: Column | str) -> Column:
    """The minimal normaliser: trim, contraction look-up, junk out, units glued."""
    lows = F.transform(
        words(c),
        lambda w: F.lower(
            F.btrim(F.translate(w, ref.CURLY, ref.STRAIGHT), F.lit(ref.NORMALISER_TRIM))
        ),
    )
    return join_units(lows)


CASUAL_PATTERN = "|".join(
    [
        r"https?://[^ \t-\r<>]+",
        r"[@#][\p{L}\p{Nd}_]+",
        r"[\p{L}\p{M}]+(?:['\x{2019}_-][\p{L}\p{M}]+)*",
        r"\p{Nd}+(?:[.,:/]\p{Nd}+)*",
        r"\.{2,}",
        r"[^\p{L}\p{M}\p{Nd}\p{Z}\t-\r]",
    ]
)


def casual_tokens(c: Column | str) -> Column:
    """Words with inner apostrophes, numbers, links, punctuation marks; lower case."""
    return F.transform(
        F.regexp_extract_all(text_or_empty(c), F.lit(CASUAL_PATTERN), F.lit(0)),
        F.lower,
    )


def strip_digits(tokens: Column | str) -> Column:
    return F.transform(as_column(tokens), lambda w: F.regexp_replace(w, "[0-9]+", ""))


def expand_tokens(tokens: Column | str) -> Column:
    """Contraction expansion inside each token; the result may hold a space."""
    return F.transform(as_column(tokens), lambda w: replace_contractions(w, ref.CONTRACTIONS))


def filter_stops(tokens: Column | str, stops: list[str]) -> Column:
    """Drop punctuation marks, stop words, single characters, words with a blank."""
    drop = [*ref.ASCII_PUNCTUATION, *stops]
    return F.filter(
        as_column(tokens),
        lambda w: ~one_of(w, drop) & (F.length(w) > 1) & ~F.contains(w, F.lit(" ")),
    )


def light_filter(tokens: Column | str) -> Column:
    return F.filter(
        as_column(tokens),
        lambda w: ~one_of(w, ref.CUSTOM_STOPS)
        & (F.length(w) > 1)
        & ~F.contains(w, F.lit(" ")),
    )


def ngrams(tokens: Column | str, lo: int = 1, hi: int = 2) -> Column:
    """All runs of ``lo`` to ``hi`` tokens, joined by a blank."""

    def grams(arr: Column) -> Column:
        parts = []
        for n in range(lo, hi + 1):
            if n == 1:
                parts.append(arr)
                continue
            shifted = arr
            for step in range(1, n):
                tail = F.slice(arr, step + 1, F.greatest(F.size(arr) - step, F.lit(0)))
                shifted = F.zip_with(shifted, tail, lambda a, b: F.concat(a, F.lit(" "), b))
            parts.append(F.filter(shifted, lambda g: g.isNotNull()))
        return F.concat(*parts)

    return let(as_column(tokens), grams)


def term_tokens(c: Column | str) -> Column:
    """Lower-case word runs of two or more word characters."""
    return F.regexp_extract_all(
        F.lower(text_or_empty(c)), F.lit(r"[\p{L}\p{N}\p{M}_]{2,}"), F.lit(0)
    )


