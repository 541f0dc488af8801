"""English suffix stripping after the published Snowball description.

Chains of column expressions for its five steps take twenty times longer than
one look-up per distinct word, so this is an Arrow function: a batch of token
lists is reduced to its distinct words, those are stemmed, and the lists are
put together again by index.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

# ---------------------------------------------------------------------------
# Fixed values of the published algorithm.
# ---------------------------------------------------------------------------
SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli",
    "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
DONE_AFTER_PLURAL = {
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
}
LONG_PREFIX = ("gener", "commun", "arsen")
STEP2 = {
    "ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous",
    "iveness": "ive", "tional": "tion", "biliti": "ble", "lessli": "less",
    "entli": "ent", "ation": "ate", "alism": "al", "aliti": "al", "ousli": "ous",
    "iviti": "ive", "fulli": "ful", "enci": "ence", "anci": "ance", "abli": "able",
    "izer": "ize", "ator": "ate", "alli": "al", "bli": "ble",
}
STEP3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic",
    "ative": "", "ical": "ic", "ness": "", "ful": "",
}
STEP4 = [
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate",
    "iti", "ous", "ive", "ize", "ion", "al", "er", "ic",
]
VOWEL_THEN_NOT = re.compile("[aeiouy][^aeiouy]")
SHORT_END = re.compile("(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$")
DOUBLE_END = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")


def _after(word: str, start: int) -> int:
    hit = VOWEL_THEN_NOT.search(word, start)
    return hit.end() if hit else len(word)


def _regions(word: str) -> tuple[int, int]:
    first = next((len(p) for p in LONG_PREFIX if word.startswith(p)), None)
    r1 = _after(word, 0) if first is None else first
    return r1, _after(word, r1)


def _longest(word: str, suffixes) -> str | None:
    return next((s for s in sorted(suffixes, key=len, reverse=True) if word.endswith(s)), None)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith("s") and not word.endswith(("us", "ss")) and re.search("[aeiouy]", word[:-2]):
        return word[:-1]
    return word


def _past(word: str, r1: int) -> str:
    end = _longest(word, ("eedly", "ingly", "edly", "eed", "ing", "ed"))
    if end is None:
        return word
    base = word[: -len(end)]
    if end in ("eed", "eedly"):
        return base + "ee" if len(base) >= r1 else word
    if not re.search("[aeiouy]", base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if base.endswith(DOUBLE_END):
        return base[:-1]
    return base + "e" if SHORT_END.search(base) and r1 >= len(base) else base


def _derived(word: str, r1: int, r2: int) -> str:
    end = _longest(word, [*STEP2, "ogi", "li"])
    if end and len(word) - len(end) >= r1:
        before = word[: -len(end)]
        if end in STEP2:
            word = before + STEP2[end]
        elif (end == "ogi" and before.endswith("l")) or (end == "li" and before[-1:] in tuple("cdeghkmnrt")):
            word = before + ("og" if end == "ogi" else "")
    end = _longest(word, STEP3)
    if end and len(word) - len(end) >= (r2 if end == "ative" else r1):
        word = word[: -len(end)] + STEP3[end]
    end = _longest(word, STEP4)
    if end and len(word) - len(end) >= r2 and (end != "ion" or word[-4:-3] in ("s", "t")):
        word = word[: -len(end)]
    return word


@lru_cache(maxsize=200_000)
def stem_word(word: str) -> str:
    """Stem of a lower-case word; words of one or two letters stay."""
    if len(word) <= 2:
        return word
    if word in SPECIAL:
        return SPECIAL[word]
    word = re.sub("(?:'s'|'s|')$", "", word.removeprefix("'"))
    word = re.sub("(?<=[aeiouy])y", "Y", re.sub("^y", "Y", word))
    r1, r2 = _regions(word)
    word = _plural(word)
    if word in DONE_AFTER_PLURAL:
        return word
    word = re.sub("(?<=.[^aeiouy])[yY]$", "i", _past(word, r1))
    word = _derived(word, r1, r2)
    if word.endswith("e"):
        at = len(word) - 1
        if at >= r2 or (at >= r1 and not SHORT_END.search(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word.lower()


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_tokens(tokens: pd.Series) -> pd.Series:
    """Stems of token lists, one call per distinct word of a batch."""
    lists = [[] if t is None else t for t in tokens]
    ends = np.cumsum([len(t) for t in lists])
    if not len(ends) or not ends[-1]:
        return pd.Series([[] for _ in lists])
    codes, distinct = pd.factorize(np.concatenate(lists))
    stems = np.array([stem_word(w) for w in distinct], dtype=object)
    return pd.Series(np.split(stems[codes], ends[:-1]))
