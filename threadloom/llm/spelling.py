"""Spelling variants: words one edit apart, found through an index of variable-length grams.

A dictionary of frequent grams, pruned by frequency, decides how long the gram at each
place of a word is: it is read on from three letters until it is rare, or five long.
A gram depends on its own letters alone, so one edit changes only the grams that it
lies in. Of two grams that do not overlap it changes one at most (the affected-gram
bound of such a set is one), hence two words one edit apart share the one or the
other: the left one at the same distance from the word's start, or the right one at
the same distance from its end. Of each word only the two lists that are shortest
together are merged; the index holds all grams of all words, under gram, side,
distance and word length. What meets in a list is verified by its edit distance.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.shared import id_and_text, pieces_of, raw_texts
from threadloom.session import materialize

#: Least and largest letters of a gram, the marks at both ends of a word counted.
SHORTEST, LONGEST = 3, 5
#: Grams held in more places than one in so many are read on; so many grams a length are broadcast at most.
DICTIONARY = 1 << 18
LEAST_FREQUENT = 16
#: A list of more than one in so many index entries is cut into blocks; there are no more such lists than that.
HOT_LISTS = 1 << 16
LIST_BLOCK = 4096
#: Words that a task counts before it hands its counts on.
COUNTED = 1 << 18
START, END = "^", "$"

#: Bytes of Latin-1 text: letters stay (A to Z in lower case), everything else becomes a space.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def runs_of_letters(raw: bytes) -> list[bytes]:
    """Maximal runs of Latin letters as Latin-1 bytes, A to Z in lower case."""
    return raw.decode("utf-8").encode("latin-1", "replace").translate(LETTERS).split()


def without_one(doc_id: int | None, run: bytes, every: int) -> bytes:
    """The run without the code point that its hash with the document picks, if ``every`` divides the hash."""
    named = f"{'' if doc_id is None else doc_id}:".encode()
    hashed = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), zlib.crc32(named))
    if hashed % every:
        return run
    at = hashed % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least_length: int = 7, least_count: int = 2, noise: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of whole texts and how often each occurs: word, n.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z in lower
    case, of ``least_length`` code points at least and seen ``least_count`` times.
    With ``noise`` one code point is deleted first from the runs whose CRC-32 of
    ``<doc_id>:<run>`` it divides. Null texts have no words; a null id counts as an
    empty one; repeated rows count again. Empty tables give no rows. Tasks count in
    tables of bounded size, so a frequent word is a few rows a task.
    """
    def count(batches):
        seen: Counter = Counter()

        def rows():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
            )
            seen.clear()
            return batch

        for batch in batches:
            for part in pieces_of(batch):
                for doc_id, raw in zip(part.column(part.schema.get_field_index("doc_id")).to_pylist(), raw_texts(part)):
                    if not raw:
                        continue
                    found = Counter([w for w in runs_of_letters(raw) if len(w) >= least_length])
                    if noise is None:
                        seen.update(found)
                    else:
                        for run, times in found.items():
                            word = without_one(doc_id, run, noise)
                            if len(word) >= least_length:
                                seen[word] += times
                    if len(seen) >= COUNTED:
                        yield rows()
        if seen:
            yield rows()

    counted = id_and_text(docs, id_col, text_col).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def frequent_grams(words: DataFrame) -> tuple[dict[str, int], int, int]:
    """The gram dictionary, pruned to grams in more places than a threshold; the threshold; all places.

    The threshold follows the number of places, so the dictionary is bounded.
    """
    padded = F.concat(F.lit(START), "word", F.lit(END))
    at = F.sequence(F.lit(1), F.length("word") + 1)
    longest = words.select(
        F.explode(F.transform(at, lambda i: F.substring(padded, i, F.lit(LONGEST - 1)))).alias("gram")
    ).groupBy("gram").agg(F.count("*").alias("n"))
    longest = materialize(longest, "grams")
    places = longest.agg(F.sum("n").alias("n")).first()["n"] or 0
    limit = max(LEAST_FREQUENT, places // DICTIONARY)
    grams: dict[str, int] = {}
    for size in range(2, LONGEST):
        some = longest.where(F.length("gram") >= size)
        if size < SHORTEST:  # only the ends of words are that short
            some = some.where(F.col("gram").endswith(END) & (F.length("gram") == size))
        sums = some.groupBy(F.substring("gram", 1, size).alias("gram")).agg(F.sum("n").alias("n")).where(F.col("n") > limit)
        grams.update({r["gram"]: r["n"] for r in sums.toLocalIterator()})
    return grams, limit, places


def decompose(word: str, frequent: dict[str, int], limit: int) -> list[tuple[int, int, int, str]]:
    """The grams of a word with its marks: most places that hold it, start, end, letters."""
    padded = START + word + END
    size = len(padded)
    grams = []
    for start in range(size - 1):
        end = min(start + SHORTEST, size)
        while end < size and end - start < LONGEST and padded[start:end] in frequent:
            end += 1
        gram = padded[start:end]
        places = frequent.get(gram) or (frequent[gram[:-1]] if end - start == LONGEST else limit)
        grams.append((places, start, end, gram))
    return grams


def affected(grams: list[tuple[int, int, int, str]]) -> int:
    """The most of these grams that one edit can change: the most that lie over one letter."""
    over = Counter(i for _, start, end, _ in grams for i in range(start, end))
    return max(over.values(), default=0)


def lists_to_merge(grams: list[tuple[int, int, int, str]]) -> tuple[tuple, tuple]:
    """A left and a right gram without overlap whose lists are shortest together."""
    size = grams[-1][1] + 2
    left: list = [None] * (size + 1)
    right: list = [None] * (size + 1)
    for gram in grams:
        if left[gram[2]] is None or gram < left[gram[2]]:
            left[gram[2]] = gram
        right[gram[1]] = gram
    for cut in range(1, size + 1):
        left[cut] = min((g for g in (left[cut], left[cut - 1]) if g), default=None)
        back = size - cut
        right[back] = min((g for g in (right[back], right[back + 1]) if g), default=None)
    cuts = [(left[c][0] + right[c][0], c) for c in range(size) if left[c] and right[c]]
    if not cuts:
        raise ValueError("words of this length hold no two grams side by side")
    best = min(cuts)[1]
    return left[best], right[best]


class Lists:
    """Names of lists; lists that may be long are cut into blocks by a hash of the word."""

    def __init__(self, most: int):
        self.most = most

    def name(self, gram: str, side: str, distance: int, length: int, block: int) -> int:
        """A signed 64-bit name; equal names of other lists only add words to verify."""
        return xxhash.xxh3_64_intdigest(f"{gram} {side} {distance} {length} {block}") - (1 << 63)

    def blocks(self, places: int) -> int:
        """Blocks of a list of at most so many entries."""
        return -(-places // self.most)

    def holding(self, word: str, grams: list) -> list[int]:
        """The lists that hold the word: its grams by their distance from the start and from the end."""
        size, length = len(word) + 2, len(word)
        hashed = zlib.crc32(word.encode())
        found = []
        for places, start, end, gram in grams:
            block = hashed % self.blocks(places)
            if end <= size - 2:
                found.append(self.name(gram, "start", start, length, block))
            if start >= SHORTEST:
                found.append(self.name(gram, "end", size - start, length, block))
        return found

    def merged(self, word: str, grams: list) -> list[int]:
        """The lists to merge for the word: those of words as long as it, and of those longer by one."""
        left, right = lists_to_merge(grams)
        sides = ((left, "start", left[1]), (right, "end", len(word) + 2 - right[1]))
        return [
            self.name(gram[3], side, distance, length, block)
            for gram, side, distance in sides for length in (len(word), len(word) + 1) for block in range(self.blocks(gram[0]))
        ]


def listed(words: DataFrame, sent, block: int, entries: str) -> DataFrame:
    """One row (list, word) for every entry of every word."""
    def run(batches):
        frequent, limit, places = sent.value
        lists = Lists(max(block, places // HOT_LISTS))
        for batch in batches:
            names, held = [], []
            for word in batch.column(0).to_pylist():
                own = getattr(lists, entries)(word, decompose(word, frequent, limit))
                names += own
                held += [word] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(held, pa.string())], ["list", "word"])

    return words.select("word").mapInArrow(run, "list long, word string")


def near_words(words: DataFrame, block: int = LIST_BLOCK) -> DataFrame:
    """All pairs of words one edit apart, each once: a, b.

    ``words`` holds distinct words of five code points at least. Lists that may hold more
    than ``block`` words (or one in 65,536 places) are cut into blocks, and words that
    merge them meet every block.
    """
    sent = words.sparkSession.sparkContext.broadcast(frequent_grams(words))
    held = listed(words, sent, block, "holding").withColumnRenamed("word", "b")
    merged = listed(words, sent, block, "merged").withColumnRenamed("word", "a")
    once = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    met = merged.join(held, "list").where(once & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b").distinct()


def variants(words: DataFrame, ratio: int = 10, block: int = LIST_BLOCK) -> DataFrame:
    """Words with the form they are likely a misspelling of: word, form, root, n, n_near, form_n.

    ``words`` has distinct words and their counts (word, n); other columns are not read. A
    word's form is the commonest of the words one edit apart, the smallest in code-point
    order of equally common ones, if it is ``ratio`` times as common; else null. The root
    is the end of the chain of forms. Null words are left out. Empty tables give no rows.
    """
    words = materialize(words.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")), "words")
    near = materialize(near_words(words, block), "near")
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(near.select(F.col("b").alias("word"), F.col("a").alias("other")))
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = both.join(others, "other").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("rank"), "other")).alias("best")
    )
    common = -F.col("best.rank") >= ratio * F.col("n")
    judged = materialize(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, F.col("best.other")).alias("form"), F.when(common, -F.col("best.rank")).alias("form_n"),
        ),
        "judged",
    )
    roots = chain_ends(judged.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def chain_ends(steps: DataFrame) -> DataFrame:
    """Where the chain of steps from each word ends: word, root.

    Each round doubles the steps taken. Counts grow along a chain by a factor, so
    there are only a few rounds; a word has few near words, so no key is hot.
    """
    steps = materialize(steps, "steps")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(steps.join(onward, "root", "left").select("word", "root", "next"), "steps")
        if moved.where(F.col("next").isNotNull()).isEmpty():
            return moved.select("word", "root")
        steps = moved.select("word", F.coalesce("next", "root").alias("root"))
