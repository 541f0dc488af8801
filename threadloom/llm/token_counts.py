"""Token counts of whole texts under a word-end BPE vocabulary.

A text is cut at ASCII white space into pre-tokens. The vocabulary's own splitting
never joins characters across white space, so the count of a text is the sum over
its pre-tokens, special strings included (they hold no white space).

Two tiers answer for a pre-token. The first is a table of frequent pre-tokens with
their lengths, broadcast to all tasks; its size is fixed by a parameter. The second
is a cache in each worker, filled by the tokenizer library. Pre-tokens are never
shuffled: each task sums up the frequent ones in a summary of bounded size, and
only these summaries meet.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from threadloom.llm.shared import id_and_text, kept_in_worker, pieces_of, raw_texts

#: Entries of the broadcast table; about 12 bytes each.
FREQUENT = 1 << 16
#: Entries of a worker's cache, which starts anew when full.
CACHED = 1 << 19

COUNTED = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def prune(counts: Counter, keep: int) -> Counter:
    """Cut a summary to ``keep`` counters, each less by the largest count cut off.

    Summaries stay mergeable: a pre-token more frequent than total / keep survives.
    """
    if len(counts) <= keep:
        return counts
    floor = sorted(counts.values(), reverse=True)[keep]
    return Counter({w: n - floor for w, n in counts.items() if n > floor})


def pack_summary(counts: Counter) -> tuple[bytes, list[int]]:
    """Pre-tokens hold no white space, so a blank can part them."""
    return b" ".join(counts), list(counts.values())


def unpack_summary(words: bytes, counts: list[int]) -> Counter:
    return Counter(dict(zip(words.split(), counts)))


def summarise(keep: int):
    """One summary a task."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in raw_texts(batch):
                if text:
                    counts.update(text.split())
                    if len(counts) > 8 * keep:
                        counts = prune(counts, keep)
        words, numbers = pack_summary(prune(counts, keep))
        yield pa.RecordBatch.from_arrays(
            [pa.array([words], pa.binary()), pa.array([numbers], pa.list_(pa.int64()))], ["words", "counts"]
        )

    return run


def merge_summaries(keep: int):
    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for words, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total.update(unpack_summary(words, counts))
                if len(total) > 8 * keep:
                    total = prune(total, keep)
        words, numbers = pack_summary(prune(total, keep))
        yield pa.RecordBatch.from_arrays(
            [pa.array([words], pa.binary()), pa.array([numbers], pa.list_(pa.int64()))], ["words", "counts"]
        )

    return run


def frequent_pretokens(docs: DataFrame, keep: int = FREQUENT, fan_in: int = 64) -> list[bytes]:
    """The most frequent pre-tokens of all texts.

    Summaries of at most ``keep`` entries meet in a tree of fixed width: a few
    thousand tasks, then ``fan_in``, then one. No task reads more than the
    summaries of its branch, one at a time.
    """
    schema = "words binary, counts array<long>"
    level = docs.select("text").mapInArrow(summarise(keep), schema)
    for width in (fan_in, 1):
        level = level.repartition(width).mapInArrow(merge_summaries(keep), schema)
    merged: Counter = Counter()
    for row in level.collect():
        merged.update(unpack_summary(bytes(row["words"]), row["counts"]))
    return list(prune(merged, keep))


def load_tokenizer(source: bytes):
    """The library's tokenizer, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(source.decode("utf-8"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def lengths_of(tokenizer, words: list[bytes]) -> list[int]:
    texts = [w.decode("utf-8", "replace") for w in words]
    return [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class TwoTierLengths:
    """Lengths of pre-tokens: the frequent table first, then this worker's cache."""

    def __init__(self, tokenizer, frequent: dict[bytes, int], cached: int):
        self.tokenizer, self.frequent, self.cached = tokenizer, frequent, cached
        self.cache: dict[bytes, int] = {}

    def count(self, texts: list[bytes | None]) -> list[int]:
        """Token counts of texts; the misses of all of them are encoded in one call."""
        known, cache = self.frequent.get, self.cache
        sums, missed = [], []
        for text in texts:
            lengths = list(map(known, words := text.split())) if text else []
            rest = [w for w, n in zip(words, lengths) if n is None] if None in lengths else []
            sums.append(sum(n for n in lengths if n is not None) if rest else sum(lengths))
            missed.append(rest)
        new = list({w for rest in missed for w in rest if w not in cache})
        if new:
            if len(cache) + len(new) > self.cached:
                cache.clear()
                new = list({w for rest in missed for w in rest})
            for at in range(0, len(new), 4096):
                part = new[at : at + 4096]
                cache.update(zip(part, lengths_of(self.tokenizer, part)))
        return [n + sum(map(cache.__getitem__, rest)) if rest else n for n, rest in zip(sums, missed)]


def count_tokens(docs: DataFrame, vocabulary: bytes, limit: int, frequent: int = FREQUENT, cached: int = CACHED) -> DataFrame:
    """Token counts of ``docs`` (doc_id, text) under a vocabulary file's content."""
    sc = docs.sparkSession.sparkContext
    words = frequent_pretokens(docs, frequent)
    lengths = lengths_of(load_tokenizer(vocabulary), words) if words else []
    sent = sc.broadcast((vocabulary, b" ".join(words), lengths))

    key = f"tiers-{uuid.uuid4().hex}"

    def build() -> TwoTierLengths:
        source, joined, numbers = sent.value
        return TwoTierLengths(load_tokenizer(source), dict(zip(joined.split(), numbers)), cached)

    def run(batches):
        tiers = kept_in_worker(key, build)
        for batch in batches:
            for part in pieces_of(batch):
                texts = raw_texts(part)
                tokens = pa.array(tiers.count(texts), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index("doc_id")),
                        pa.array([len(t) if t else 0 for t in texts], pa.int64()),
                        tokens,
                        pc.greater(tokens, limit),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.mapInArrow(run, COUNTED)


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text", frequent: int = FREQUENT, cached: int = CACHED) -> DataFrame:
    """Bytes and tokens of every text, and whether it is over ``limit`` tokens.

    One row per input row, repeated rows included. A null or empty text has 0 bytes
    and 0 tokens; a null id stays null. An empty table gives no rows. Other columns
    are not read.
    """
    with open(vocabulary_path, "rb") as source:
        vocabulary = source.read()
    picked = id_and_text(docs, id_col, text_col)
    return count_tokens(picked, vocabulary, limit, frequent, cached)
