"""Token counts and piece encoding against the libraries, on odd texts."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadloom.llm import sentence_pieces, token_counts

TEXTS = [
    (1, "The quick  brown fox"), (2, None), (3, ""), (4, " \t\n "), (5, "a<|endoftext|>b <|startoftext|>"),
    (6, "word " * 3000), (7, "x" * 20000), (8, "İstanbul ÀΣ \x1cab\x85c  d 'S 's"), (9, "日本語 テキスト😀"),
    (10, "  two  blanks\n\nlines\r\n\tend "), (11, "▁mark ▁▁"), (12, "<s> </s> <unk> <0x41>"), (5, "a<|endoftext|>b <|startoftext|>"),
    (None, "no id"), (14, "é ́"), (15, "▁"), (16, "\n"),
]


@pytest.fixture
def docs(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    return df.withColumns({"n_tokens": F.lit("clash"), "n_bytes": F.lit(1), "agrees": F.lit(0)}).repartition(3)


def test_counts_equal_the_library(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    want = sorted(
        ((i, len((t or "").encode()), n, n > 2048) for i, t in TEXTS for n in [len(tokenizer.encode(t or "", add_special_tokens=False).ids)]),
        key=str,
    )
    for frequent, cached in ((1 << 16, 1 << 19), (2, 3)):  # the second hardly keeps anything
        got = token_counts.token_counts(docs, path, frequent=frequent, cached=cached).collect()
        assert sorted((tuple(r) for r in got), key=str) == want


def test_summaries_keep_what_is_frequent():
    counts = token_counts.Counter({b"a": 100, b"b": 60, b"c": 3, b"d": 2})
    assert set(token_counts.prune(counts, 2)) == {b"a", b"b"}
    assert token_counts.prune(counts, 9) == counts


def test_pieces_equal_the_library(docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    want = []
    for i, text in TEXTS:
        ids = library.encode(text or "")
        packed = np.array([library.bos_id(), *ids, library.eos_id()], dtype="<u4").tobytes()
        want.append((i, len(ids) + 2, hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), True))
    for cached in (1 << 18, 4):
        got = sentence_pieces.encode_and_decode(docs, path, cached=cached).collect()
        assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_a_word_that_differs_takes_the_library_ids():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as source:
        encoder = sentence_pieces.Encoder(source.read())
    encoder.words["▁fox"] = b"\0\0\0\0"
    encoder.words.fresh.append("▁fox")
    assert encoder.check() == {"▁fox"}
    assert np.frombuffer(encoder.encode("fox"), dtype="<u4").tolist() == encoder.library.encode("fox")


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert sentence_pieces.encode_and_decode(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
