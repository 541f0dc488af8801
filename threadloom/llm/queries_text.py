"""Queries over whole texts: token counts and piece encoding."""

from __future__ import annotations

import public_tokenizers

from threadloom.llm import sentence_pieces, token_counts
from threadloom.llm.registry import query, table


@query("op1_token_counts")
def op1_token_counts(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_sentence_pieces")
def op8_sentence_pieces(spark, folder):
    return sentence_pieces.encode_and_decode(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
