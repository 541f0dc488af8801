"""Encoding and decoding with a merge-type SentencePiece vocabulary.

Text is a chain of symbols. An agenda holds the adjacent pairs that the vocabulary
knows, best score first, leftmost first among equals; the top pair is joined, and
the pairs that the joined symbol forms with its neighbours enter the agenda. What is
left is looked up; characters that are not in the vocabulary become byte pieces.

No piece of the vocabulary has a word mark behind another character, so pairs never
form across the start of a word: words are encoded one by one and kept in a cache.
In every Arrow batch, all words that went through the agenda are checked against the
library. One that differs gets the library's ids in every text of the batch and after,
and the column ``agrees`` tells which texts held it.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threadloom.llm.shared import id_and_text, kept_in_worker, pieces_of

MARK = "▁"
#: Words in a worker's cache.
CACHED = 3 << 18

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean"


class Agenda:
    """Merge-type encoder over the pieces and scores of a vocabulary."""

    def __init__(self, library):
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (library.is_control(i) or library.is_unknown(i)):
                self.ids[piece] = i
                self.scores[piece] = library.get_score(i)
        self.unknown = library.unk_id()
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("the vocabulary joins words, so words cannot be encoded one by one")

    def symbols(self, text: str) -> list[str]:
        """The symbols that are left when no pair can be joined any more."""
        symbols = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        score_of, push, pop = self.scores.get, heapq.heappush, heapq.heappop
        agenda = []
        for i in range(n - 1):
            score = score_of(symbols[i] + symbols[i + 1])
            if score is not None:
                agenda.append((-score, i, i + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = pop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue  # one of the two has been joined with another symbol meanwhile
            joined = symbols[left] = a + b
            symbols[right] = ""
            follower, previous = after[right], before[left]
            after[left] = follower
            if follower >= 0:
                before[follower] = left
                pair = joined + symbols[follower]
                score = score_of(pair)
                if score is not None:
                    push(agenda, (-score, left, follower, len(pair)))
            if previous >= 0:
                pair = symbols[previous] + joined
                score = score_of(pair)
                if score is not None:
                    push(agenda, (-score, previous, left, len(pair)))
        return [s for s in symbols if s]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for symbol in self.symbols(text):
            found = self.ids.get(symbol)
            if found is not None:
                out.append(found)
            elif self.bytes:
                out.extend(self.bytes[b] for b in symbol.encode("utf-8"))
            else:
                out.append(self.unknown)
        return out


class WordCache(dict):
    """Ids of words as packed little-endian numbers; unknown words go through the agenda.

    When the cache is full it becomes the older half; words that are still met move
    back from there, the rest goes with the next change.
    """

    def __init__(self, agenda: Agenda, limit: int):
        super().__init__()
        self.agenda, self.half = agenda, limit // 2
        self.older: dict[str, bytes] = {}
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        packed = self.older.get(word)
        if packed is None:
            packed = np.array(self.agenda.encode(word), dtype="<u4").tobytes()
            self.fresh.append(word)
        self[word] = packed
        return packed


class Encoder:
    """Texts to packed ids and back, for one worker."""

    def __init__(self, model: bytes, cached: int = CACHED):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        agenda = Agenda(self.library)
        self.words = WordCache(agenda, cached)
        if any("\n" in p and len(p) > 1 for p in agenda.ids):
            raise ValueError("the vocabulary joins lines, so lines cannot be encoded one by one")
        self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
        self.begin, self.end = (np.asarray([i], dtype="<u4").tobytes() for i in (self.library.bos_id(), self.library.eos_id()))

    def encode(self, text: str) -> bytes:
        """Ids without begin and end."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        return b"".join(map(self.words.__getitem__, self.cut.findall(marked)))

    def library_ids(self, words: list[str]) -> list[list[int]]:
        """What the library makes of words. One that does not begin with a mark is put
        behind a line break, to which no piece joins it, and the ids up to there are cut off."""
        led = [w.startswith(MARK) and w != MARK for w in words]
        texts = [w[1:].replace(MARK, " ") if lead else "\n" + w for w, lead in zip(words, led)]
        found = self.library.encode(texts, num_threads=1)
        line = self.library.encode("\n")
        mark = line[: line.index(self.library.encode("\n\n")[-1])]  # alone, a mark is no text to the library
        return [mark if w == MARK else ids if lead else ids[len(line):] for w, ids, lead in zip(words, found, led)]

    def check(self) -> set[str]:
        """Compare the words that went through the agenda since the last check with the library.

        Returns those that differ; they keep the library's ids from now on.
        """
        words, self.words.fresh = self.words.fresh, []
        differing = set()
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            for word, ids in zip(part, self.library_ids(part)):
                packed = np.array(ids, dtype="<u4").tobytes()
                if self.words[word] != packed:
                    differing.add(word)
                    self.words[word] = packed
        self.words.fresh = []
        return differing

    def decode(self, packed: bytes) -> str:
        return self.library.decode(np.frombuffer(packed, dtype="<u4").tolist())


def encode_and_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                      cached: int = CACHED) -> DataFrame:
    """Per row the number of ids (begin and end included), a digest of the ids and one of the text decoded from them.

    One row per input row, repeated rows included. A null text counts as empty: its
    ids are begin and end, its decoded text is empty. A null id stays null. An empty
    table gives no rows. Other columns are not read.
    """
    with open(model_path, "rb") as source:
        sent = docs.sparkSession.sparkContext.broadcast(source.read())
    key = f"pieces-{uuid.uuid4().hex}"

    def run(batches):
        encoder = kept_in_worker(key, lambda: Encoder(sent.value, cached))
        for batch in batches:
            for part in pieces_of(batch, 1 << 20):
                texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                coded = [encoder.encode(t) for t in texts]
                differing = encoder.check()
                rows = []
                for text, packed in zip(texts, coded):
                    same = not differing or differing.isdisjoint(encoder.cut.findall(MARK + text.replace(" ", MARK)))
                    packed = packed if same else encoder.encode(text)
                    ids = encoder.begin + packed + encoder.end
                    rows.append((
                        len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                        hashlib.sha256(encoder.decode(packed).encode("utf-8")).hexdigest(), same,
                    ))
                n, ids, back, same = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("doc_id")), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                     pa.array(back, pa.string()), pa.array(same, pa.bool_())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"],
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, ENCODED)
