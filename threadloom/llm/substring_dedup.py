"""Removal of passages that an earlier document already holds.

A window is a fixed number of neighbouring words. A word goes if it lies in a window
whose words also start in a document with a smaller id.

1. Candidates. Of the short runs inside a window the one with the least hash is its
   anchor; equal windows have equal anchors. Anchors are counted over all documents,
   one row per document and anchor, combined before the shuffle.
2. Windows whose anchor occurs in two documents or more are cut out as segments
   (neighbouring windows of one anchor together) and dealt by anchor. An anchor that
   very many documents hold would gather too much, so its windows are dealt one by
   one, by their own hash. Equal segments are reduced to one row per task before.
3. Each shard of segments confirms by the words themselves which windows recur and
   where first, compiles them into an Aho-Corasick automaton over one-letter word
   codes, and streams the segments of all documents through it. Every hit is
   compared word by word, as codes may collide.
4. Hits go back to the documents as word ranges, and the rest of the words is kept.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass
from itertools import chain, groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.fingerprints import WordHashes, runs
from threadloom.llm.shared import id_and_text, kept_in_worker, pieces_of, raw_texts
from threadloom.session import materialize

WINDOW = 13
ANCHOR = 4
#: An anchor of more documents than this is dealt by windows.
HOT = 1000
#: Segments that share an automaton, at least; a shard ends where an anchor ends.
SHARD = 20_000
#: Recurring anchors up to this many (8 bytes each) are broadcast; more are joined to the documents.
BROADCAST_ANCHORS = 4_000_000
#: Documents with ranges to remove (a few numbers each) up to which these are broadcast; more are joined by a shuffle.
BROADCAST_RANGES = 500_000
#: Segments that a task holds to reduce copies before it hands them on.
HELD = 100_000
#: Segments that are cut between two looks at what is held, however long a text is.
STEP = 1 << 15


def anchored(texts: list[bytes | None], hashes: WordHashes, window: int, anchor: int):
    """Words and runs of windows with one anchor, for many texts together.

    Returns all words, the place of each text's first word, and per run of windows:
    text, first window, number of windows, anchor. Also the hashes of the words.
    """
    cut = [t.split() if t else [] for t in texts]
    sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
    first = np.concatenate(([0], np.cumsum(sizes)))
    words = list(chain.from_iterable(cut))
    h = hashes.of(words)
    empty = np.empty(0, dtype=np.int64)
    if len(h) < window:
        return words, first, empty, empty, empty, np.empty(0, dtype=np.uint64), h
    short = runs(h, anchor)
    where = least_places(short, window - anchor + 1)
    text_of = np.repeat(np.arange(len(cut)), sizes)
    inside = text_of[: len(where)] == text_of[window - 1 :]
    starts = np.empty(len(where), dtype=bool)
    starts[0] = True
    starts[1:] = (where[1:] != where[:-1]) | ~inside[:-1]
    starts &= inside
    at = np.flatnonzero(starts)
    stop = np.append(np.flatnonzero(starts | ~inside), len(where))
    after = stop[np.searchsorted(stop, at, side="right")]
    return words, first, text_of[at], at, after - at, short[where[at]], h


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least value, the first of equal ones, among ``width`` neighbours from each place on.

    Windows are put together from two shorter ones that overlap or touch.
    """
    places, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = values[:-step], values[step:]
        places = np.where(left <= right, places[:-step], places[step:])
        values = np.minimum(left, right)
        size += step
    return places


def anchor_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """One row (anchor, doc_id) per document and distinct anchor."""

    def run(batches):
        hashes = kept_in_worker("words", WordHashes)
        for batch in batches:
            for part in pieces_of(batch):
                ids = part.column(part.schema.get_field_index("doc_id")).to_numpy(zero_copy_only=False)
                _, _, text, _, _, anchors, _ = anchored(raw_texts(part), hashes, window, anchor)
                if len(anchors):
                    order = np.lexsort((anchors, text))
                    anchors, text = anchors[order], text[order]
                    new = np.append(True, (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchors[new].view(np.int64)), pa.array(ids[text[new]].astype(np.int64))], ["anchor", "doc_id"]
                    )

    return docs.mapInArrow(run, "anchor long, doc_id long")


def recurring_anchors(anchors: DataFrame, hot: int) -> DataFrame:
    """Anchors of two documents or more, and whether they have more than ``hot``."""
    counted = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return materialize(counted.select("anchor", (F.col("n") > hot).alias("hot")), "anchors")


def sorted_anchors(recurring: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The anchors in order, with their hot flags, packed by the tasks: 9 bytes each."""

    def pack(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flags = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays([pa.array([keys.tobytes()], pa.binary()), pa.array([flags.tobytes()], pa.binary())], ["keys", "flags"])

    rows = recurring.select("anchor", "hot").mapInArrow(pack, "keys binary, flags binary").collect()
    keys = np.frombuffer(b"".join(bytes(r["keys"]) for r in rows), dtype=np.uint64)
    flags = np.frombuffer(b"".join(bytes(r["flags"]) for r in rows), dtype=bool)
    order = np.argsort(keys)
    return keys[order], flags[order]


OUT = "key long, seg_id long, doc_id long, text_id long, start int, last long, segment binary"
NAMES = ["key", "seg_id", "doc_id", "text_id", "start", "last", "segment"]


def cut_segments(docs: DataFrame, window: int, anchor: int, known=None) -> DataFrame:
    """Segments of windows with recurring anchors.

    Rows without ``segment`` are occurrences: the segment's name (key, seg_id), the
    document, a hash of its text and the first word. Rows with ``segment`` are the
    words, with the smallest and the largest document (doc_id, last) that the task
    has seen. ``known`` gives the sorted recurring anchors and their hot flags; without it
    each row of ``docs`` brings its own in the columns ``anchors`` and ``hot``.
    """

    def distinct(held: dict) -> pa.RecordBatch:
        n = len(held)
        low, high, keys, names = (pa.array(c, pa.int64()) for c in zip(*held.values()))
        return pa.RecordBatch.from_arrays(
            [keys, names, low, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), high, pa.array(list(held), pa.binary())], NAMES
        )

    def run(batches):
        hashes = kept_in_worker("words", WordHashes)
        held: dict[bytes, list] = {}
        for batch in batches:
            for part in pieces_of(batch):
                ids = part.column(part.schema.get_field_index("doc_id")).to_numpy(zero_copy_only=False).astype(np.int64)
                text_ids = part.column(part.schema.get_field_index("text_id")).to_numpy(zero_copy_only=False).astype(np.int64)
                words, first, text, at, count, anchors, h = anchored(raw_texts(part), hashes, window, anchor)
                if known is not None:
                    table, flags = known.value
                    place = np.minimum(np.searchsorted(table, anchors), max(len(table) - 1, 0))
                    found = table[place] == anchors if len(table) else np.zeros(len(anchors), dtype=bool)
                    hot = found & flags[place] if len(table) else found
                else:
                    found, hot = given(part, anchors, text)
                if not found.any():
                    continue
                # runs of hot anchors fall apart into their windows, each dealt by its own hash
                plain, split = np.flatnonzero(found & ~hot), np.flatnonzero(hot)
                windows = np.repeat(at[split], count[split]) + places_within(count[split])
                keys = np.concatenate((anchors[plain].view(np.int64), runs(h, window)[windows].view(np.int64)))
                begin = np.concatenate((at[plain], windows))
                size = np.concatenate((count[plain] + (window - 1), np.full(len(windows), window, dtype=np.int64)))
                owner = np.concatenate((text[plain], np.repeat(text[split], count[split])))
                for low in range(0, len(begin), STEP):
                    now = slice(low, low + STEP)
                    n = len(begin[now])
                    names = np.empty(n, dtype=np.int64)
                    spans = zip(begin[now].tolist(), (begin[now] + size[now]).tolist(), keys[now].tolist(), ids[owner[now]].tolist())
                    for i, (start, stop, key, doc) in enumerate(spans):
                        segment = b" ".join(words[start:stop])
                        seen = held.get(segment)
                        if seen is None:
                            seen = held[segment] = [doc, doc, key, xxhash.xxh3_64_intdigest(segment, 1) - (1 << 63)]
                        elif doc < seen[0]:
                            seen[0] = doc
                        elif doc > seen[1]:
                            seen[1] = doc
                        names[i] = seen[3]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[now]), pa.array(names), pa.array(ids[owner[now]]), pa.array(text_ids[owner[now]]),
                         pa.array((begin[now] - first[owner[now]]).astype(np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], NAMES
                    )
                    if len(held) >= HELD:
                        yield distinct(held)
                        held = {}
        if held:
            yield distinct(held)

    return docs.mapInArrow(run, OUT)


def places_within(counts: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def given(part: pa.RecordBatch, anchors: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which anchors are among those that their document brings along, and which of them are hot."""
    found, hot = np.zeros(len(anchors), dtype=bool), np.zeros(len(anchors), dtype=bool)
    own = part.column(part.schema.get_field_index("anchors")).to_pylist()
    flags = part.column(part.schema.get_field_index("hot")).to_pylist()
    edges = np.searchsorted(text, np.arange(len(own) + 1))
    for t, (names, hots) in enumerate(zip(own, flags)):
        if names:
            table = dict(zip(names, hots))
            for i in range(edges[t], edges[t + 1]):
                flag = table.get(int(anchors[i].view(np.int64)))
                if flag is not None:
                    found[i], hot[i] = True, flag
    return found, hot


class PassageAutomaton:
    """Finds recurring passages in texts whose words are coded as one letter each."""

    def __init__(self):
        self.letters: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton()

    def code(self, words: list[bytes]) -> str:
        letters = self.letters
        for w in words:
            if w not in letters:
                letters[w] = zlib.crc32(w) & 255
        return bytes(map(letters.__getitem__, words)).decode("latin-1")

    def add(self, code: str, passage: bytes, first: int) -> None:
        """A passage and the first document that holds it; each passage is added once."""
        known = self.automaton.get(code, None)
        if known is None:
            self.automaton.add_word(code, [(passage, len(code), first)])
        else:
            known.append((passage, len(code), first))

    def compile(self) -> None:
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, code: str, segment: bytes, words: list[bytes]):
        """(first word, words, first document) of every occurrence in a segment."""
        for end, candidates in self.automaton.iter(code):
            for passage, size, first in candidates:
                if segment == passage if size == len(code) else b" ".join(words[end + 1 - size : end + 1]) == passage:
                    yield end + 1 - size, size, first


@dataclass(slots=True)
class Segment:
    """A distinct segment of a shard, with the first and last document that hold it."""

    name: tuple[int, int]
    text: bytes
    words: list[bytes]
    code: str
    low: int
    high: int


def confirm(segments: list[Segment], window: int):
    """Recurring passages among the segments of one key: (code, passage, first document).

    A single segment recurs as a whole or not at all. Several are compared by their
    windows: equal windows may lie in different segments.
    """
    if len(segments) == 1:
        only = segments[0]
        if only.low < only.high:
            yield only.code, only.text, only.low
        return
    seen: dict[bytes, list] = {}
    for s in segments:
        for i in range(len(s.words) - window + 1):
            passage = b" ".join(s.words[i : i + window])
            known = seen.get(passage)
            if known is None:
                seen[passage] = [s.low, s.high, s.code[i : i + window]]
            else:
                known[0], known[1] = min(s.low, known[0]), max(s.high, known[1])
    for passage, (low, high, code) in seen.items():
        if low < high:
            yield code, passage, low


def shard_cover(groups: list[list[tuple]], window: int) -> list[tuple]:
    """Per segment of a shard the windows that recur: (key, seg_id, starts, firsts).

    ``groups`` holds the rows of one key each. Only windows are named that some
    document of the segment has to give up.
    """
    automaton = PassageAutomaton()
    streamed: list[Segment] = []
    for rows in groups:
        merged: dict[tuple[int, int], Segment] = {}
        lone = len(rows) == 1 and rows[0][2] == rows[0][3]  # one segment of one document: nothing recurs
        for key, seg_id, low, high, text in () if lone else rows:
            known = merged.get((key, seg_id))
            if known is None:
                words = text.split(b" ")
                merged[key, seg_id] = Segment((key, seg_id), text, words, automaton.code(words), low, high)
            else:
                known.low, known.high = min(low, known.low), max(high, known.high)
        segments = list(merged.values())
        passages = list(confirm(segments, window))
        for code, passage, low in passages:
            automaton.add(code, passage, low)
        if passages:
            streamed.extend(segments)
    automaton.compile()
    out = []
    for s in streamed:
        firsts: dict[int, int] = {}
        for start, size, first in automaton.hits(s.code, s.text, s.words):
            if first < s.high:
                for i in range(start, start + size - window + 1):
                    firsts[i] = min(first, firsts.get(i, first))
        if firsts:
            out.append((*s.name, list(firsts), list(firsts.values())))
    return out


def locate(segments: DataFrame, window: int) -> DataFrame:
    """Recurring windows of all segments, shard by shard.

    Rows arrive dealt and sorted by key; a task reads them in order and starts a new
    automaton after ``SHARD`` segments, so it holds one shard at a time.
    """
    schema = "key long, seg_id long, starts array<int>, firsts array<long>"

    def rows_of(batches):
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(5)))

    def out(found: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*found), types)], ["key", "seg_id", "starts", "firsts"]
        )

    def run(batches):
        shard: list[list[tuple]] = []
        held = 0
        for _, group in groupby(rows_of(batches), key=lambda r: r[0]):
            shard.append(list(group))
            held += len(shard[-1])
            if held >= SHARD:
                if found := shard_cover(shard, window):
                    yield out(found)
                shard, held = [], 0
        if shard and (found := shard_cover(shard, window)):
            yield out(found)

    dealt = segments.select("key", "seg_id", "doc_id", "last", "segment").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, schema)


def removed_ranges(docs: DataFrame, window: int, anchor: int, hot: int, broadcast_anchors: int) -> DataFrame:
    """Ranges of words to remove, per document that has any: doc_id, text_id, from, upto."""
    named = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    anchors = anchor_rows(named.select("doc_id", "text"), window, anchor)
    recurring = recurring_anchors(anchors, hot)
    if recurring.limit(broadcast_anchors + 1).count() <= broadcast_anchors:
        known = docs.sparkSession.sparkContext.broadcast(sorted_anchors(recurring))
        cut = cut_segments(named, window, anchor, known)
    else:
        per_doc = anchors.join(recurring, "anchor").groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "hot")).alias("own"))
        joined = named.join(per_doc, "doc_id").select("doc_id", "text", "text_id", F.col("own.anchor").alias("anchors"), F.col("own.hot").alias("hot"))
        cut = cut_segments(joined, window, anchor)
    pieces = materialize(cut, "segments")
    found = locate(pieces.where(F.col("segment").isNotNull()), window)
    places = pieces.where(F.col("segment").isNull()).select("key", "seg_id", "doc_id", "text_id", "start")
    hits = places.join(found, ["key", "seg_id"]).select(
        "doc_id", "text_id",
        F.transform(
            F.filter(F.arrays_zip("starts", "firsts"), lambda z: z["firsts"] < F.col("doc_id")),
            lambda z: z["starts"] + F.col("start"),
        ).alias("starts"),
    )
    per_doc = hits.where(F.size("starts") > 0).groupBy("doc_id", "text_id").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    return merged_ranges(per_doc, window)


def merged_ranges(per_doc: DataFrame, window: int) -> DataFrame:
    """The windows at ``starts`` as ranges of words that do not touch: doc_id, text_id, from, upto."""

    def run(batches):
        for batch in batches:
            begin, end = [], []
            for starts in batch.column(2):
                at = np.unique(starts.values.to_numpy())
                gaps = np.flatnonzero(np.diff(at) > window)
                begin.append(at[np.append(0, gaps + 1)])
                end.append(at[np.append(gaps, len(at) - 1)] + window)
            if begin:
                kind = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(begin, kind), pa.array(end, kind)], ["doc_id", "text_id", "from", "upto"]
                )

    return per_doc.select("doc_id", "text_id", "starts").mapInArrow(run, "doc_id long, text_id long, from array<int>, upto array<int>")


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT,
                   broadcast_anchors: int = BROADCAST_ANCHORS, broadcast_ranges: int = BROADCAST_RANGES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_words, n_removed, kept_sha256 and ``kept_text``.

    ``kept_text`` is the text itself where nothing is removed (null stays null), else
    the kept words joined by one blank; ``kept_sha256`` is always over the joined
    words. Null, empty and wordless texts have no words. Rows without an id remove
    nothing and lose nothing. Rows of one id never remove from each other, however
    often a row is repeated. Empty tables give no rows. Columns in ``keep`` are
    carried through; others are not read.
    """
    carried = [c for c in keep if c not in ("doc_id", "text")]
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carried)
    picked = picked.withColumn("text_id", F.xxhash64("text"))
    ranges = removed_ranges(picked.select("doc_id", "text", "text_id"), window, anchor, hot, broadcast_anchors)
    ranges = materialize(ranges, "ranges")
    few = ranges.limit(broadcast_ranges + 1).count() <= broadcast_ranges
    joined = picked.join(F.broadcast(ranges) if few else ranges, ["doc_id", "text_id"], "left").drop("text_id")
    schema = joined.drop("from", "upto").schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string").add("kept_text", "string")
    names = schema.names

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch):
                begin, end = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("from", "upto"))
                counts, gone, digests, texts = [], [], [], []
                for text, off, on in zip(raw_texts(part), begin, end):
                    words = kept = text.split() if text else []
                    if off:
                        kept = list(chain.from_iterable(words[a:b] for a, b in zip([0, *on], [*off, len(words)])))
                    joined_words = b" ".join(kept)
                    counts.append(len(words))
                    gone.append(len(words) - len(kept))
                    digests.append(hashlib.sha256(joined_words).hexdigest())
                    texts.append(joined_words if off else text)
                own = [part.column(i) for i, name in enumerate(part.schema.names) if name not in ("from", "upto")]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string()),
                     pa.array(texts, pa.binary()).cast(pa.string())],
                    names,
                )

    return joined.mapInArrow(run, schema)


def digest_of_kept(docs: DataFrame) -> DataFrame:
    """The documents with what is left of them as counts and a digest."""
    return remove_repeats(id_and_text(docs)).select("doc_id", "n_words", "n_removed", "kept_sha256")
