"""N-gram join and substring dedup against plain versions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from threadloom.llm import graph, ngram_join, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed: int) -> list[tuple]:
    """Copies, near copies, shared passages, repeated words, ties and empty texts."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(120)]
    passage = " ".join(rnd.choice(words) for _ in range(30))
    rows = []
    for i in range(12):
        near = list(base)
        for _ in range(rnd.randrange(4)):
            near[rnd.randrange(len(near))] = rnd.choice(words)
        rows.append((len(rows), " ".join(near)))
    for i in range(8):
        own = [rnd.choice(words) for _ in range(rnd.randrange(5, 40))]
        rows.append((len(rows), " ".join(own[: i + 2]) + "\n" + passage + "\t" + " ".join(own[i + 2 :])))
    rows += [(30, "same " * 60), (31, "Same " * 40), (32, None), (33, ""), (34, " \n"), (35, "a b c"), (36, "A b  C"), (37, "a b"),
             (38, "é" * 30000), (1, rows[1][1]), (None, passage), (None, None), (39, " ".join(base[:13])), (40, " ".join(base[1:13])),
             (20, "an id twice " + passage), (20, "an id twice, other text " + passage)]
    rnd.shuffle(rows)
    return rows


def shingles(text):
    words = tuple(WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)})))
    return frozenset([words]) if 0 < len(words) < 5 else frozenset(words[i : i + 5] for i in range(len(words) - 4))


def plain_components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def plain_removal(rows, window=13):
    starts = {}
    cut = [WORD.findall(t or "") for _, t in rows]
    for (doc, _), words in zip(rows, cut):
        for i in range(len(words) - window + 1):
            if doc is not None:
                key = tuple(words[i : i + window])
                starts[key] = min(doc, starts.get(key, doc))
    out = []
    for (doc, _), words in zip(rows, cut):
        gone = {
            i + k for i in range(len(words) - window + 1) for k in range(window)
            if doc is not None and starts[tuple(words[i : i + window])] < doc
        }
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,rounds,few", [(1, 3, 256), (2, 3, 0), (3, 1, 0)])
def test_near_duplicates(spark, monkeypatch, seed, rounds, few):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("clash"), "sig": F.lit(1), "component_id": F.lit(0)})
    got = ngram_join.near_duplicates(docs, rounds=rounds, bits=16).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_components(rows)


def test_parity_bounds_the_overlap():
    rnd = random.Random(5)
    for _ in range(50):
        x = ngram_join.np.unique(ngram_join.np.array([rnd.getrandbits(64) for _ in range(rnd.randrange(1, 300))], dtype="u8"))
        y = ngram_join.np.unique(ngram_join.np.concatenate((x[: rnd.randrange(len(x) + 1)], ngram_join.np.array([rnd.getrandbits(64) for _ in range(20)], dtype="u8"))))
        differing = sum(bin((int(a) ^ int(b)) & (2**64 - 1)).count("1") for a, b in zip(ngram_join.parity(x), ngram_join.parity(y)))
        assert differing <= len(set(x.tolist()) ^ set(y.tolist()))


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 100 for i in range(100, 140)}}


@pytest.mark.parametrize("hot,broadcast", [(1000, 10**6), (1, 10**6), (1000, 0), (1, 0)])
def test_repeats_are_removed(spark, hot, broadcast):
    rows = corpus(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"text_id": F.lit("clash"), "from": F.lit(1), "n_words": F.lit(0)})
    got = substring_dedup.remove_repeats(docs.repartition(4), hot=hot, broadcast_anchors=broadcast, broadcast_ranges=broadcast)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str) == plain_removal(rows)
    whole = {r["doc_id"]: r["kept_text"] for r in got.where("n_removed = 0 and doc_id is not null").collect()}
    assert all(text == dict((i, t) for i, t in rows)[doc] for doc, text in whole.items())


def test_colliding_codes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup.zlib, "crc32", lambda w: 0)
    passages = [(f"p{i} " * 13).split() for i in range(3)]
    groups = [[(1, i, 1, 2, " ".join(p).encode())] for i, p in enumerate(passages)]
    assert [r[2:] for r in substring_dedup.shard_cover(groups, 13)] == [([0], [1])] * 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.near_duplicates(none, bits=16).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
