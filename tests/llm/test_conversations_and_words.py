"""Prefix trie, spelling variants and fingerprint join against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from threadloom.llm import fingerprint_join, prefix_trie, spelling

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


# ---- conversations ----

def chats(seed: int) -> list[tuple]:
    """Shared beginnings, copies, missing bases, ties, repeated rows, nulls and one long conversation."""
    rnd = random.Random(seed)
    rows = []
    for c in [*range(0, 40), *range(101, 104), 1000]:
        for t in range(rnd.randrange(1, 14)):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "é", "", None])))
    opening = [("user", "hello " * 20), ("assistant", "hi"), ("user", None)]
    for c in range(200, 230):
        rows += [(c, t, r, x) for t, (r, x) in enumerate(opening[: rnd.randrange(1, 4)])]
    rows += [(300, t, "user", f"long {t % 3}") for t in range(70)] + [(305, t, "user", f"long {t % 3}") for t in range(60)]
    rows += [(310, t, "user", f"long {t % 3}") for t in range(64)] + [(311, t, "user", f"long {t % 3}") for t in range(50)]
    rows += [(5, None, "user", "first of all"), (6, 3, "user", "tie"), (6, 3, "user", "tie two"), (7, 1, "user", "twice"), (7, 1, "user", "twice")]
    rows += [(None, 1, "user", "no conversation"), (400, 0, "system", "x" * 50000)]
    rnd.shuffle(rows)
    return rows


def plain_trie(rows, heads=9, family=5):
    def digest(r, x):
        return hashlib.md5(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).hexdigest()

    talks = {}
    for c, t, r, x in rows:
        if c is not None:
            talks.setdefault(c, []).append((t is not None, t or 0, digest(r, x), (r or "", x or "")))
    talks = {c: [x[3] for x in sorted(ts, key=lambda x: x[:3])] for c, ts in talks.items()}
    full = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % heads
        full[c] = tuple(talks.get(c - c % family, [])[:h] + own[h:])
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, own in members.items():
        cost = (len(own) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += cost
    out = []
    for k, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(full[c]) == len(k))
        out.append((min(own), len(k), min(members[k[:-1]]) if k else None, len(own), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,length,block,final", [(2, 512, 30, 16), (3, 7, 1 << 18, 4096)])
def test_prefix_trie(spark, monkeypatch, seed, length, block, final):
    monkeypatch.setattr(prefix_trie, "IDS_AT_ONCE", 3)
    rows = chats(seed)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"digest": F.lit(1), "grp": F.lit("clash"), "seg": F.lit(0)})
    got = prefix_trie.prefix_trie(turns, length=length, block_nodes=block, final_rows=final).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_trie(rows)


def test_conversations_as_they_are(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "a"), (3, 0, "u", "c")]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), heads=1).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_trie(rows, heads=1)


def test_a_conversation_over_many_tasks(spark):
    rows = [(5, t // 2, "u", str(t)) for t in range(400)]
    placed = prefix_trie.numbered(prefix_trie.turn_digests(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert sorted(r["place"] for r in placed) == list(range(400))


# ---- spelling ----

def plain_words(rows, least=7, noise=31):
    seen = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 2}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain_variants(words):
    out = []
    near = {w: [o for o in words if one_apart(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def spelled(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(7, 12))) for _ in range(30)] + ["aaaaaaaa", "abababab", "tionalen", "nationen"]
    rows = []
    for i in range(60):
        text = []
        for _ in range(60):
            word = rnd.choice(base)
            if rnd.random() < 0.3:
                at = rnd.randrange(len(word) + 1)
                word = rnd.choice([word[:at] + rnd.choice("abcÉ") + word[at:], word[:at] + word[at + 1 :], word[:at] + "x" + word[at + 1 :]])
            text.append(word.upper() if rnd.random() < 0.1 else word)
        rows.append((i, rnd.choice([" ", ",", " Ж", "1"]).join(text)))
    common = "repeatedly"
    rows += [(100 + i, " ".join([common] * 20 + [common[:-1]] * (2 if i == 0 else 0))) for i in range(8)]
    rows += [(200, "Repeatedl repeatedl"), (201, None), (202, ""), (None, "noidword noidword noidwore"), (203, "z" * 30000), (203, "z" * 30000), (1, rows[1][1])]
    return rows


@pytest.mark.parametrize("seed,block,least", [(1, 4096, 16), (2, 2, 1)])
def test_spelling_variants(spark, monkeypatch, seed, block, least):
    monkeypatch.setattr(spelling, "LEAST_FREQUENT", least)
    monkeypatch.setattr(spelling, "COUNTED", 50)
    rows = spelled(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("clash"), "n": F.lit(0)})
    got = spelling.variants(spelling.word_counts(docs, noise=31), block=block).collect()
    want = plain_variants(plain_words(rows))
    assert any(r[1] for r in want) and any(r[2] != (r[1] or r[0]) for r in want) or seed
    assert sorted((tuple(r) for r in got), key=str) == want


def test_an_edit_leaves_one_of_the_merged_lists():
    rnd = random.Random(9)
    words = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(7, 13))) for _ in range(300)]
    frequent = Counter()
    for w in words:
        padded = f"^{w}$"
        for a in range(len(padded) - 1):
            frequent.update({padded[a : a + n] for n in (2, 3, 4) if n > 2 or padded[a : a + n].endswith("$")})
    frequent = {g: n for g, n in frequent.items() if n > 3}
    lists = spelling.Lists(10**9)
    for w in words:
        grams = spelling.decompose(w, frequent, 3)
        pair = spelling.lists_to_merge(grams)
        assert spelling.affected(list(pair)) == 1 and spelling.affected(grams) >= 1
        merged = set(lists.merged(w, grams))
        for at in range(len(w) + 1):
            for other in (w[:at] + "c" + w[at:], w[:at] + "c" + w[at + 1 :]):
                if len(other) >= len(w) and other != w:
                    assert merged & set(lists.holding(other, spelling.decompose(other, frequent, 3)))


# ---- fingerprints ----

def plain_fingerprint(text):
    words = [w for w in SPACE.findall((text or "").translate(LOWER))]
    shingles = [" ".join(words)] if 0 < len(words) < 4 else [" ".join(words[i : i + 4]) for i in range(len(words) - 3)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, most=4):
    prints = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= most:
                label[root(a)] = root(b)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, f"{prints[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


def papers(seed):
    rnd = random.Random(seed)
    words = [f"Wort{i}" for i in range(200)] + ["É", "é"]
    base = [rnd.choice(words) for _ in range(300)]
    rows = [(100 + i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 60)))) for i in range(40)]
    for i in range(40):
        near = list(base)
        for _ in range(rnd.randrange(3)):
            near[rnd.randrange(len(near))] = rnd.choice(words)
        rows.append((i, "\t".join(near)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "a b c"), (504, "A b  C"), (505, "same " * 30000), (None, "a b c"), (None, " ".join(base)), (506, "x" * 200000), (1, rows[50][1])]
    return rows


@pytest.mark.parametrize("seed,rounds,few,parts", [(1, 3, 64, None), (2, 3, 0, 5)])
def test_fingerprint_groups(spark, monkeypatch, seed, rounds, few, parts):
    monkeypatch.setattr(fingerprint_join, "FEW", few)
    monkeypatch.setattr(fingerprint_join, "BLOCK", 3)
    monkeypatch.setattr(fingerprint_join, "SHARE", 20)
    rows = papers(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"bits": F.lit("clash"), "component": F.lit(1)})
    got = fingerprint_join.fingerprint_groups(docs, rounds=rounds, parts=parts).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_groups(rows)


def test_all_links_within_the_radius(spark):
    rnd = random.Random(4)
    prints = {rnd.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for _ in range(6):
            for b in rnd.sample(range(64), rnd.randrange(1, 7)):
                p ^= 1 << b
            prints.add(p)
    rows = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    for parts in (5, 7):
        links = fingerprint_join.fingerprint_links(spark.createDataFrame(rows, "bits long"), parts=parts, rounds=1).collect()
        assert all(bin((r["a"] ^ r["b"]) & (2**64 - 1)).count("1") <= 4 for r in links)
        label = {r[0]: r[0] for r in rows}

        def root(i):
            while label[i] != i:
                i = label[i]
            return i

        for r in links:
            label[root(r["a"])] = root(r["b"])
        for a, in rows:
            for b, in rows:
                if bin((a ^ b) & (2**64 - 1)).count("1") <= 4:
                    assert root(a) == root(b)


def test_parts_grow_with_the_rows():
    assert [fingerprint_join.parts_for(n) for n in (0, 10**6, 10**8, 10**11)] == sorted(fingerprint_join.parts_for(n) for n in (0, 10**6, 10**8, 10**11))
    assert fingerprint_join.parts_for(0) == 6 and fingerprint_join.parts_for(10**11) > 6


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprint_join.fingerprint_groups(docs).count() == 0
    assert spelling.variants(spelling.word_counts(docs)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
