"""Periodic runs, exact top-k and the prefix trie against brute force, and odd input."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from regispark.llm import periodic, queries, topk, trie

CHATS = "conv_id bigint, turn bigint, role string, text string"


def plain_runs(words):
    """Every maximal stretch of each period, by comparing words one by one."""
    found = {}
    for q in range(1, len(words) // periodic.TIMES + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(periodic.LEAST, periodic.TIMES * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e, q) for (s, e), q in found.items())


def plain_digest(key, text):
    words = (text or "").encode().split()
    if key is not None:
        h = zlib.crc32(str(key).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = (None,) * 4
    if runs:
        s, e, q = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]))
        best = (s, e - s, q, 1000 * (e - s) // q)
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (key, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("seed", range(4))
def test_extensions_of_a_grammar(seed):
    draw = random.Random(seed)
    for _ in range(20):
        size = draw.randrange(2, 400)
        few = draw.choice([1, 2, 3, 30])
        x = np.array([draw.randrange(few) for _ in range(size)] + [99])
        a, b = (np.array([draw.randrange(len(x)) for _ in range(200)]) for _ in range(2))
        a, b = a[a != b], b[a != b]

        def plain(i, j):
            n = 0
            while max(i, j) + n < len(x) and x[i + n] == x[j + n]:
                n += 1
            return n

        got = periodic.Grammar(x).extensions(a, b).tolist()
        assert got == [plain(i, j) for i, j in zip(a.tolist(), b.tolist())]


def periodic_texts(draw, count):
    for _ in range(count):
        few = draw.choice([1, 2, 3, 5, 50])
        words = [f"w{draw.randrange(few)}" for _ in range(draw.randrange(0, 120))]
        if words and draw.random() < 0.6:
            a, p = draw.randrange(len(words)), draw.randrange(1, 12)
            words = [words[i] if i < a else words[min(len(words) - 1, a + (i - a) % p)] for i in range(len(words))]
            words[draw.randrange(len(words))] = "x"
        yield words * draw.randrange(1, 4)


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_words(seed):
    draw = random.Random(seed)
    texts = [[w.encode() for w in words] for words in periodic_texts(draw, 60)]
    got = {key: runs for key, _, runs in periodic.told(list(range(len(texts))), texts)}
    assert got == {k: plain_runs(words) for k, words in enumerate(texts)}


def test_a_long_text_of_one_word_and_one_of_two_nested_periods():
    ((_, _, found),) = periodic.told([1], [[b"a"] * 30_000])
    assert found == [(0, 30_000, 1)]
    words = ([b"a"] * 7 + [b"b"]) * 500
    ((_, _, found),) = periodic.told([1], [words])
    assert found == sorted([(0, 4000, 8)] + [(k, k + 7, 1) for k in range(0, 4000, 8)])


def test_run_digests_of_odd_rows(spark):
    draw = random.Random(9)
    rows = [(k, " ".join(w)) for k, w in enumerate(periodic_texts(draw, 250))]
    rows += [(900, None), (901, ""), (902, " \t\n"), (None, "a b " * 9), (None, None), (7, rows[7][1]), (7, "z " * 9)]
    rows += [(903, "a\xa0a a a " * 6), (904, "é\x1cé " * 8), (905, "word " * 5000), (906, " ".join(map(str, range(9000))))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in ("id", "n_runs", "_words", "start", "runs_sha256"):
        docs = docs.withColumn(name, F.lit("x"))
    got = periodic.run_digests(queries.with_repeats(docs)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((plain_digest(*r) for r in rows), key=repr)
    whole = {r["id"]: r for r in periodic.periodic_runs(docs.where("doc_id >= 900")).collect()}
    assert whole[905]["starts"] == [0] and whole[905]["lengths"] == [5000] and whole[905]["collapsed"] == b"word"
    assert whole[900]["n_words"] == 0 and whole[900]["collapsed"] == b""
    assert periodic.run_digests(queries.with_repeats(docs.limit(0))).collect() == []


def plain_top(rows, k):
    out = []
    sound = [r for r in rows if r[1] is not None]
    for at, (key, own, asked) in enumerate(sound):
        if asked:
            scores = [
                (-sum(x * y for x, y in zip(own, other)), other_key is None, other_key or 0, other_key)
                for b, (other_key, other, _) in enumerate(sound)
                if b != at
            ]
            out += [(key, rank + 1, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_top_k_against_all_scores(spark, monkeypatch, lists):
    monkeypatch.setattr(topk, "QUERIES", 9)
    draw = random.Random(lists)
    near = [[draw.randrange(-9, 10) for _ in range(7)] for _ in range(4)]
    rows = []
    for key in range(150):
        values = [x + draw.randrange(-3, 4) for x in draw.choice(near)][: draw.choice([7, 7, 7, 5, 0])]
        rows.append((key, values, key % 10 == 0))
    rows += [(150, None, True), (None, [9] * 7, False), (None, [9] * 7, False), (10, [8] * 7, True), (3, rows[3][1], None)]
    rows += [(200 + k, [1] * 7, False) for k in range(40)]  # ties
    frame = spark.createDataFrame(rows, "id bigint, values array<bigint>, asked boolean").withColumn("score", F.lit("x"))
    got = topk.exact_top_k(frame.repartition(4), 10, lists).collect()
    assert sorted(map(tuple, got), key=repr) == plain_top(rows, 10)


def test_top_k_of_few_rows_and_of_none(spark):
    schema = "id bigint, values array<bigint>, asked boolean"
    few = [(0, [1, 2], True), (1, [3, -4], False), (2, [-(1 << 30), 1 << 30], True)]
    got = topk.exact_top_k(spark.createDataFrame(few, schema)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_top(few, 10)
    assert topk.exact_top_k(spark.createDataFrame([], schema)).collect() == []
    assert topk.exact_top_k(spark.createDataFrame([(1, [1], False)], schema)).collect() == []
    assert topk.exact_top_k(spark.createDataFrame([(1, [1], True)], schema)).collect() == []
    big = [(0, [1 << 40], True), (1, [1 << 40], False)]
    with pytest.raises(Exception, match="64 bits"):
        topk.exact_top_k(spark.createDataFrame(big, schema)).collect()


def test_whole_vectors(spark):
    rows = [([0.5, -0.0001, 1 / 3],), ([1.0, None],), ([math.nan],), ([math.inf],), (None,), ([],)]
    vectors = spark.createDataFrame(rows, "v array<float>").select(topk.whole_vectors(F.col("v")).alias("w"))
    assert [r["w"] for r in vectors.collect()] == [[512, -1, 341], None, None, None, None, []]


def plain_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", digest, text or ""))
    own = {c: [(r[2], r[4]) for r in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    nodes, kids = {}, {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    for path in nodes:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path, members in nodes.items():
        mine = (len(members) - 1) * len(path[-1][1].encode().split()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += mine
            leaves[path[:d]] += path not in kids
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(made[c]) == len(path))
        above = min(nodes[path[:-1]]) if path else None
        sums = (len(members), len(kids.get(path, [])), leaves[path], saved[path])
        out.append((min(members), len(path), above, *sums, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def chats(draw, count):
    """Conversations with shared openings, a frequent whole, null turns, roles and texts, repeated turns."""
    rows = []
    for c in range(count):
        if draw.random() < 0.1:
            continue
        size = draw.choice([1, 1, 2, 3, 3, 4, 6, 9])
        texts = ["hot a", "hot b c", "x y z"][:size] if draw.random() < 0.4 else [
            draw.choice(["a", "b b", "", "c d e", None]) for _ in range(size)
        ]
        for i, text in enumerate(texts):
            turn = None if i == 0 and draw.random() < 0.2 else i // 2 if c % 7 == 0 else i
            rows.append((c, turn, draw.choice(["user", None]) if c % 3 else "user", text))
    return rows


@pytest.mark.parametrize("parts", [1, 4, 23])
def test_trie_against_prefixes(spark, parts):
    rows = [*chats(random.Random(parts), 300), (None, 1, "user", "x"), (None, None, None, None)]
    rows += [(1000 + 20 * k, t, "user", "copy") for k in range(3) for t in range(150)]  # long, and copied
    frame = spark.createDataFrame(rows, CHATS).withColumn("depth", F.lit("x")).withColumn("ids", F.lit("x"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = trie.prefix_trie(trie.shared_openings(trie.conversations(frame))).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted(map(tuple, got), key=repr) == plain_trie(rows)


def test_trie_of_nothing_of_one_and_of_conversations_without_turns(spark):
    def told(rows):
        return sorted(map(tuple, trie.prefix_trie(trie.conversations(spark.createDataFrame(rows, CHATS))).collect()), key=repr)

    assert told([]) == [] and told([(None, 1, "user", "a")]) == []
    assert [r[:7] for r in told([(5, None, None, None)])] == [(5, 0, None, 1, 1, 1, 0), (5, 1, 5, 1, 0, 1, 0)]
    bare = trie.conversations(spark.createDataFrame([(5, 1, "a", "b"), (6, 1, "a", "b")], CHATS))
    bare = bare.withColumn("turns", F.slice("turns", 1, 0))
    (root,) = trie.prefix_trie(bare).collect()
    assert tuple(root) == (5, 0, None, 2, 0, 1, 0, hashlib.sha256(b"5,6").hexdigest())


def test_searches_on_a_sparse_table():
    draw = random.Random(2)
    values = np.array([draw.randrange(6) for _ in range(60)])
    table = trie.Sparse(values)
    at, depth = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(7)))
    right, left = table.right(at, depth), table.left(at, depth)
    for a, d, r, low in zip(at, depth, right, left):
        assert r == next((k for k in range(a, 59) if values[k + 1] < d), 59)
        assert low == next((k for k in range(a, 0, -1) if values[k] < d), 0)
    low, high = np.minimum(at, at[::-1]), np.maximum(at, at[::-1])
    assert table.least(low, high).tolist() == [values[a : b + 1].min() for a, b in zip(low, high)]
