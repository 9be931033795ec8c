"""Trees over many alike points give their pairs in bounded pieces; pairs that cannot count are not looked at."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from regispark.llm import ngram_join


def test_a_search_holds_few_pairs_at_a_time(monkeypatch):
    monkeypatch.setattr(ngram_join, "ASKED", 4000, raising=False)
    points, sizes = np.ones((400, 16), np.uint8), np.full(400, 16)
    tree = ngram_join.CountTree(points, sizes)
    parts = list(tree.searched(points, sizes, 80))
    assert max(len(q) for q, _ in parts) <= 4000
    pairs = {(a, b) for q, t in parts for a, b in zip(q.tolist(), t.tolist())}
    assert len(pairs) == 400 * 400
    q, t = tree.search(points, sizes, 80)
    assert set(zip(q.tolist(), t.tolist())) == pairs


def test_documents_that_meet_heavy_ones_only_are_not_compared_with_each_other(monkeypatch):
    asked, plain = [], ngram_join.bounds
    monkeypatch.setattr(ngram_join, "bounds", lambda points, a, boxes, b: asked.append(len(a)) or plain(points, a, boxes, b))
    docs = 2000
    stored = ngram_join._stored(np.ones(16, np.int64))
    heavy = np.arange(docs) == 0
    columns = {
        "shingle": np.zeros(docs, np.int64), "i": np.zeros(docs, np.int32), "j": np.ones(docs, np.int32),
        "own": np.where(heavy, 0, 1), "doc_id": np.arange(docs), "component": np.arange(docs), "heavy": heavy,
        "first": np.zeros(docs, bool), "n": np.full(docs, 16, np.int32), "large": np.zeros(docs, bool), "point": [stored] * docs,
    }
    found = set(ngram_join._pairs(pa.table(columns), np.array([0, docs]), 80))
    assert found == {(0, k) for k in range(1, docs)}
    assert sum(asked) < 10 * docs


def test_blocks_of_others_are_copied_for_heavy_documents_only(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 25)
    docs = spark.range(401).select(F.col("id").alias("doc_id"))
    heavy = F.col("doc_id") == 0
    shared = docs.select(F.lit(5).cast("bigint").alias("shingle"), "doc_id", F.lit(16).alias("n"), heavy.alias("heavy"), F.lit(False).alias("first"))
    stored = F.lit(ngram_join._stored(np.ones(16, np.int64)))
    points = docs.select("doc_id", F.lit(16).alias("n"), stored.alias("point"), stored.alias("fine"))
    sent, plain = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, *more: sent.append(df) or plain(df, *more))
    apart = spark.createDataFrame([], "id bigint, component bigint")
    pairs = sorted(map(tuple, ngram_join._across(shared, apart, points, 80).collect()))
    assert pairs == [(0, k) for k in range(1, 401)]
    assert sent[0].count() < 2 * 401
