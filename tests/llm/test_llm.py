"""Operators for training data against brute force, round trips and held-out accuracy, and odd input."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from regispark.llm import (
    binary,
    bpe,
    chat,
    components,
    fingerprint,
    html,
    language,
    lines,
    ngram_join,
    packing,
    quality,
    queries,
    units,
)
from regispark.llm.frames import DOCUMENTS

P = pytest.importorskip("public_tokenizers")
DATA = "/root/testdata/sf0.001"
RANKS = "byte_bpe_multi_50k.tiktoken"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
ODD = [
    "", " ", "  a  b ", "\n\n x", "a\t \tb", "x" * 3000, "日本語 テキスト　です", "it's  we'll\r\n ok", "ab" * 400 + " é́ 😀😀",
    "\x00a \x00b", "a \nb\n c", " lead", "trail ", "a\nb c\nd, e.f.", "</s>[INST] ok [/INST]", "<|im_end|>\\", "a\xa0b c",
]


def prose(draw, count):
    return " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(count))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing column names."""
    draw = random.Random(3)
    rows = [(k, t, "en", "a", len(t)) for k, t in enumerate(ODD)]
    rows += [(100, None, None, None, None), (None, "text without an id " * 20, "de", "b", 1), (None, None, None, None, None)]
    rows += [(101, prose(draw, 8000), "en", "a", 1)] * 2 + [(102, "one text", "en", "a", 1), (102, "other text", "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("component_id", "n_words", "kept", "batch", "score", "lang_pred", "n_lines", "n_deleted", "text_hash", "id"):
        docs = docs.withColumn(name, docs["lang"])
    return docs


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components(spark):
    draw = random.Random(5)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)]
    group = {}
    for a, b in links:
        old, new = group.get(a, {a}), group.get(b, {b})
        for x in old | new:
            group[x] = old | new
    for _ in range(3):
        for x in list(group):
            for y in group[x]:
                group[y] = group[y] | group[x]
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r["id"]: r["component"] for r in found} == {x: min(group[x]) for x in linked}


# 1: n-gram join


def words_of(text):
    return [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w]


def shingles(text):
    w = words_of(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(texts):
    sets = {k: shingles(t) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * len(sets[a] | sets[b]) and find(a) != find(b):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {k: (len(sets[k]), find(k)) for k in texts}


@pytest.mark.parametrize(("large", "block"), [(ngram_join.LARGE, ngram_join.BLOCK), (18, 25)])
def test_ngram_join_matches_brute_force_with_hot_passages(spark, monkeypatch, large, block):
    monkeypatch.setattr(ngram_join, "LARGE", large)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    draw = random.Random(11)
    passage = prose(draw, 60)
    texts = {}
    base = prose(draw, 200).split()
    for k in range(240):  # many near copies of one text, at the edge of the likeness
        w = list(base)
        for _ in range(draw.choice((1, 3, 4, 5))):
            w[draw.randrange(200)] = "changed" + str(draw.random())
        texts[k] = " ".join(w)
    for k in range(240, 560):  # unlike texts that share most of their words in one passage
        texts[k] = prose(draw, draw.randrange(3, 25)) + " " + passage
    for k in range(560, 700):
        texts[k] = prose(draw, draw.randrange(0, 9))
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id bigint, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked_components(docs).collect()}
    assert found == brute_components(texts)


@pytest.mark.parametrize("block", [ngram_join.BLOCK, 25])
def test_links_and_their_numbers_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    draw = random.Random(31)
    base = prose(draw, 150).split()
    texts = {}
    for k in range(120):  # copies and near copies of one text, some pairs linked and some not
        w = list(base)
        for _ in range(draw.choice((0, 0, 1, 2, 3))):
            w[draw.randrange(150)] = "changed" + str(draw.random())
        texts[k] = " ".join(w)
    for k in range(120, 170):
        texts[k] = draw.choice([prose(draw, draw.randrange(0, 30)), "same few words", "same  few\nwords", None, " "])
    sets = {k: frozenset(shingles(t)) for k, t in texts.items()}
    first = {}
    for k in sorted(texts):
        first.setdefault(sets[k] or k, k)
    classes = {k: first[sets[k] or k] for k in texts}

    def linked(a, b):
        common = len(sets[a] & sets[b])
        return bool(common) and 100 * common >= 80 * len(sets[a] | sets[b])

    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").withColumn("class_id", F.lit(1))
    links, members = ngram_join.class_links(docs)
    want = {(a, b) for a, b in itertools.combinations(sorted(set(classes.values())), 2) if linked(a, b)}
    assert sorted(map(tuple, links.collect())) == sorted(want) and len(want) > 100
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == classes
    told = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.link_counts(docs).collect()}
    assert told == {k: (classes[k], sum(linked(k, x) for x in texts if x != k)) for k in texts}


def test_count_tree_misses_no_pair():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 5, (40, 64))
    points = np.maximum(0, np.repeat(base, 10, 0) + draw.integers(-1, 2, (400, 64)) * (draw.random((400, 64)) < 0.2)).astype(np.uint8)
    sizes = points.sum(1, dtype=np.int64)
    q, t = ngram_join.CountTree(points, sizes).search(points, sizes, 80)
    want = {
        (a, b)
        for a in range(400)
        for b in range(400)
        if min(sizes[a], sizes[b]) * 100 >= max(sizes[a], sizes[b]) * 80
        and np.minimum(points[a], points[b]).sum() >= ngram_join.overlap_needed(sizes[a], sizes[b])
    }
    assert set(zip(q.tolist(), t.tolist())) == want and len(want) > 400


def test_points_bound_the_overlap():
    draw = random.Random(2)
    for _ in range(50):
        a = prose(draw, draw.randrange(1, 400))
        b = a + " " + prose(draw, draw.randrange(1, 300))
        (s, r) = ngram_join.shingle_sets([a, b])
        p, q = (ngram_join._loaded(ngram_join._stored(ngram_join.point(x))) for x in (s, r))
        g = min(len(p), len(q))
        p, q = ngram_join.folded(p[None], g)[0], ngram_join.folded(q[None], g)[0]
        assert np.minimum(p, q).sum() >= len(np.intersect1d(s, r)) and p.sum() == len(s) == len(shingles(a))


def test_ngram_join_on_odd_input(odd_docs, no_docs):
    rows = ngram_join.linked_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[100]["n_shingles"] == 0 and by[100]["component_id"] == 100 and by[None]["component_id"] is None
    assert ngram_join.linked_components(no_docs).count() == 0
    links, members = ngram_join.class_links(odd_docs)
    assert members.count() == odd_docs.count() and links.where("a >= b").count() == 0
    assert ngram_join.link_counts(no_docs).count() == 0
    kept = ngram_join.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id is null").count() == 2 and kept.where("doc_id = 101").count() == 2
    assert ngram_join.one_of_each(no_docs).count() == 0


# 2: packing


def test_best_lengths_match_brute_force():
    draw = random.Random(4)
    for _ in range(300):
        histogram = [(x, draw.randint(1, 9)) for x in draw.sample(range(30), draw.randint(1, 9))]
        most = draw.randint(1, 5)

        def waste(ends):
            return sum(n * (min(e for e in ends if e >= x) - x) for x, n in histogram)

        lengths = sorted(x for x, _ in histogram)
        best = min(
            waste((*c, lengths[-1])) for r in range(min(most, len(lengths))) for c in itertools.combinations(lengths[:-1], r)
        )
        found = packing.best_lengths(histogram, most)
        assert len(found) <= most and waste(found) == best


def test_packing_fills_batches(spark):
    docs = spark.range(500).selectExpr("id as doc_id", "cast(pmod(xxhash64(id), 70) as bigint) as n")
    rows = packing.packed(docs, "n", ["doc_id"], buckets=5, budget=400).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) == 500
    for _, batch in itertools.groupby(sorted(rows, key=lambda r: r["batch"]), key=lambda r: r["batch"]):
        batch = list(batch)
        assert len({r["bucket_length"] for r in batch}) == 1 and max(r["n"] for r in batch) <= batch[0]["bucket_length"]
        assert len(batch) * batch[0]["bucket_length"] <= 400
        assert sorted(r["place"] for r in batch) == list(range(len(batch)))


def test_packing_on_odd_input(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r["n_tokens"] <= r["bucket_length"] for r in rows)
    assert packing.pack_documents(no_docs).count() == 0
    lengths = odd_docs.selectExpr("cast(null as bigint) as n", "20000000 + doc_id as m", "doc_id")
    assert packing.packed(lengths, "n", ["doc_id"]).agg({"bucket_length": "max"}).first()[0] == 0
    assert all(r["bucket_length"] >= (r["m"] or 0) for r in packing.packed(lengths, "m", ["doc_id"]).collect())


def test_long_lengths_are_counted_exactly(spark, monkeypatch):
    docs = spark.createDataFrame([(k, n) for k, n in enumerate([16_385, 16_388, 16_389])], "doc_id bigint, n bigint")
    padding = F.sum(F.col("bucket_length") - F.col("n"))
    assert packing.packed(docs, "n", ["doc_id"], buckets=2).agg(padding).first()[0] == 1
    assert packing.packed(docs, "n", ["doc_id"], buckets=2, fine=1024).agg(padding).first()[0] >= 1
    many = [(1 + k * 7 + k * k % 5, 1 + k % 3) for k in range(60_000)]
    ends = packing.best_lengths(many, 16)
    assert len(ends) == 16 and ends[-1] == max(n for n, _ in many)


def test_rows_of_one_id_are_dealt_over_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 200)
    spark.range(3000).selectExpr("cast(null as bigint) as doc_id", "id % 7 as n", "id as _length", "id as dealt").write.parquet(
        str(tmp_path / "docs")
    )
    docs = spark.read.parquet(str(tmp_path / "docs"))
    packed = packing.packed(docs, "n", ["doc_id"], buckets=1, budget=60)
    rows = packed.collect()
    assert len({(r["batch"], r["place"]) for r in rows}) == len({r["_length"] for r in rows}) == 3000
    shards = {}
    for r in rows:
        shard = r["batch"].split("-")[1]
        shards[shard] = shards.get(shard, 0) + 1
    assert len(shards) == 16 and max(shards.values()) < 400
    clashing = ["doc", "length", "counted", "shard", "row", "key_0", "_counted", "_shard", "_row"]
    for name in clashing:
        docs = docs.withColumn(name, F.lit("x"))
    assert packing.packed(docs, "n", ["doc_id"]).columns == [*docs.columns, "bucket_length", "batch", "place"]
    assert packing.packed(docs, "n", ["doc_id"]).count() == 3000


def test_bucket_lengths_are_those_of_documents(spark):
    lengths = [5, 9, 16_385, 16_390, 40_001, 40_003, 100_001, 3_000_001]
    docs = spark.createDataFrame(list(enumerate(lengths)), "doc_id bigint, n bigint")
    for buckets in (3, 16):
        rows = packing.packed(docs, "n", ["doc_id"], buckets=buckets).collect()
        for end in {r["bucket_length"] for r in rows}:
            assert end == max(r["n"] for r in rows if r["bucket_length"] == end)


# 3 and 10: BPE and token files


def test_bpe_equals_the_tiktoken_library(spark, odd_docs):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.load_ranks(P.path(RANKS))
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})
    texts = ODD + [r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(60).collect()]
    ids = bpe.Encoder(ranks, P.PATTERN, limit=50).encode(texts)
    for text, own in zip(texts, ids):
        assert np.frombuffer(own, "<u4").tolist() == encoding.encode_ordinary(text)
        assert bpe.decode(ranks, own).decode() == text
    for piece in (b" undeniably", "é́😀".encode(), b"aaaaabab" * 5, b"x"):
        assert bpe.merge_alone(ranks, piece) == bpe.merge_together(ranks, [b"ab", piece])[1]
    rows = bpe.round_trip(odd_docs, P.path(RANKS), P.PATTERN).collect()
    whole = sorted(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in odd_docs.collect())
    assert sorted(r["decoded_sha256"] for r in rows) == whole
    back = bpe.decode_ids(bpe.encode(odd_docs, P.path(RANKS), P.PATTERN), P.path(RANKS)).collect()
    assert sorted(r["text"] for r in back) == sorted(r["text"] or "" for r in odd_docs.collect())


def test_units_are_encoded_like_whole_texts():
    draw = random.Random(8)
    cache = units.UnitCache(lambda us: [units.text_of(u).encode() for u in us], lambda t: t.encode(), limit=30)
    texts = [prose(draw, draw.randrange(40)).replace("1", "1.\n").replace("2 ", "2, ") for _ in range(50)]
    for _ in range(2):
        assert [x.decode() for x in cache.encode(texts + ODD)] == texts + ODD


def test_token_files(spark, odd_docs, no_docs, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    path = P.path("byte_bpe_50k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    marked = ["a<|endoftext|>b <|endoftext|> c\n<|endoftext|>", "<|endoftext|>", "x <|endoftext|>. <|endoftext|><|endoftext|> y"]
    more = spark.createDataFrame([(300 + k, t) for k, t in enumerate(marked)], "doc_id bigint, text string")
    odd_docs = odd_docs.select("doc_id", "text").unionByName(more)
    folder = f"file://{tmp_path}/tokens"
    manifest = binary.write_token_files(odd_docs, folder, path, 2, width=16)
    rows = sorted(binary.read_token_files(manifest, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] is None for r in rows[:3]] == [True, True, False]
    assert [r["doc_id"] for r in rows[2:]] == sorted(r["doc_id"] for r in rows[2:])
    assert sum(r["n_tokens"] for r in rows[:-1]) == rows[-1]["start"]
    want = []
    for r in odd_docs.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want.append((-1 if r["doc_id"] is None else r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    found = [(-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows]
    assert sorted(found) == sorted(want)
    assert binary.token_ids(manifest, folder).count() == len(rows)
    assert binary.documents_read_back(no_docs, path, 2).count() == 0
    with pytest.raises(Exception, match="does not fit"):
        binary.write_token_files(odd_docs, f"{folder}-small", path, 70_000, width=16)


# 4: language


def test_language_on_held_out_documents(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r["doc_id"]: r for r in language.identify(docs).collect()}
    held = [r for r in docs.select("doc_id", "lang").collect() if found[r["doc_id"]]["held_out"]]
    for r in held:
        assert found[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert sum(found[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    rows = language.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (0, 1, 100)} == {"und"}
    assert language.identify(no_docs).count() == 0
    kept = language.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 100").count() == 0


def test_language_stage_rejects_what_was_not_learned(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*DOCUMENTS)
    foreign = [
        "Съешь же ещё этих мягких французских булок, да выпей чаю", "明日は雨が降るでしょう", "Ok привет это русский текст",
        "Zażółć gęślą jaźń, proszę bardzo, dziękuję wszystkim za pomoc w tej sprawie",
        "Hyvää päivää kaikille, tänään on kaunis ilma ja me menemme ulos",
    ]
    short = ["The cat sat on the mat.", "yes", "Wir gehen heute ins Kino", "Avec.", "A.\nAll rights reserved."]
    made = [(-1 - k, t, None, "a", len(t)) for k, t in enumerate(foreign + short)]
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    kept = {r["doc_id"] for r in stage(spark, docs.unionByName(spark.createDataFrame(made, SCHEMA)), "").collect()}
    assert {k for k in kept if k < 0} == {-1 - k for k in range(len(foreign), len(made))}
    before = {r["doc_id"] for r in docs.collect()}
    assert len(before - kept) <= 0.002 * len(before)


def test_language_distance_by_hand():
    profiles = language.Profiles({"x": np.array([5, 7, 9]), "y": np.array([9, 1])}, 3)
    codes, counts = language.ngrams("Aa! ab")
    assert counts[codes.tolist().index(ord("a"))] == 3
    assert profiles.predict("12 34") == ("und", 0.0) and profiles.predict(None) == ("und", 0.0)


# 5: quality


def test_quality_on_odd_input(spark, odd_docs, no_docs):
    rows = quality.judged(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r["kept"] <= (not r["base_failed"]) and r["base_failed"] == (
            r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        )
    assert quality.judged(no_docs).count() == 0
    assert quality.keep_good(odd_docs).columns == odd_docs.columns


def test_boilerplate_lines_leave_documents(spark, odd_docs, no_docs):
    draw = random.Random(8)
    rows = []
    for k in range(40):
        own = [prose(draw, 30) for _ in range(3)]
        held = [own[0], "", " Share  this PAGE", own[1], "share this\tpage ", own[2], ""] if k < 30 else own
        rows.append((k, "\n".join(held), "en", "h" if k % 2 else None, 1))
    rows += [(50, None, "en", "h", 5), (51, rows[1][1], "en", "other", 5)]
    docs = spark.createDataFrame(rows * 2, SCHEMA).withColumn("n_removed_words", F.lit("x"))
    limit = quality.LINE_DOCS
    quality.LINE_DOCS = 12
    try:
        found = quality.without_boilerplate(docs).collect()
        kept = quality.keep_good(docs).collect()
    finally:
        quality.LINE_DOCS = limit
    texts = {k: t for k, t, *_ in rows}
    assert len(found) == len(rows) * 2
    for r in found:
        lines = (texts[r["doc_id"]] or "").split("\n")
        left = [x for x in lines if x.lower().split() != ["share", "this", "page"] or r["doc_id"] == 51]
        gone = len(lines) - len(left)
        assert r["text"] == (None if r["doc_id"] == 50 else "\n".join(left))
        assert (r["n_removed_lines"], r["n_removed_words"]) == (gone, 3 * gone)
        assert r["n_chars"] == (len(r["text"]) if gone else dict((x[0], x[4]) for x in rows)[r["doc_id"]])
    same = {r["doc_id"]: (r["text"], r["n_chars"]) for r in found}
    assert {r["doc_id"] for r in kept} == set(texts) - {50} and len(kept) == 82
    assert all((r["text"], r["n_chars"]) == same[r["doc_id"]] for r in kept)
    assert quality.without_boilerplate(odd_docs).count() == odd_docs.count()
    assert quality.without_boilerplate(no_docs).count() == 0


def test_boilerplate_is_alike_at_every_host_size(spark):
    draw = random.Random(9)
    rows = [(k, "a line that many share\n" + prose(draw, 60), "en", "small", 1) for k in range(25)]
    rows += [(100 + k, "a line that many share\n" * (k < 25) + prose(draw, 60), "en", "large", 1) for k in range(400)]
    rows += [(600 + k, "a line that few share\n" * (k < 19) + prose(draw, 60), "en", "tiny", 1) for k in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r["doc_id"]: r["n_removed_lines"] for r in quality.without_boilerplate(docs).collect()}
    assert {k for k, n in found.items() if n == 1} == {*range(25), *range(100, 125)}
    assert not any("many share" in r["text"] for r in quality.keep_good(docs).collect())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "made"])
def test_boilerplate_sql_agrees(spark, folder, tmp_path):
    from checks.compare import database, difference

    if folder == "made":
        held = ["Top line\n\n", "", "\n top\tLINE ", "\u00c9t\u00e9 \u00e0 la une\n"]
        rows = [(k, f"{held[k % 4]}own {k}\n{held[k % 3]}", "en", "ab"[k % 2], 1) for k in range(200)]
        rows += [(300, None, "en", None, 1), (301, "", "en", None, 1), (301, "\n\n", "en", "a", 1)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "one"))
        (part,) = (tmp_path / "one").glob("*.parquet")
        folder = str(tmp_path / "t")
        (tmp_path / "t").mkdir()
        (tmp_path / "t" / "documents.parquet").write_bytes(part.read_bytes())
    problem, _, _ = difference(spark, database(folder), "op5_boilerplate_lines", folder)
    assert problem is None


def test_depleted_documents_go(spark):
    draw = random.Random(6)
    boiler = "\n".join(prose(draw, 20) for _ in range(4))
    rows = [(k, boiler + "\n" + prose(draw, 10 if k < 25 else 300), "en", "h", 1) for k in range(50)]
    rows += [(k, prose(draw, 80), "en", "h", 1) for k in range(50, 60)] + [(60, boiler + " " + boiler, "en", "other", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r["doc_id"] for r in quality.judged(docs).collect() if r["kept"]}
    assert kept & set(range(60)) == set(range(25, 60))
    assert {r["doc_id"] for r in quality.keep_good(docs).collect()} == kept


# 6: html


def test_html_gives_the_article(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    model = html.fit(pages[:60])
    for text, page in zip(model.texts(pages[100:160]), pages[100:160]):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
        clean = (" ".join(html_unescape(b).split()) for b in blocks)
        assert text == "\n\n".join(b for b in clean if b)


def html_unescape(text):
    import html as standard

    return standard.unescape(text)


def test_html_on_odd_input(spark):
    model = html.fit([])
    odd = ["", "plain", "<p>a<p>b", "<" * 50, "<div>" * 3000 + "x", "<p>&amp;&#65;&nbsp;z</p>", "</p></div>", "<script>if (a<b) x</script>"]
    assert len(model.texts(odd)) == len(odd) and model.texts([""]) == [""]
    pages = spark.createDataFrame([(1, "u", None, "t"), (None, None, "<p>x</p>", None)], "page_id bigint, url string, html string, text string")
    rows = html.extracted(pages, model).collect()
    assert len(rows) == 2 and all(r["n_chars"] == len(r["text"]) for r in rows)


def test_decoding_is_the_best_consistent_choice():
    draw = np.random.default_rng(5)
    page = html.Page("<div><p>aaa</p><ul><li>b</li><li>c</li></ul></div><p>d</p>")
    n = len(page.tag)
    for _ in range(40):
        odds = draw.normal(0, 2, n)
        weight = np.log2(2 + np.array([len(t.strip()) for t in page.text], float))
        score = lambda kept: sum(
            -np.logaddexp(0, -o if k else o) * w for o, k, w in zip(odds, kept, weight)
        )
        legal = [
            (True, *c)
            for c in itertools.product((True, False), repeat=n - 1)
            if all(not k or (True, *c)[page.parent[i]] for i, k in enumerate((True, *c)) if i)
        ]
        assert np.isclose(score(html.decoded(page, odds)), max(map(score, legal)))


# 7: fingerprints


def test_spans_and_extensions():
    draw = random.Random(9)
    for _ in range(40):
        a = "".join(draw.choices("abé😀", k=draw.randrange(1, 60)))
        b = a[: draw.randrange(len(a) + 1)] + "".join(draw.choices("abé", k=20))
        p, q = fingerprint.PrefixHashes(a), fingerprint.PrefixHashes(b)
        i, j = draw.randrange(len(a)), draw.randrange(len(b))
        want = len(list(itertools.takewhile(lambda x: x[0] == x[1], zip(a[i:], b[j:]))))
        assert fingerprint.common_extension(p, i, q, j) == want
        spans = p.spans(3)
        assert all((spans[x] == spans[y]) == (a[x : x + 3] == a[y : y + 3]) for x in range(len(spans)) for y in range(x))


def test_edited_fingerprints(spark, odd_docs, no_docs):
    rows = [(k * 3, t) for k, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in fingerprint.edited_fingerprints(docs).collect()}
    assert len(found) == len(rows)
    for k, (key, text) in enumerate(rows):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + rows[(k + 1) % len(rows)][1][:quarter]
        r = found[key]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(text)
        assert r["common_prefix"] == len(list(itertools.takewhile(lambda x: x[0] == x[1], zip(text, edited))))
    odd = [(r["doc_id"], r["text"] or "") for r in odd_docs.collect()]
    told = fingerprint.edited_fingerprints(odd_docs.repartition(7)).collect()
    assert sorted(repr(r["doc_id"]) for r in told) == sorted(repr(k) for k, _ in odd)
    assert sum(r["doc_id"] is None for r in told) == 2 and sum(r["doc_id"] == 102 for r in told) == 2
    copies = [r for r in told if r["doc_id"] == 101]
    assert len(copies) == 2 and {r["near_next"] for r in copies} >= {1.0}
    assert fingerprint.edited_fingerprints(no_docs).count() == 0
    alike = fingerprint.fingerprints(odd_docs).where("id = 101").select("fingerprint").distinct()
    assert alike.count() == 1


def plain_lanes(text):
    """Smallest mixed hash of the spans of each lane, span by span with whole numbers."""
    size = min(fingerprint.SPAN, len(text))
    best = {}
    for at in range(len(text) - size + 1) if size else ():
        joined = 0
        for prime in fingerprint.PRIMES:
            value = sum((ord(c) + 1) * pow(fingerprint.BASE, k, prime) for k, c in enumerate(text[at : at + size])) % prime
            joined = (joined << 31 | value) % 2**64
        x = joined
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
        x = min(x ^ x >> 31, 2**64 - 2)
        best[x % fingerprint.LANES] = min(x, best.get(x % fingerprint.LANES, x))
    return [(best[k] >> 16) % 0xFFFF if k in best else 0xFFFF for k in range(fingerprint.LANES)]


def test_fingerprints_and_likeness_match_brute_force(spark):
    draw = random.Random(21)
    texts = ["", "a", "short", "é😀" * 9, "x" * 200] + [prose(draw, draw.randrange(1, 60)) for _ in range(12)]
    texts += [texts[-1], texts[-1] + " and more", texts[-2][5:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = [plain_lanes(t) for t in texts]
    for r in fingerprint.edited_fingerprints(docs.repartition(3)).collect():
        k = r["doc_id"]
        following = (k + 1) % len(texts)
        quarter = len(texts[k]) // 4
        edited = plain_lanes(texts[k][: len(texts[k]) - quarter] + texts[following][:quarter])
        assert r["fingerprint"] == "".join(f"{x:04x}" for x in want[k])
        assert r["edited_fingerprint"] == "".join(f"{x:04x}" for x in edited)
        for name, other in (("near_edited", edited), ("near_next", want[following])):
            used = [(x, y) for x, y in zip(want[k], other) if (x, y) != (0xFFFF, 0xFFFF)]
            assert r[name] == (sum(x == y for x, y in used) / len(used) if used else 1.0)


# 8: chat


def test_chat_round_trip(spark):
    rows = [(c, t, r, x) for c, (t, (r, x)) in itertools.product(range(2), enumerate(zip(itertools.cycle(["user", "assistant", "assistant"]), ODD)))]
    rows += [(9, 0, "us\ner", "a"), (9, 1, "us\\ler", "b"), (9, 2, "x\\\n\\l", "c"), (9, 3, "assistant", "é\n😀")]
    rows += [(7, 0, None, None), (None, 1, "assistant", "x"), (8, None, "user", "u"), (8, 0, "assistant", "\\")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    chats = chat.formatted(turns).cache()
    found = {r["conv_id"]: r for r in chat.digests(chats).collect()}
    for key in (0, 1, 7, 8, 9, None):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0))
        whole = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own)
        trained = "".join(x or "" for _, _, r, x in own if r == "assistant")
        assert found[key]["n_turns"] == len(own) and found[key]["loss_chars"] == len(trained)
        assert found[key]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert found[key]["loss_sha256"] == hashlib.sha256(trained.encode()).hexdigest()
    for r in chats.collect():  # markers are the template's own; runs of a role are one turn
        runs = [k for k, _ in itertools.groupby(x[2] for x in rows if x[0] == r["conv_id"])]
        assert r["formatted"].count(chat.START) == r["formatted"].count(chat.END) == len(runs)
        assert "[INST]" not in r["formatted"] and "</s>" not in r["formatted"]
        assert [t["role"] for t in chat.read_back(chats).where(F.col("conv_id").eqNullSafe(r["conv_id"])).first()["turns"]] == [k or "" for k in runs]
        for spans, text in ((r["loss"], r["formatted"]), (r["loss_bytes"], r["formatted"].encode())):
            trained = [text[s["start"] : s["start"] + s["length"]] for s in spans]
            plain = [x[3] or "" for x in sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: (x[1] is not None, x[1] or 0)) if x[2] == "assistant"]
            assert len(trained) == len(plain)
    clashing = turns.withColumn("rows", F.lit(1)).withColumn("loss", F.lit(1)).withColumn("raw", F.lit(1))
    assert chat.formatted(clashing).count() == chats.count()
    assert chat.digests(chat.formatted(turns.limit(0))).count() == 0


def test_a_conversation_of_many_turns(spark):
    """Spans of 12,000 turns, all trained but the first of each five."""
    size = 12_000
    turns = spark.range(size).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 5 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("é text "), F.col("id").cast("string")).alias("text"),
    )
    (row,) = chat.formatted(turns).collect()
    for spans, text in ((row["loss"], row["formatted"]), (row["loss_bytes"], row["formatted"].encode())):
        want = [f"é text {k}" for k in range(size) if k % 5]
        got = [text[s["start"] : s["start"] + s["length"]] for s in spans]
        assert got == (want if isinstance(text, str) else [w.encode() for w in want])
    (told,) = chat.digests(chat.formatted(turns)).collect()
    assert told["loss_sha256"] == hashlib.sha256("".join(want).encode()).hexdigest()




# 9: lines


def brute_gone(texts, least):
    first, gone = set(), {}
    for key in sorted(texts):
        places, ids, words = lines.line_ids(texts[key])
        for s in range(len(ids)):
            for e in range(s, len(ids)):
                run = tuple(ids[s : e + 1])
                if sum(words[s : e + 1]) >= least:
                    if run in first:
                        gone.setdefault(key, set()).update(places[s : e + 1])
                    first.add(run)
    return gone


def test_line_dedup_matches_brute_force(spark):
    draw = random.Random(12)
    pool = [prose(draw, draw.choice((0, 1, 2, 5, 30, 60))) for _ in range(30)]
    texts = {}
    for k in range(60):
        texts[k] = "\n".join(draw.choice(pool) if draw.random() < 0.8 else prose(draw, 6) for _ in range(draw.randrange(0, 25)))
    texts[60], texts[61] = texts[3] + "\n" + texts[4], "\n".join([pool[5] or "x"] * 40)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    gone = brute_gone(texts, 12)
    for r in lines.deduplicated(docs, 12).collect():
        own = texts[r["doc_id"]].split("\n")
        assert r["text"] == "\n".join(x for k, x in enumerate(own) if k not in gone.get(r["doc_id"], ()))
        assert r["n_deleted"] == len(gone.get(r["doc_id"], ())) and r["n_lines"] == len(own)


def test_line_dedup_on_odd_input(odd_docs, no_docs):
    named = odd_docs.withColumn("_gone", F.lit(1)).withColumn("gone", F.lit(1)).withColumn("doc", F.lit(1))
    assert lines.without_copies(named).columns == named.columns
    assert lines.without_copies(named).count() == odd_docs.count()
    out = lines.deduplicated(odd_docs)
    assert out.count() == odd_docs.count() and out.where("text is null").count() == 2
    assert lines.deduplicated(no_docs).count() == 0
    kept = lines.without_copies(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


# All together


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, ""), name)
        assert docs.columns == before.columns
        assert docs.select("doc_id").subtract(before.select("doc_id")).count() == 0
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.7 * counts[0]
    found = brute_components({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})
    assert all(component == key for key, (n, component) in found.items())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == counts[-1]


def test_queries_are_registered():
    import __spark_entry__ as entry

    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))
    assert "pipeline" in entry.queries() and set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_agrees(spark, name):
    from checks.compare import database, difference

    problem, _, _ = difference(spark, database(DATA), name, DATA)
    assert problem is None


def test_ngram_repeated_id_keeps_each_text(spark):
    """An id with a copied text and another text is linked by both."""
    one, two, three = (" ".join(f"{c}{k}" for k in range(60)) for c in "abc")
    near = two + " end"
    rows = [(1, one), (2, one), (2, two), (3, near), (4, three)]
    found = ngram_join.linked_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}
