"""Language distances, boosted trees and the unit table against plain versions; pages of hostile shapes."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from regispark.llm import binary, boosting, html, language, packing, quality, unit_table

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_ngrams(text):
    counts = Counter()
    letters = "".join(c if language._letters()[ord(c)] else " " for c in text.lower())
    for word in letters.split(" "):
        if word:
            ends = "\x01" + word + "\x01"
            counts.update(word)
            counts.update(ends[k : k + 2] for k in range(len(ends) - 1))
            counts.update(ends[k : k + 3] for k in range(len(ends) - 2))
    return counts


def plain_rank(counts, most):
    def number(gram):
        value = 0
        for c in gram:
            value = value << language.BITS | ord(c)
        return value

    return sorted(counts, key=lambda g: (-counts[g], number(g)))[:most]


def test_language_distances_match_brute_force(spark):
    """Profiles, out-of-place distances and scores, n-gram by n-gram."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = [(r["lang"], r["text"]) for r in language.training(docs).collect()]
    assert len(known) > 100
    sums = {}
    for lang, text in known:
        sums.setdefault(lang, Counter()).update(plain_ngrams(text))
    profiles = {lang: plain_rank(c, language.PROFILE) for lang, c in sums.items()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in language.identify(docs).collect():
        own = plain_rank(plain_ngrams(texts[r["doc_id"]] or ""), language.RANKED)
        if not own:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        distance = {}
        for lang, profile in profiles.items():
            place = {g: k for k, g in enumerate(profile)}
            far = language.PROFILE
            distance[lang] = sum(min(abs(place[g] - k), far) if g in place else far for k, g in enumerate(own))
        best = min(sorted(distance), key=distance.get)
        assert r["lang_pred"] == best
        assert r["score"] == pytest.approx(1 - distance[best] / (language.PROFILE * len(own)))


def test_many_labels_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    rows = [(k, "aaa bbb ccc", "a", "s", 1) for k in range(40)] + [(40 + k, "xxx yyy zzz", "x", "s", 1) for k in range(30)]
    rows += [(100 + k, "qq", f"dirty{k}", "s", 1) for k in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("_lang", F.lit("mine")).withColumn("_score", F.lit(7))
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs).collect()}
    assert {found[k] for k in range(40)} == {"a"} and {found[k] for k in range(40, 70)} == {"x"}
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and kept.where("_lang = 'mine' and _score = 7").count() == len(rows)
    assert language.keep_identified(docs.limit(0), cut=True).count() == 0


def test_cuts_of_the_first_tree_are_the_best(monkeypatch):
    """Every cut of a tree has the greatest gain of all cuts of all columns, counted row by row."""
    monkeypatch.setattr(boosting, "TREES", 2)
    draw = np.random.default_rng(5)
    x = np.column_stack([draw.integers(0, 12, 400), draw.normal(size=400).round(1), draw.integers(0, 2, (400, 3))]).astype(float)
    y = ((x[:, 0] > 5) & (x[:, 3] > 0) | (x[:, 1] > 1)).astype(float)
    y[::17] = 1 - y[::17]
    trees = boosting.fit(x, y, 2)
    score = np.full(len(x), trees.start)
    assert trees.start == pytest.approx(np.log(y.mean() / (1 - y.mean())))
    for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)

        def gain(rows, left):
            def part(mask):
                return g[mask].sum() ** 2 / (h[mask].sum() + boosting.SMOOTH)

            if min(left.sum(), rows.sum() - left.sum()) < boosting.LEAST:
                return -1.0
            return part(left) + part(rows & ~left) - part(rows)

        node = np.zeros(len(x), int)
        for level in range(boosting.DEPTH):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = node == k
                best = max(gain(rows, rows & (x[:, c] <= v)) for c in range(5) for v in np.unique(x[:, c]))
                if np.isfinite(cut[k]):
                    assert gain(rows, rows & (x[:, feature[k]] <= cut[k])) == pytest.approx(best)
                else:
                    assert best <= 1e-6
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        node -= 2**boosting.DEPTH - 1
        for k in range(2**boosting.DEPTH):
            want = boosting.RATE * g[node == k].sum() / (h[node == k].sum() + boosting.SMOOTH)
            assert leaf[k] == pytest.approx(want)
        score += leaf[node]
    assert trees.log_odds(x) == pytest.approx(score)


def test_the_article_is_found_without_its_tag(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    model = html.fit(pages[:120])
    whole = model.texts(pages[120:220])
    for opening in ("<div>", '<div class="qzx-77">'):
        changed = [re.sub("<article[^>]*>", opening, h).replace("</article>", "</div>") for h in pages[120:220]]
        shares = []
        for want, got in zip(whole, model.texts(changed)):
            common = sum((Counter(want.split()) & Counter(got.split())).values())
            assert common == len(got.split())  # nothing else comes with it
            shares.append(common / max(1, len(want.split())))
        assert sum(shares) / len(shares) >= 0.95


def test_pages_of_hostile_shapes_take_linear_time():
    model = html.fit([])
    for page in ("<div>" * 100_000 + "x", "<b>" * 50_000 + "</i>" * 50_000 + "x", "<li><p>" * 50_000 + "x", "<p>x" * 50_000):
        began = time.time()
        (text,) = model.texts([page])
        assert time.time() - began < 15
        assert set(text) <= {"x", "\n"}
    lot = ["<p>one two</p>", "<div>" * 20_000 + "x", "", "<p>three</p>"]
    assert model.texts(lot) == [model.texts([h])[0] for h in lot]


def test_features_are_laid_out_alike_in_slices():
    page = html.Page('<div class="a b"><p>one, two.<a href=x>three</a></p><p id="b">four</p></div>' * 40)
    known = {"tag:p": 0, "a": 1, "b": 2, "tag:a": 3, "nowhere": 4}
    found = html.Features(page, known)
    whole = found.rows()
    assert whole.shape == (len(page.tag), html.SHAPE + 2 * len(known))
    assert np.array_equal(whole, np.concatenate([found.rows(k, k + 7) for k in range(0, len(found), 7)]))
    for k, tokens in enumerate(page.tokens):
        own = {known[t] for t in ("tag:" + page.tag[k], *tokens) if t in known}
        above, up = set(), page.parent[k]
        while k and up >= 0:
            above |= {known[t] for t in ("tag:" + page.tag[up], *page.tokens[up]) if t in known}
            up = page.parent[up]
        bits = whole[k, html.SHAPE :]
        assert set(np.flatnonzero(bits[: len(known)])) == own
        assert set(np.flatnonzero(bits[len(known) :])) == above


ODD = [
    "", " ", "  a  b ", "\n\n x", "a\t \tb", "x" * 3000, "日本語 テキスト　です", "it's  we'll\r\n ok", "ab" * 400 + " é́ 😀😀",
    "\x00a \x00b", "a \nb\n c", " lead", "trail ", "a\nb c\nd, e.f.", "a\xa0b c", "a<|endoftext|>b <|endoftext|> c\n<|endoftext|>",
    ".", ",", "a.", "a. b.", "1,", "x\n.", "\n", "it’s fine", "end.\nNext, one.\n1.", "a,b,c. d", "\x85x", "x y", "..", "a.. b",
]


@pytest.mark.parametrize("held", [60, 100_000])
def test_unit_table_equals_the_library(held):
    tokenizers = pytest.importorskip("tokenizers")
    path = P.path("byte_bpe_50k.json")
    plain = tokenizers.Tokenizer.from_file(path)
    known = binary._tokenizer(path)
    table = unit_table.UnitTable(known.encode_units, known.encode_whole, held=held)
    draw = random.Random(held)
    words = "alpha é ñandú the of . , a. b, 12. x.y it's we'll, (foo) ümläut, ß. antidisestablishmentarianism. x-y".split()
    texts = list(ODD)
    for _ in range(1500):
        joined = "".join(draw.choice(words) + draw.choice(["   "[: draw.choice([1, 1, 1, 1, 2])], " ", "\n"]) for _ in range(draw.randrange(0, 40)))
        texts.append(joined[:-1] if draw.random() < 0.9 else joined)
        texts.append(f"w{draw.randrange(5000)} x")
    for at in range(0, len(texts), 300):
        some = texts[at : at + 300]
        ids, sizes = table.encode([t.encode() for t in some])
        ends = np.cumsum(sizes)
        for text, end, size in zip(some, ends.tolist(), sizes.tolist()):
            assert ids[end - size : end].tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert len(table.keys) <= held + 5000
    assert table.encode([])[0].tolist() == [] and table.encode([b"", b""])[1].tolist() == [0, 0]


def test_a_shared_line_is_judged_alike_at_every_host_size(spark):
    draw = random.Random(2)
    line = " ".join(f"shared{k}" for k in range(50))

    def own(count):
        return " ".join(f"w{draw.randrange(10**6)}" for _ in range(count))

    rows = [(k, f"{line}\n{own(10)}", "en", "small", 1) for k in range(30)]
    rows += [(100 + k, f"{line}\n{own(10)}" if k < 30 else own(60), "en", "large", 1) for k in range(400)]
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(kept[k] for k in [*range(30), *range(100, 130)])
    assert all(kept[k] for k in range(130, 500))
    good = {r["doc_id"] for r in quality.keep_good(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert good == {k for k, v in kept.items() if v}
    assert quality.keep_good(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lengths_of_packed_rows_keep_their_histogram(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 211 * (F.col("id") % 7)).alias("n"))
    rows = packing.packed(docs, "n", ["doc_id"], buckets=6).collect()
    counted = Counter(r["n"] for r in rows)
    ends = packing.best_lengths(list(counted.items()), 6)
    assert {r["bucket_length"] for r in rows} == set(ends)
    assert all(r["bucket_length"] == min(e for e in ends if e >= r["n"]) for r in rows)
