"""Models of languages come from all labelled documents that are not held out."""

from pyspark.sql import functions as F

from regispark.llm import language


def test_profiles_come_from_all_training_documents(spark):
    # Beyond 500 documents of a language, rare words came from a part of them only.
    rows = [(k, "aaa " * 3 + "".join(chr(97 + int(c)) for c in str(k)), "a") for k in range(900)]
    rows += [(1000 + k, "xyz xyz", "x") for k in range(40)] + [(2000, None, "a"), (2001, "aaa", None), (None, "aaa", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = docs.where(~language.held_out("doc_id") & F.col("text").isNotNull() & F.col("lang").isNotNull())
    wanted = sorted((r["lang"], r["text"]) for r in told.collect())
    assert sum(lang == "a" for lang, _ in wanted) > 600
    assert sorted((r["lang"], r["text"]) for r in language.training(docs).collect()) == wanted
    assert language.keep_identified(docs, cut=True).where("lang = 'x'").count() == 40
