"""Quality rules: counts over a document's own words and lines, and lines that many documents share.

DataFrame functions only. A document fails the base rules by itself. Of the others, lines that more
than a limit of a host's distinct texts hold count as boilerplate; a document that is depleted
without them is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regispark.llm.frames import WORD_GAP, materialize, words
from regispark.operators.joins import broadcast_if_small

#: Fewest words of a document, and the largest part of them, in percent, in repeated windows.
MIN_WORDS = 50
MAX_REPEATED = 50
#: A line is boilerplate when this many distinct texts of a host hold it.
LINE_DOCS = 20
#: Part of its words that a document must keep without boilerplate lines.
MIN_LEFT = 0.3
GAPS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
REMOVED = ["n_removed_lines", "n_removed_words"]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _removed(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _text_hash(text: Column) -> Column:
    """128 bits, as texts are told apart by them."""
    return F.unhex(F.md5(text))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(_removed(x, GAPS)) > 0)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``
    and ``base_failed``. A null text has no words. Columns of those names are replaced.

    Windows of three words are hashed and sorted with their places, so repeated ones are
    neighbours; the words they cover are summed over the gaps between their places.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    staged = docs.withColumns({
        "_words": words(F.col(text)),
        "_lines": _lines(whole),
        "word_chars": F.length(_removed(whole, GAPS)).cast("bigint"),
        "n_symbols": (F.length(whole) - F.length(_removed(whole, SYMBOLS))).cast("bigint"),
    }).withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "_windows": F.when(
            F.size("_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - WINDOW),
                lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(WINDOW))),
            ),
        ),
    })
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    staged = staged.drop("_words", "_lines").withColumn("_placed", F.when(repeats, placed)).drop("_windows")

    def repeated(x: Column, k: Column) -> Column:
        before, after = F.get("_placed", k - 1)["h"], F.get("_placed", k + 1)["h"]
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    places = F.sort_array(F.transform(F.filter("_placed", repeated), lambda x: x["i"]))
    covered = F.aggregate(
        "_places",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda a, p: F.struct(
            p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"]).cast("bigint")).alias("n")
        ),
        lambda a: a["n"],
    )
    staged = staged.withColumn("_places", places).drop("_placed")
    staged = staged.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).drop("_places")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    staged = staged.withColumn("base_failed", failed)
    # A generator, so that a filter on these columns is not pushed down and the counting repeated in it.
    others = [c for c in docs.columns if c not in MEASURES]
    return staged.select(*others, F.inline(F.array(F.struct(*MEASURES))))


def _line_rows(docs: DataFrame, text: str, host: str) -> DataFrame:
    """``host``, ``text_hash``, ``pos`` (in the text split at line ends), ``line`` (hash of the
    normalised line) and ``words`` of the lines with words, once for each distinct text of a host."""
    spoken = F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
    lines = docs.select(F.col(host).alias("host"), _text_hash(F.col(text)).alias("text_hash"), spoken)
    lines = lines.where(F.length(_removed(F.col("col"), GAPS)) > 0)
    normal = F.lower(F.trim(F.regexp_replace("col", WORD_GAP, " ")))
    lines = lines.select(
        "host", "text_hash", "pos", F.xxhash64(normal).alias("line"), F.size(F.split(normal, " ")).alias("words")
    ).dropDuplicates(["host", "text_hash", "pos"])
    return materialize(lines, "lines")


def _often_held(lines: DataFrame) -> DataFrame:
    """``host``, ``line`` and ``held`` of the lines that ``LINE_DOCS`` distinct texts of a host hold."""
    held = lines.select("host", "text_hash", "line").distinct().groupBy("host", "line")
    return held.agg(F.count(F.lit(1)).alias("held")).where(F.col("held") >= LINE_DOCS)


def depleted_texts(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``host`` and ``text_hash`` of the texts that keep too few words without boilerplate lines.

    Lines are normalised (lower case, single blanks) and counted once for each distinct text of a
    host, so exact copies weigh as one; the number of texts alone decides, whatever the size of the host.
    All lines of all documents count; counts are combined before they are shuffled. A null host is a host of its own; a null text has no lines.
    """
    lines = _line_rows(docs, text, host)
    often = _often_held(lines).select("host", "line", F.lit(True).alias("often"))
    same_host = F.col("a.host").eqNullSafe(F.col("b.host"))
    marked = lines.alias("a").join(often.alias("b"), same_host & (F.col("a.line") == F.col("b.line")), "left")
    left = F.sum(F.when(F.col("often").isNull(), F.col("words")).otherwise(0))
    return (
        marked.groupBy(F.col("a.host").alias("host"), "text_hash")
        .agg(F.sum("words").alias("all"), left.alias("left"))
        .where(F.col("left") < MIN_LEFT * F.col("all"))
        .select("host", "text_hash")
    )


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every row."""
    counts = measured(docs.select("doc_id", "source", "text").withColumn("_hash", _text_hash(F.col("text")))).drop("text")
    worn = depleted_texts(docs).withColumn("worn", F.lit(True))
    same = F.col("a.source").eqNullSafe(F.col("b.host")) & (F.col("_hash") == F.col("text_hash"))
    return counts.alias("a").join(worn.alias("b"), same, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("worn").isNull()).alias("kept"),
    )


def boilerplate_places(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``host``, ``text_hash``, ``places``, ``n_removed_lines`` and ``n_removed_words`` of the texts
    with boilerplate lines, whose places in the text split at line ends are listed in order.

    Lines are told apart and counted as in ``depleted_texts``: a line in as many texts is judged alike
    at every size of the host.
    """
    lines = _line_rows(docs, text, host)
    ((often, _),) = broadcast_if_small(materialize(_often_held(lines), "often"))
    same_host = F.col("a.host").eqNullSafe(F.col("b.host"))
    found = lines.alias("a").join(often.alias("b"), same_host & (F.col("a.line") == F.col("b.line")))
    return found.groupBy(F.col("a.host").alias("host"), "text_hash").agg(
        F.sort_array(F.collect_list("pos")).alias("places"),
        F.count(F.lit(1)).alias("n_removed_lines"),
        F.sum("words").alias("n_removed_words"),
    )


def removals(docs: DataFrame) -> DataFrame:
    """``doc_id``, what boilerplate lines took, and the length and digest of the text left, of every row."""
    cleaned = without_boilerplate(docs.select("doc_id", "source", "text"))
    return cleaned.select(
        "doc_id",
        *REMOVED,
        F.length("text").cast("bigint").alias("n_left_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("left_sha256"),
    )


def without_boilerplate(docs: DataFrame) -> DataFrame:
    """``docs`` without boilerplate lines in ``text``, the others in order and as they were, with
    ``n_removed_lines`` and ``n_removed_words``, in place of columns of those names.

    ``n_chars``, where there is one, follows the text. Texts without such a line stay untouched, and
    no row is dropped.
    """
    ((found, _),) = broadcast_if_small(materialize(boilerplate_places(docs), "places"))
    return _cleaned(docs.select(F.struct(*docs.columns).alias("doc")), found).select(
        *(F.col("doc")[c].alias(c) for c in docs.columns if c not in REMOVED), *REMOVED
    )


def _cleaned(rows: DataFrame, places: DataFrame) -> DataFrame:
    """``rows`` with documents ``doc`` freed from the lines at ``places``, and what was removed."""
    names, others = rows.schema["doc"].dataType.names, [c for c in rows.columns if c != "doc"]
    same = F.col("a.doc.source").eqNullSafe(F.col("b.host")) & (_text_hash(F.col("a.doc.text")) == F.col("b.text_hash"))
    rows = rows.alias("a").join(places.alias("b"), same, "left").withColumn("_split", F.split("doc.text", "\n"))
    # Split before, so that it is not done again for every line.
    stay = F.array_except(F.sequence(F.lit(0), F.size("_split") - 1), F.col("places"))
    left = F.array_join(F.transform(stay, lambda i: F.get("_split", i)), "\n")
    rows = rows.withColumn("_left", F.when(F.col("places").isNotNull(), left))
    new = {"text": F.coalesce("_left", "doc.text")}
    if "n_chars" in names:
        new["n_chars"] = F.coalesce(F.length("_left").cast("bigint"), "doc.n_chars")
    doc = F.struct(*(new.get(c, F.col("doc")[c]).alias(c) for c in names))
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in REMOVED]
    return rows.select(doc.alias("doc"), *others, *counts)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass the base rules and keep ``MIN_LEFT`` of their words, without their
    boilerplate lines. Columns other than ``text`` and ``n_chars`` stay as they were.

    Lines are those of ``boilerplate_places``.
    """
    ((places, _),) = broadcast_if_small(materialize(boilerplate_places(docs), "places"))
    passed = measured(docs.select(F.struct(*docs.columns).alias("doc"), F.col("text").alias("_text")), "_text")
    passed = passed.where(~F.col("base_failed")).select("doc", F.col("n_words").alias("_n_words"))
    enough = F.col("_n_words") - F.col("n_removed_words") >= MIN_LEFT * F.col("_n_words")
    return _cleaned(passed, places).where(enough).select("doc.*")
