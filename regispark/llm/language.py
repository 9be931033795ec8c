"""Language identification by rank-order profiles.

A profile lists a language's most frequent n-grams by rank. A document's own most frequent n-grams
are ranked in the same way; its distance to a profile is the sum, over its n-grams, of how far
each is out of place, an n-gram that the profile lacks counting as ``len(profile)`` places.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regispark.llm.frames import ship, small_batches

#: Longest n-gram, in letters and word ends.
LONGEST = 3
#: N-grams of a language's profile, and of a document that are compared with it.
PROFILE = 400
RANKED = 300
#: Languages that are learned, at most: those with the most labelled documents.
LANGUAGES = 512
#: A stage's cut: this part of the score that all but ``LOW`` of a language's training documents reach.
#: Texts in other languages and scripts stay below it, short and damaged ones of its own above.
CUT = 2 / 3
LOW = 0.01
UNKNOWN = "und"
#: Stands for a word's end; no letter, and not 0, so that n-grams of unlike lengths are unlike numbers.
END = 1
BITS = 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter or a mark that goes with one."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(sys.maxunicode + 1)), bool)


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the whole text as numbers, and their counts.

    Lower-cased; all that is no letter is a word end. N-grams stay within a word and its two ends.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    points = np.where(_letters()[points], points, END) if len(points) else points
    points = np.concatenate(([END], points, [END]))
    points = points[np.concatenate(([True], (points[1:] != END) | (points[:-1] != END)))]
    if len(points) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    grams = [points[points != END]]
    codes = points
    for n in range(2, LONGEST + 1):
        codes = codes[:-1] << BITS | points[n - 1 :]
        inner = np.ones(len(codes), bool)
        for k in range(1, n - 1):
            inner &= points[k : k + len(codes)] != END
        grams.append(codes[inner])
    return np.unique(np.concatenate(grams), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams, by falling count and then by number."""
    if len(codes) > 4 * most:
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))[:most]]


class Profiles:
    """Ranks of n-grams in the languages' profiles, as one table."""

    def __init__(self, by_language: Mapping[str, np.ndarray], size: int):
        self.languages = sorted(by_language)
        self.size = size
        self.codes = np.unique(np.concatenate([np.empty(0, np.int64), *by_language.values()])).astype(np.int64)
        self.rank = np.full((len(self.codes) + 1, len(self.languages)), -1)
        for k, language in enumerate(self.languages):
            own = by_language[language]
            self.rank[np.searchsorted(self.codes, own), k] = np.arange(len(own))

    def predict(self, text: str | None, most: int = RANKED) -> tuple[str, float]:
        """Nearest language, ties by name, and 1 minus its distance as a part of the largest one."""
        codes, counts = ngrams(text or "")
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0
        own = ranked(codes, counts, most)
        at = np.minimum(np.searchsorted(self.codes, own), max(len(self.codes) - 1, 0))
        at = np.where(self.codes[at] == own, at, len(self.codes))
        rank = self.rank[at]
        places = np.abs(rank - np.arange(len(own))[:, None])
        distance = np.where(rank < 0, self.size, np.minimum(places, self.size)).sum(0)
        best = int(distance.argmin())
        return self.languages[best], float(1 - distance[best] / (self.size * len(own)))


def held_out(id: str) -> Column:
    """Whether a document is kept from learning; one without an id is."""
    rest = F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(5))
    return F.coalesce(rest == 0, F.lit(True))


def training(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang`` and ``text`` of all labelled documents that are not held out, in the ``LANGUAGES`` with the most
    of them: what is learned and broadcast is bounded for any column of labels."""
    labelled = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        ~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    share = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")).orderBy(F.desc("docs"), "lang").limit(LANGUAGES)
    return labelled.join(F.broadcast(share.select("lang")), "lang").select("lang", "text")


def learn(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of the languages of labelled documents that are not held out, from all of these.

    Counts are summed by Spark; the model and what the driver gets stay bounded.
    """
    return learn_from(training(docs, id, text, lang))


def learn_from(known: DataFrame) -> Profiles:
    """Profiles of the languages of documents with ``lang`` and ``text``."""
    ship(known.sparkSession)
    small_batches(known.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for language, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(language, []).append(ngrams(whole))
            for language, several in found.items():
                every, at = np.unique(np.concatenate([codes for codes, _ in several]), return_inverse=True)
                counts = np.zeros(len(every), np.int64)
                np.add.at(counts, at, np.concatenate([counts for _, counts in several]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(every), pa.string()), pa.array(every, pa.int64()), pa.array(counts)],
                    ["lang", "code", "n"],
                )

    grams = known.select("lang", "text").mapInArrow(count, "lang string, code bigint, n bigint")
    summed = grams.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = summed.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= PROFILE)
    found: dict[str, list[tuple[int, int]]] = {}
    for row in top.collect():
        found.setdefault(row["lang"], []).append((row["rank"], row["code"]))
    return Profiles({k: np.array([c for _, c in sorted(v)], np.int64) for k, v in found.items()}, PROFILE)


def predict(
    docs: DataFrame, profiles: Profiles, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1), in place of columns of those names.

    The whole text counts. A null text, or one without a letter, is ``und`` with score 0, as is
    every text when there was nothing to learn from. One pass without a shuffle.
    """
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    others = [c for c in docs.columns if c not in into]
    place = others.index(text)
    schema = docs.select(others).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t) for t in batch.column(place).to_pylist()]
            columns = [
                *batch.columns,
                pa.array([language for language, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*others, *into])

    out = schema.add(into[0], "string").add(into[1], "double")
    return docs.select(others).mapInArrow(run, out)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row; only ``text`` is looked at."""
    found = predict(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def cuts(known: DataFrame, profiles: Profiles) -> dict[str, float]:
    """For each language, ``CUT`` of the score that all but ``LOW`` of its documents reach when they
    are told to be in it."""
    found = predict(known.select("lang", "text"), profiles).where(F.col("lang") == F.col("lang_pred"))
    reached = found.groupBy("lang").agg(F.percentile("score", F.lit(LOW)).alias("score"))
    return {r["lang"]: CUT * r["score"] for r in reached.collect()}


def _free(name: str, taken: list[str]) -> str:
    return name if name not in taken else _free(f"_{name}", taken)


def keep_identified(docs: DataFrame, least: float = 0.0, cut: bool = False) -> DataFrame:
    """Documents with a language and a score of ``least`` or more, with their columns as they were.

    With ``cut``, a score must also be above 0 and reach its language's ``cuts``: texts in a language
    or script that was not learned go.
    """
    known = training(docs)
    profiles = learn_from(known)
    lang, score = _free("_lang", docs.columns), _free("_score", docs.columns)
    found = predict(docs, profiles, into=(lang, score))
    kept = (F.col(lang) != UNKNOWN) & (F.col(score) >= least)
    if cut:
        by_language = [F.when(F.col(lang) == k, F.lit(v)) for k, v in sorted(cuts(known, profiles).items())]
        kept &= (F.col(score) > 0) & (F.col(score) >= F.coalesce(*by_language, F.lit(0.0)))
    return found.where(kept).select(docs.columns)
