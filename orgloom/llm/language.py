"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent character n-grams, most frequent
first. A document's own profile is compared with each by the out-of-place distance: the
sum over the document's n-grams of how far their ranks lie apart, and the largest rank
for n-grams that a language's profile lacks. The nearest language wins.

An n-gram of up to three characters is one number, 21 bits for each of them; a longer one
(up to ``LONGEST``) is a hash with the sign bit set. So numpy finds and counts those of a
whole text at once. Profiles are counted over all training rows: each
task counts by language and Spark adds the counts up. Only the profiles (``size``
n-grams for each language) reach the driver and the tasks.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so
is every text if there is nothing to learn from; ties go to the language that sorts
first; n-grams with equal counts share a rank, and of those at the end of a document's
profile the ones whose hash is smallest stay; columns named ``lang_pred`` and ``score``
are replaced, other extra columns pass through, whatever their names; an empty table
gives no rows, and empty profiles if it is learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orgloom.llm.common import fold, map_batches, others, table
from orgloom.llm.hashing import mix, signed

PROFILE = 300
#: Characters of the longest n-grams in a profile.
LONGEST = 5
UNKNOWN = "und"
#: Characters of a text worked on at once, and n-grams that a task holds before it counts them.
PIECE = 1_000_000
HELD = 2_000_000
#: What stands for everything between words. No letter has this code point.
BLANK = 1
BITS = 21

_OTHER = re.compile(r"[\W\d_]")


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def pieces(text: str) -> Iterator[str]:
    """The text in parts that end between words."""
    start = 0
    while len(text) - start > PIECE:
        cut = _OTHER.search(text, start + PIECE)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:] if start else text


def grams(text: str, longest: int = 3) -> np.ndarray:
    """The n-grams of up to ``longest`` characters (three at least) of every word between blanks, without the blank itself."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    row = np.full(len(points) + 2, BLANK, np.int64)
    row[1:-1] = np.where(letters()[points], points, BLANK)
    inside = row != BLANK
    stay = inside.copy()
    stay[1:] |= inside[:-1]  # of blanks in a row, the one that ends a word
    stay[0] = True
    row, inside = row[stay], inside[stay]
    if len(row) < 2:
        return row[:0]
    pairs = row[:-1] << BITS | row[1:]
    triples = pairs[:-1] << BITS | row[2:]
    within = inside[1:-1]  # whether nothing between an n-gram's ends is a blank
    out = [row[inside], pairs, triples[within]]
    longer = triples.view(np.uint64)
    for k in range(4, longest + 1):
        if len(row) < k:
            break
        longer = mix(longer[:-1]) ^ row[k - 1 :].view(np.uint64)
        within = within[:-1] & inside[k - 2 : -1]
        out.append(signed(mix(longer[within]) | np.uint64(1 << 63)))
    return np.concatenate(out)


def counted(text: str, longest: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a whole text and their counts."""
    found = [np.unique(grams(piece, longest), return_counts=True) for piece in pieces(text)]
    return added(found) if len(found) > 1 else found[0]


def added(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    names, at = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
    sums = np.zeros(len(names), np.int64)
    np.add.at(sums, at, np.concatenate([n for _, n in found]))
    return names, sums


def learn(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """lang, gram, place (from 0) of every language's ``size`` most frequent n-grams.

    ``docs`` has text and lang; rows without either teach nothing.
    """

    def make():
        def count(batch: pa.RecordBatch) -> dict | None:
            held: dict[str, list[np.ndarray]] = {}
            sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
            size_of: dict[str, int] = {}

            def flush(lang: str) -> None:
                new = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
                sums[lang] = added([sums[lang], new]) if lang in sums else new
                size_of[lang] = 0

            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                for piece in pieces(text):
                    found = grams(piece, LONGEST)
                    held.setdefault(lang, []).append(found)
                    size_of[lang] = size_of.get(lang, 0) + len(found)
                    if size_of[lang] > HELD:
                        flush(lang)
            for lang in list(held):
                flush(lang)
            return {
                "lang": [lang for lang, (names, _) in sums.items() for _ in range(len(names))],
                "gram": pa.array(np.concatenate([x for x, _ in sums.values()]), pa.int64()),
                "n": pa.array(np.concatenate([n for _, n in sums.values()]), pa.int64()),
            }

        return count

    used = docs.select("text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = map_batches(used, make, "lang string, gram long, n long")
    sums = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    first = sums.withColumn("rank", rank).filter(F.col("rank") <= size)  # cut in every task before the shuffle
    return first.select("lang", "gram", (F.col("rank") - 1).alias("place"))


class Profiles:
    """The learned profiles: each language's place for every n-gram that any of them has."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        self.size = size
        self.langs = sorted({lang for lang, _, _ in rows})
        self.known = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        self.places = np.full((len(self.langs), len(self.known) + 1), -1, np.int64)  # the last column: in no profile
        for lang, gram, place in rows:
            self.places[self.langs.index(lang), np.searchsorted(self.known, gram)] = place

    def predict(self, text: str | None) -> tuple[str, float]:
        names, n = counted(text, LONGEST) if text and self.langs else ((), ())
        if not len(names):
            return UNKNOWN, 0.0
        if len(n) > self.size:
            keep = n >= np.partition(n, -self.size)[-self.size]
            names, n = names[keep], n[keep]
            if len(n) > self.size:
                order = np.lexsort((mix(names.view(np.uint64)), -n))[: self.size]
                names, n = names[order], n[order]
        ranks = np.searchsorted(np.sort(-n), -n)
        at = np.searchsorted(self.known, names)
        there = self.known[np.minimum(at, len(self.known) - 1)] == names
        places = self.places[:, np.where(there, at, len(self.known))]
        distance = np.where(places < 0, self.size, np.abs(places - ranks)).sum(axis=1)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.size * len(names)))


def identify(docs: DataFrame, profiles: DataFrame, size: int = PROFILE) -> DataFrame:
    """docs' columns besides text, with ``lang_pred`` and ``score`` (1 less the distance as a part of the largest)."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(
        Profiles([(r.lang, r.gram, r.place) for r in profiles.orderBy("lang", "place").collect()], size)
    )
    kept = others(docs, ("text", "lang_pred", "score"))

    names = list(kept)

    def make():
        predict = model.value.predict

        def run(batch: pa.RecordBatch) -> dict:
            found = [predict(text) for text in batch["text"].to_pylist()]
            return {c: batch[c] for c in names} | {
                "lang_pred": [x for x, _ in found],
                "score": [min(1.0, max(0.0, x)) for _, x in found],
            }

        return run

    schema = docs.select(*kept.values(), F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"))
    return map_batches(docs, make, schema.schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = fold("doc_id", 4)
    profiles = learn(docs.filter(part != 2))
    found = identify(docs.select("doc_id", "text", (part == 2).alias("held_out")), profiles)
    return found.select("doc_id", "held_out", "lang_pred", "score")
