"""From raw documents to a training mix, in five stages over the operators of ``orgloom.llm``.

Each stage takes what its predecessor kept and returns it as a table of documents; its
result is written as Parquet and read again before the next. All columns of documents,
whatever their names, pass through every stage; ``mix`` adds its own and replaces such
of the same names. Empty tables give empty ones.

* ``quality`` drops documents that the classifier, learned outside the held-out fold,
  predicts to be bad.
* ``near_duplicates`` keeps one document of each component of the Jaccard join (five
  words, four fifths alike).
* ``decontamination`` drops documents of which a twentieth or more is benchmark text.
* ``personal_data`` puts a mark in place of every span found; no document goes.
* ``mix`` emits each document as often as its source's target asks for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orgloom.llm import decontam, jaccard, mixing, pii, quality
from orgloom.llm.common import staged, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.learned(table(spark, sf_dir, "documents"), spark, sf_dir)
    return quality.accepted(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, words=5, percent=80)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs, pii.fit(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmarks),
    ("personal_data", without_personal_data),
    ("mix", mixed),
]

#: A learned classifier and spans can't be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return staged(STAGES[-1][1](spark, docs, sf_dir), "pipeline-mix")
