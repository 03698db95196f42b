"""Mixing sources to target weights.

Sizes are added up per source, a repetition rate follows for each source, and every
document is emitted floor(rate) times plus once more with probability equal to the
fraction. The draw comes from a hash of the seed and the document, so reruns agree.

Defined results: a null text has size 0; a null source is a source of its own, placed
last; a source without words has target 0 and rate 0; rows with the same id draw alike
(missing ids too); columns of ``docs`` named like those added here are replaced, all
others pass through; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orgloom.llm.common import WORD, others, plainly_named, quoted, table

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = 20
#: Rows of the table of sources up to which it is broadcast; beyond, a plain join that Spark may split.
BROADCAST_SOURCES = 50_000
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_copies")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """source, source_size, target and rate, from rows of (source, size).

    A target is min(most * size, level * weight) with the one level at which the targets
    add up to the share: what resharing the excess by weight, again and again, ends at.
    The rows here are sources, not documents; sizes are combined before the shuffle.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    ws = F.array(*[F.lit(float(w)) for w in weights])
    weighted = sums.select(
        "source",
        "source_size",
        F.element_at(ws, (place % len(weights) + 1).cast("int")).alias("w"),
        (F.col("source_size") * most).alias("cap"),
    )
    # Sources by the level at which they are full: those before a level are full at it.
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    steps = weighted.select(
        "*",
        (F.col("cap") / F.col("w")).alias("full_at"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
        F.sum("w").over(whole).alias("w_all"),
        F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("w_before"),
        (F.sum("source_size").over(whole) * min(share, most)).alias("total"),
    ).withColumn("level", (F.col("total") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before")))
    # The level is right at the first source that is not full at it.
    level = F.min(F.when(F.col("level") < F.col("full_at"), F.struct("full_at", "source", "level"))).over(whole)["level"]
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("w")))
    return steps.select(
        "source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
    )


def draw(seed: int, column: str = "doc_id") -> Column:
    """A number in [0, 1): the first 52 bits of the md5 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def with_rates(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """docs with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    The documents aren't shuffled while there are few sources; a hot source is then one
    row of the broadcast table. All other columns stay as they are.
    """
    kept = others(docs, ADDED)
    docs = plainly_named(docs.select(*kept.values()), "doc_id", "text", "source")
    key, rate = "mix_source", "mix_rate"
    sized = docs.select(F.col("source"), word_count(F.col("text")).alias("size"))
    targets = source_targets(sized, **options).select(
        F.col("source").alias(key),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        F.col("rate").alias(rate),
    )
    few = docs.select("source").distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    joined = docs.withColumn("mix_size", word_count(F.col("text"))).join(
        F.broadcast(targets) if few else targets, F.col("source").eqNullSafe(F.col(key)), "left"
    )
    whole = F.floor(rate)
    extra = (draw(seed) < F.col(rate) - whole).cast("long")
    return joined.withColumn("mix_copies", whole.cast("long") + extra).drop(key, rate).toDF(*kept, *ADDED)


def mix(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken; ``copy`` numbers the copies from 1."""
    rated = with_rates(docs.select(*others(docs, ["copy"]).values()), seed, **options).filter(F.col("mix_copies") > 0)
    names = map(quoted, rated.columns)  # ``copy`` has been left out
    return rated.select(*names, F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))).alias("copy"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return with_rates(docs.select("doc_id", "text", "source")).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
        F.col("mix_copies").alias("copies"),
    )


ORACLE = f"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
    SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
        CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w
    FROM sums
), steps AS (
    SELECT *, cap / w AS full_at,
        coalesce(sum(cap) OVER before, 0.0) AS cap_before, coalesce(sum(w) OVER before, 0.0) AS w_before,
        sum(w) OVER () AS w_all, sum(source_size) OVER () * 1.5::DOUBLE AS total
    FROM weighted
    WINDOW before AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT arg_min(l, (full_at, source)) AS level
    FROM (SELECT *, (total - cap_before) / (w_all - w_before) AS l FROM steps) WHERE l < full_at
), targets AS (
    SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS target
    FROM steps, level
), taken AS (
    SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), copied AS (
    SELECT *, (floor(rate) + CASE WHEN ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
        < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
    FROM taken
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM copied
"""
