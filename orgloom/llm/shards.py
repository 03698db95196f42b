"""Sharding by jump consistent hashing, in DataFrame functions only.

A row's stable key is hashed to 64 bits, and a walk of that number through a linear
congruence gives the shards at which the row would move as shards are appended one by one:
the last of them below the number of shards is its shard. No table of a ring is held, and
one more shard takes its share of the rows and moves none between the others. The walk is
an aggregation over a short sequence; numbers of 64 bits without a sign are decimals,
because products of them go beyond a long.

``write_shards`` writes a table as one folder for each shard. Rows are dealt out by range
of (shard, key, order, place), so that a shard of any size, and a key of any number of
rows, is several files; a row's ``slot``, its place in its shard, is its file's offset plus
its place in the file. Offsets come from one count for each file. Nothing is numbered in
one task, and slots stand in the written files, so a lost executor can't change them.

Defined results: a missing key counts as an empty one (all such rows are in one shard);
a null text has 0 bytes; equal rows get slots of their own, in any order among themselves; an empty
table gives no rows and no folders; columns of the table that are named like the added
ones are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgloom.functions.values import let
from orgloom.llm.common import n_partitions, others, quoted, small, staged, table
from orgloom.session import work_dir

SHARDS = 8
#: The published algorithm's congruence.
FACTOR, MODULUS = 2862933555777941757, 1 << 64
ADDED = ("shard", "grown_shard", "slot")


def key_number(key: Column) -> Column:
    """64 bits without a sign from a key's text, the same on any engine that has md5."""
    text = F.coalesce(key.cast("string"), F.lit("")).cast("binary")
    return F.conv(F.substring(F.md5(text), 1, 16), 16, 10).cast("decimal(20,0)")


def jump(number: Column, shards: int) -> Column:
    """shard, among ``shards``, and next: the number of the shard, once there, that takes the row away."""
    factor, modulus, high = (F.lit(str(x)).cast("decimal(20,0)") for x in (FACTOR, MODULUS, 1 << 33))

    def moved(state: Column) -> Column:
        k = ((state["k"] * factor + 1) % modulus).cast("decimal(20,0)")

        def after(k: Column) -> Column:
            top = ((k - k % high) / high).cast("long") + 1  # exact: the upper 31 bits
            following = F.floor((state["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / top.cast("double")))
            return F.struct(k.alias("k"), state["j"].alias("b"), following.cast("long").alias("j"))

        return let(k, after)

    def walk(start: Column, steps: int) -> Column:
        numbers = F.sequence(F.lit(1), F.lit(steps))
        return F.aggregate(numbers, start, lambda state, _: F.when(state["j"] < shards, moved(state)).otherwise(state))

    first = F.struct(number.cast("decimal(20,0)").alias("k"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    usual = min(shards, 16 + 4 * math.ceil(math.log(shards + 1)))
    # Next to no row moves more often than that; the walk never takes more steps than there are shards.
    whole = let(walk(first, usual), lambda s: F.when(s["j"] < shards, walk(s, shards)).otherwise(s) if usual < shards else s)
    return let(whole, lambda s: F.struct(s["b"].cast("int").alias("shard"), s["j"].alias("next")))


def placed(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """``docs`` with shard and grown_shard, where the row is with one more; no row moves between tasks."""
    rest = others(docs, ADDED)
    found = jump(key_number(F.col(quoted(key))), shards)
    grown = F.when(F.col("_at.next") == shards, F.lit(shards)).otherwise(F.col("_at.shard"))
    # a struct of all columns, so that none of them can be named like the helper
    held = docs.select(F.struct(*rest.values()).alias("row"), found.alias("_at"))
    kept = (F.col("row").getField(c).alias(c) for c in rest)
    return held.select(*kept, F.col("_at.shard").alias("shard"), grown.alias("grown_shard"))


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id", order: Sequence[str | Column] = ()
) -> DataFrame:
    """Write ``docs`` below ``path``, a folder for each shard, and return it with shard, grown_shard and slot.

    Rows are ordered by key and then by ``order``, names of columns or expressions of them;
    rows alike in these stand in any order and may be in several files. ``docs`` is read
    more than once: store what is dear.
    """
    rows = placed(docs, shards, key)
    place = "_place"
    while place in rows.columns:
        place = "_" + place
    by = [F.col("shard"), F.col(quoted(key)), *(F.col(quoted(c)) if isinstance(c, str) else c for c in order), F.col(place)]
    dealt = rows.withColumn(place, F.monotonically_increasing_id()).repartitionByRange(n_partitions(docs), *by)
    sorted_rows = dealt.sortWithinPartitions(*by).drop(place)
    sorted_rows.write.partitionBy("shard").parquet(path)
    return read_shards(docs.sparkSession, path, sorted_rows.schema)


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Written shards with each row's slot."""
    stored = spark.read.schema(schema).parquet(path)
    file = "_metadata.file_name"
    counts = stored.groupBy("shard", F.col(file).alias("file")).agg(F.count("*").alias("n"))
    # one row for each file; names hold the number of the range, with five digits or more
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    before = Window.partitionBy("shard").orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    offsets = offsets.select(F.col("shard").alias("_of"), F.col("file").alias("_file"), F.col("offset").alias("_offset"))
    rest = others(stored, ADDED)
    slot = F.col("_offset") + F.col("_index")
    held = stored.select(
        F.struct(*rest.values()).alias("row"), "shard", "grown_shard", F.col(file).alias("_name"), F.col("_metadata.row_index").alias("_index")
    )
    joined = held.join(small(staged(offsets, "offsets")), (F.col("shard") == F.col("_of")) & (F.col("_name") == F.col("_file")))
    return joined.select(*(F.col("row").getField(c).alias(c) for c in rest), "shard", "grown_shard", slot.alias("slot"))


def _measures() -> tuple[Column, Column]:
    text = F.coalesce("text", F.lit(""))
    return (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size (bytes of the text and one) and text_crc32 of each document."""
    return docs.select("doc_id", *_measures())


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents are written into shards; size and checksum are those of the texts read back."""
    size, checksum = _measures()
    made = write_shards(table(spark, sf_dir, "documents"), work_dir(spark, "shards"), order=[checksum, size])
    return made.select("doc_id", *_measures(), F.lit("key").alias("law"), "shard", "slot", "grown_shard")


#: DuckDB has no crc32: the polynomial's table is built, and each text folded over it.
ORACLE = f"""
WITH RECURSIVE bits(v, c, step) AS (
    SELECT v, CAST(v AS UBIGINT), 0 FROM range(256) t(v)
    UNION ALL
    SELECT v, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, step + 1
    FROM bits WHERE step < 8
), folded AS (SELECT list(c ORDER BY v) AS crcs FROM bits WHERE step = 8
), texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), bytes AS (
    SELECT doc_id, CAST(octet_length(encode(t)) + 1 AS BIGINT) AS size,
           list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS UBIGINT)) AS b
    FROM texts
), sized AS (
    SELECT doc_id, size, CAST(xor(list_reduce(b,
               lambda crc, x: xor(crc >> 8, crcs[CAST(xor(crc, x) & 255 AS INT) + 1]), 4294967295::UBIGINT),
               4294967295::UBIGINT) AS BIGINT) AS text_crc32
    FROM bytes, folded
), walk(doc_id, k, b, j) AS (
    SELECT DISTINCT doc_id,
           CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS UBIGINT) AS HUGEINT),
           CAST(-1 AS BIGINT), CAST(0 AS BIGINT)
    FROM documents
    UNION ALL
    SELECT doc_id, k2, j, CAST(floor((j + 1) * (2147483648.0::DOUBLE / CAST(k2 // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
    FROM (SELECT *, (k * {FACTOR}::HUGEINT + 1) % {MODULUS}::HUGEINT AS k2 FROM walk WHERE j < {SHARDS})
), shards AS (
    SELECT doc_id, CAST(b AS INTEGER) AS shard, CAST(CASE WHEN j = {SHARDS} THEN {SHARDS} ELSE b END AS INTEGER) AS grown_shard
    FROM walk WHERE j >= {SHARDS}
)
SELECT s.doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY s.doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM sized s JOIN shards k ON s.doc_id IS NOT DISTINCT FROM k.doc_id
"""
