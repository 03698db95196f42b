"""Numbering rows by their place without gathering them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Blocks up to which their offsets are broadcast; more are joined like any table.
MAX_BROADCAST = 100_000
#: Rows beyond which a range of sorted rows is split, and rows that are worth a range of their own.
MAX_RANGE_ROWS, MIN_RANGE_ROWS = 50_000, 1_000


def file_place(row: str = "row") -> list:
    """The place of a row in the files being read: file, block, and a number that grows within the block."""
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias(row),
    ]


def written_place() -> list:
    """The place of a row in files that Spark has written: number of the part, block, and a number that grows within it."""
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).try_cast("bigint")
    return [part.alias("part"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")]


def dense_numbers(rows: DataFrame, block: Sequence[str], row: str = "row", name: str = "position") -> DataFrame:
    """``rows`` numbered from 0 on without gaps, by block and then by ``row``.

    The numbers of a block's rows must follow on each other, as those of rows read together
    do. Rows are counted by block, the counts added up (one row for each block: some per
    file), and each row gets its block's offset plus its place in the block. ``rows`` are
    read twice, so give a stored table.
    """
    spans = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"), F.min(row).alias("_first"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select(*block, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    if offsets.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        offsets = F.broadcast(offsets)
    numbered = rows.join(offsets, list(block))
    number = F.col("_offset") + F.col(row) - F.col("_first")
    return numbered.select(*(F.col(f"`{c}`") for c in rows.columns if c not in (*block, row)), number.alias(name))


def n_ranges(n_rows: int, cores: int) -> int:
    """Ranges for so many rows: one for each core if they are enough for that, and none of very many rows."""
    return max(1, math.ceil(n_rows / MAX_RANGE_ROWS), min(cores, math.ceil(n_rows / MIN_RANGE_ROWS)))


def in_order(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` so dealt out and sorted that files written of them, by number, are in this order.

    Spark draws some hundred keys for each range and sends them to the driver, so the ranges
    follow from the number of rows: with as many as there are shuffle partitions, that would
    be all keys of a table of 60,000 rows. ``rows`` are read more than once.
    """
    n = n_ranges(rows.count(), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartitionByRange(n, by).sortWithinPartitions(by)
