"""Finding each target's capture without letting hot URLs pile up in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SPLIT = 200_000
#: Hot URLs up to which their list is broadcast; a longer one is joined like any table.
MAX_BROADCAST = 100_000
#: Rows that a key filter may have at most, each of two numbers: what is broadcast is below 64 MB.
FILTER_WORDS = 1 << 21


def latest_capture(captures: DataFrame, key: str = "requested_url") -> DataFrame:
    """The newest capture per URL.

    ``max_by`` combines on the map side, so any number of copies of one URL leaves
    each task as one row. Run it on extracted facts rather than on page text.
    """
    others = [c for c in captures.columns if c != key]
    newest = F.struct(*(c for c in ("captured_at", "final_url", "capture_hash") if c in others))
    return (
        captures.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(*others), newest).alias("capture"))
        .select(key, "capture.*")
    )


def hot_keys(df: DataFrame, key: str, rows_per_split: int) -> DataFrame:
    """hash and splits of every key with more than ``rows_per_split`` rows.

    Rows are counted on the map side first, so a hot key leaves each task as one row.
    There is at most one row for each ``rows_per_split`` rows of the input. A hash stands
    for the key: keys that share one are split alike on both sides of a join.
    """
    counts = df.groupBy(F.xxhash64(key).alias("_hash")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > rows_per_split).select(
        "_hash", F.ceil(F.col("n") / rows_per_split).cast("bigint").alias("_splits")
    )


def lookup(
    targets: DataFrame,
    captures: DataFrame,
    target_key: str = "target_url",
    capture_key: str = "requested_url",
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Left join of the targets with captures that are unique per URL.

    Every URL with more than ``rows_per_split`` targets is spread, see ``spread_lookup``.
    Without one this is a plain join that keeps the partitioning the captures already
    have; both give the same rows.
    """
    hot = hot_keys(targets, target_key, rows_per_split)
    if hot.isEmpty():
        return targets.join(captures, F.col(target_key) == F.col(capture_key), "left")
    return spread_lookup(targets, captures, target_key, capture_key, hot)


def spread_lookup(
    targets: DataFrame, captures: DataFrame, target_key: str, capture_key: str, hot: DataFrame
) -> DataFrame:
    """The same join with every hot URL shared among several splits.

    A target row goes to a split by its content and by the input partition it is in,
    so equal rows spread as well, and a task that runs again gives the same rows. The
    URL's single capture is repeated once per split. Other URLs are one split each.
    """
    splits_of = F.broadcast(hot) if hot.count() <= MAX_BROADCAST else hot
    splits = F.coalesce("_splits", F.lit(1).cast("bigint"))
    place = F.pmod(F.xxhash64(*targets.columns), splits) + F.spark_partition_id()

    left = (
        targets.withColumn("_hash", F.xxhash64(target_key))
        .join(splits_of, "_hash", "left")
        .withColumn("_split", F.pmod(place, splits))
        .drop("_hash", "_splits")
    )
    right = (
        captures.withColumn("_hash", F.xxhash64(capture_key))
        .join(splits_of, "_hash", "left")
        .withColumn("_capture_split", F.explode(F.sequence(F.lit(0).cast("bigint"), splits - 1)))
        .drop("_hash", "_splits")
    )
    matches = (F.col(target_key) == F.col(capture_key)) & (F.col("_split") == F.col("_capture_split"))
    return left.join(right, matches, "left").drop("_split", "_capture_split")


def _place_and_mask(columns: Sequence[str], words: int) -> tuple[Column, Column]:
    """The word of 64 bits that a key belongs to, and the four bits (or fewer) that are set there."""
    spread = F.xxhash64(*columns, F.lit("bits"))
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(spread, 6 * i).bitwiseAND(63).cast("int")) for i in range(4)]
    return F.pmod(F.xxhash64(*columns), F.lit(words).cast("bigint")), reduce(Column.bitwiseOR, bits)


def key_filter(keys: DataFrame, columns: Sequence[str], words: int = FILTER_WORDS) -> DataFrame:
    """A filter of bounded size (word, bits) that knows all rows of ``keys`` by these columns.

    However many keys there are, it has at most ``words`` rows; with more keys than that
    it lets more strangers pass, but never holds back a key.
    """
    word, mask = _place_and_mask(columns, words)
    return keys.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_bits"))


def probably_known(rows: DataFrame, known: DataFrame, columns: Sequence[str], words: int = FILTER_WORDS) -> DataFrame:
    """The rows whose key the filter knows, and the few it takes for such; nothing is shuffled."""
    word, mask = _place_and_mask(columns, words)
    same = (word == F.col("_word")) & (F.col("_bits").bitwiseAND(mask) == mask)
    return rows.join(F.broadcast(known), same, "left_semi")
