"""Captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.schemas import PAGE_SCHEMA


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet", partitions: int | None = None) -> DataFrame:
    return spread(spark.read.schema(PAGE_SCHEMA).format(fmt).load(path), partitions)


def spread(pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Pages dealt out to so many partitions, or left as they are read without a number.

    Parsing takes far longer than moving the text, so a corpus in a few files that can't
    be split is worth a shuffle; only the caller knows whether it is one.
    """
    return pages.repartition(partitions) if partitions else pages


def bucketed_pages(pages: DataFrame, name: str, buckets: int) -> DataFrame:
    """Captures laid out once, as a table of the catalog in buckets by URL, and read from there.

    Runs that follow choose the newest captures where they stand: their side of the join and
    of the aggregation needs no shuffle. Use as many buckets as shuffle partitions.
    """
    spark = pages.sparkSession
    if not spark.catalog.tableExists(name):
        dealt = pages.repartition(buckets, "requested_url")  # a file for each bucket
        dealt.write.bucketBy(buckets, "requested_url").sortBy("requested_url").saveAsTable(name)
    return spark.table(name)


def as_pages(df: DataFrame, url: str = "url", html: str = "html", captured_at: str | None = None) -> DataFrame:
    """Shape any table of URL and page text as captured pages without redirects."""
    when = F.col(captured_at) if captured_at else F.lit(None)
    return df.select(
        F.col(url).alias("requested_url"),
        F.col(url).alias("final_url"),
        F.col(html).alias("html"),
        when.cast("timestamp_ntz").alias("captured_at"),
    )
