"""Incremental extraction: each captured page is parsed once, in the run that first sees it."""

from __future__ import annotations

import os
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.plans.extraction import extract_datasets, page_facts, write_datasets
from orgloom.schemas import PAGE_SCHEMA, ExtractionSpec
from orgloom.sinks.publish import publication, published

_TIME = "_batch_time"


def collect_facts(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    spec: ExtractionSpec | None = None,
    pages_format: str = "parquet",
    files_per_batch: int = 1000,
) -> None:
    """Parse the pages that are new in ``landing`` and keep their facts in ``store``.

    The checkpoint remembers the files seen. Every batch is an append that counts as a
    whole, under the batch's own name, so a rerun after a stop neither loses nor repeats
    one. Which capture of a URL is the newest is settled when the facts are read: they
    are narrow rows, so that costs little, and captures may come in any order. Pages of
    no known kind are not parsed.
    """
    spec = spec or ExtractionSpec()
    stream: Future[str] = Future()  # known when the query has started; a checkpoint keeps it

    def keep(batch: DataFrame, number: int) -> None:
        began = batch.select(F.unix_micros(_TIME)).first()
        if began is None:
            return
        with publication(spark, store, name=f"{began[0] * 1000:020d}-{stream.result()}-{number:012d}") as folder:
            page_facts(batch.drop(_TIME), spec, spec.suffixes).write.parquet(os.path.join(folder, "facts"))

    query = (
        spark.readStream.schema(PAGE_SCHEMA)
        .format(pages_format)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .load(landing)
        .withColumn(_TIME, F.current_timestamp())  # that of the batch, also when it runs again
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.set_result(query.id)
    query.awaitTermination()


def stored_facts(spark: SparkSession, store: str, spec: ExtractionSpec | None = None) -> DataFrame:
    """The facts of all captures seen so far."""
    none = spark.createDataFrame([], PAGE_SCHEMA)
    schema = page_facts(none, spec or ExtractionSpec()).schema
    paths = [os.path.join(a, "facts") for a in published(spark, store).appends]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def extract_new(
    orgs: DataFrame,
    landing: str,
    store: str,
    checkpoint: str,
    out_dir: str,
    run_ts: str,
    spec: ExtractionSpec | None = None,
    **options: bool,
) -> dict[str, str]:
    """Parse what is new, then write the five record datasets of all organisations anew."""
    spark = orgs.sparkSession
    collect_facts(spark, landing, store, checkpoint, spec)
    facts = stored_facts(spark, store, spec)
    return write_datasets(extract_datasets(orgs, facts, run_ts, spec, **options), out_dir)
