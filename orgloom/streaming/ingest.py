"""Incremental append: each landed record file reaches the store exactly once."""

from __future__ import annotations

import os
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgloom.schemas import Dataset
from orgloom.sinks.publish import publication

_BROKEN, _TIME = "_broken_line", "_batch_time"


def ingest_records(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    dataset: Dataset,
    files_per_batch: int = 1000,
    rejects: str | None = None,
) -> None:
    """Move what is new in ``landing`` (JSON Lines) to ``store`` and stop.

    The checkpoint remembers the files seen, so a rerun after a failure or with new
    files neither loses nor repeats records: every batch is an append of its own, named
    after the batch's time (which the checkpoint keeps), the checkpoint's stream and the batch,
    and takes the place of what a stopped run has left of it. Other appends to the store,
    also by ingests with other checkpoints, stay visible, and all sort by their times.
    Lines that are no records go to ``rejects`` (beside the store if not given) instead of
    stopping each later run. All files below ``landing`` count, whoever wrote them.
    """
    rejects = rejects or f"{store.rstrip('/')}.rejects"
    stream: Future[str] = Future()  # known when the query has started; a checkpoint keeps it
    schema = T.StructType([*dataset.record_schema().fields, T.StructField(_BROKEN, T.StringType())])

    def keep(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        began = batch.select(F.unix_micros(_TIME)).first()
        if began is not None:
            name = f"{began[0] * 1000:020d}-{stream.result()}-{number:012d}"
            good = batch.filter(F.col(_BROKEN).isNull()).drop(_BROKEN, _TIME)
            broken = batch.filter(F.col(_BROKEN).isNotNull()).select(F.col(_BROKEN).alias("value"))
            if not broken.isEmpty():
                broken.write.mode("overwrite").text(os.path.join(rejects, f"ingest-{name}"))
            with publication(spark, store, name=name) as folder:
                good.write.mode("overwrite").json(folder)
        batch.unpersist()

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", _BROKEN)
        .json(landing)
        .withColumn(_TIME, F.current_timestamp())  # that of the batch, also when it runs again
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.set_result(query.id)
    query.awaitTermination()
