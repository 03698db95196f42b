"""JSON record datasets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgloom.schemas import Dataset
from orgloom.sinks.publish import STAMP, published
from orgloom.sources.framing import framed, pieces

# End of one top-level record in an array written with an indent of four, whatever the
# line ends are. Line ends inside JSON texts are escaped and deeper levels are indented
# further, so nothing else in such a file looks like this.
INDENTED_RECORD_END = "\n    },"

ORDER_TYPE = "struct<append:string,part:bigint,file:string,block:bigint,row:bigint,pos:int>"

# A missing name may be written as a bare NaN, which reads as text: the file reader
# gives it plain, the text parser in quotes.
NAN_COLUMNS = ("input_company_name", "Company Name")
NAN_TEXTS = ("NaN", '"NaN"')


def read_records(
    spark: SparkSession,
    path: str,
    dataset: Dataset,
    layout: str = "lines",
    with_order: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Records of one dataset under their JSON keys, the list field as variant.

    ``layout`` is ``lines`` (one record per line), ``indented`` (one array, indent
    four; split at record ends) or ``array`` (one array in any shape; split at braces,
    whose meaning is worked out first). In all of them many tasks share a large file.
    ``with_order`` adds ``record_order``, which sorts like the records in the files, and
    those of an earlier append before those of a later one.
    Broken JSON stops the job, as it would any JSON reader; ``mode="PERMISSIVE"``
    lets such records through as empty ones.
    """
    schema = dataset.record_schema()
    paths = published(spark, path).paths
    if not paths:  # no append has come to its end yet
        return _no_records(spark, schema, with_order)
    reader = spark.read.option("mode", mode).option("recursiveFileLookup", True)
    if layout == "lines":
        rows = reader.schema(schema).json(paths)
    elif layout == "array":
        return _without_nan(_parse_array(framed(pieces(spark, paths, "json"), "json"), schema, mode, with_order))
    elif layout == "indented":
        rows = spark.read.option("recursiveFileLookup", True).option("lineSep", INDENTED_RECORD_END).text(paths)
    else:
        raise ValueError(f"unknown layout {layout!r}")

    # Within one block rows are numbered in reading order, across blocks by place.
    file = F.col("_metadata.file_path")
    place = [
        F.regexp_extract(file, STAMP, 1).alias("append"),
        F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).try_cast("bigint").alias("part"),
        file.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ]
    order = [F.struct(*place, F.lit(0).alias("pos")).alias("record_order")] if with_order else []
    rows = rows.select("*", *order)
    if layout == "indented":
        rows = _parse_indented(rows, schema, mode)
    return _without_nan(rows)


def _without_nan(rows: DataFrame) -> DataFrame:
    return rows.select(
        *(
            F.when(~F.col(f"`{c}`").isin(*NAN_TEXTS), F.col(f"`{c}`")).alias(c)
            if c in NAN_COLUMNS
            else F.col(f"`{c}`")
            for c in rows.columns
        )
    )


def _parse_array(found: DataFrame, schema: T.StructType, mode: str, with_order: bool) -> DataFrame:
    """Records of arrays in any shape, from what stands up to the end of each."""
    text = F.decode("record", "UTF-8")
    body = F.regexp_replace(text, r"\A\x{FEFF}?[\s,\[]*", "")  # what stands before a record
    order = F.struct(
        F.regexp_extract("file", STAMP, 1).alias("append"),
        F.regexp_extract("file", r"/part-(\d+)[^/]*$", 1).try_cast("bigint").alias("part"),
        "file", "block", "row", F.lit(0).alias("pos"),
    )
    kept = found.select(body.alias("body"), order.alias("record_order")).filter(~F.col("body").rlike(r"\A[\s\]]*\}?\z"))
    parsed = kept.select(F.inline(F.array(F.from_json("body", schema, {"mode": mode}))), "record_order")
    return parsed if with_order else parsed.drop("record_order")


def _parse_indented(chunks: DataFrame, schema: T.StructType, mode: str) -> DataFrame:
    """Records of the chunks between record ends.

    The last chunk of a file has the end of the array instead. A file whose records
    end otherwise, say with another indent, is a single chunk with all its records.
    """
    text = F.regexp_replace("value", r"\A\s*\[", "")
    is_last = text.rlike(r"[\n}]\]\s*\z")
    body = F.when(is_last, F.regexp_replace(text, r"\]\s*\z", "")).otherwise(F.concat(text, F.lit("}")))
    parsed = F.from_json(F.concat(F.lit("["), body, F.lit("]")), T.ArrayType(schema), {"mode": mode})
    # inlining the expression itself, not a column with it, makes sure it is parsed once
    numbered = F.transform(
        parsed, lambda r, pos: F.struct(*(r[f.name].alias(f.name) for f in schema.fields), pos.alias("pos"))
    )
    order = [c for c in chunks.columns if c == "record_order"]
    records = chunks.filter(F.col("value").contains("{")).select(*order, F.inline(numbered))
    if order:
        records = records.withColumn("record_order", F.col("record_order").withField("pos", F.col("pos")))
    return records.select(*(f"`{name}`" for name in schema.names), *order)


def read_optional(
    spark: SparkSession,
    path: str,
    dataset: Dataset,
    layout: str = "lines",
    with_order: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Like ``read_records``, but empty when the dataset is not there."""
    try:
        return read_records(spark, path, dataset, layout, with_order, mode)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _no_records(spark, dataset.record_schema(), with_order)


def _no_records(spark: SparkSession, schema: T.StructType, with_order: bool) -> DataFrame:
    empty = spark.createDataFrame([], schema)
    return empty.withColumn("record_order", F.lit(None).cast(ORDER_TYPE)) if with_order else empty
