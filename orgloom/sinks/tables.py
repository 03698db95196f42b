"""Writing records and tables, and growing them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.functions.text import digits_only
from orgloom.functions.values import fill_missing, numbers_to_text
from orgloom.schemas import ALL_MEMBERS, KEYWORD_MEMBERS
from orgloom.sinks.publish import exists, publication
from orgloom.sources.org_list import read_csv_text


def write_records(records: DataFrame, path: str, append: bool = True) -> None:
    """JSON Lines, in a folder of their own that counts once it is complete.

    An append neither reads nor rewrites the earlier files; without ``append`` they are
    superseded and then deleted. Rows keep the order they have in ``records``.
    """
    with publication(records.sparkSession, path, replace=not append) as folder:
        records.write.mode("overwrite").json(folder)


def write_csv(table: DataFrame, path: str, append: bool = False) -> None:
    """CSV with header and minimal quoting; values are written as they are."""
    (
        table.write.mode("append" if append else "overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_native(table: DataFrame, path: str, append: bool = False) -> None:
    """Parquet, with the member count also as a number in ``members_n``."""
    counts = [c for c in (ALL_MEMBERS, KEYWORD_MEMBERS) if c in table.columns]
    if counts:
        first_count = F.coalesce(*(digits_only(F.col(f"`{c}`")) for c in counts))
        table = table.withColumn("members_n", first_count.cast("bigint"))
    table.write.mode("append" if append else "overwrite").parquet(path)


def stored_columns(spark: SparkSession, path: str) -> list[str] | None:
    """Column names of a stored CSV table from its header, None when there is none yet."""
    try:
        return spark.read.option("header", True).option("escape", '"').csv(path).columns
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None  # nothing there, or only what a stopped write has left


def append_by_name(existing: DataFrame, new: DataFrame, fill_all: bool = False) -> DataFrame:
    """All rows of both, columns matched by name.

    New rows get the missing mark before the union, so a column that one side
    lacks stays NULL there; ``fill_all`` fills those as well.
    """
    grown = numbers_to_text(existing).unionByName(
        fill_missing(numbers_to_text(new)), allowMissingColumns=True
    )
    return fill_missing(grown) if fill_all else grown


def append_csv(new: DataFrame, path: str, grown_path: str, fill_all: bool = False) -> str:
    """Append to a stored CSV table and return the folder that holds the result.

    While the table has all columns of the new rows, these are put in its order and only
    new files are added. If they bring new columns, the union goes to ``grown_path``: a
    table is never written over while it is read.
    """
    spark = new.sparkSession
    columns = stored_columns(spark, path)
    if columns is None or set(new.columns) <= set(columns):
        rows = fill_missing(numbers_to_text(new))
        lacking = [c for c in columns or () if c not in new.columns]
        rows = rows.select(
            *(F.lit(None).cast("string").alias(c) if c in lacking else F.col(f"`{c}`") for c in columns or new.columns)
        )
        write_csv(fill_missing(rows) if fill_all else rows, path, append=True)
        return path
    write_csv(append_by_name(read_csv_text(spark, path), new, fill_all), grown_path)
    return grown_path


def newest_version(spark: SparkSession, path: str) -> tuple[str, str]:
    """Where a table that may have grown lives now, and the folder for its next version.

    A version counts if its write came to its end; what a stopped one has left is written
    over by the next.
    """
    current, version = path, 2
    while exists(spark, f"{path}.v{version}/_SUCCESS"):
        current, version = f"{path}.v{version}", version + 1
    return current, f"{path}.v{version}"
