"""The organisation list: a CSV file with a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgloom.functions.values import optional_column
from orgloom.operators.order import dense_numbers, file_place
from orgloom.schemas import NA_TOKENS, NAME_COLUMN, URL_COLUMN
from orgloom.session import work_dir
from orgloom.sources.framing import framed, pieces


PLACE = ("file", "block", "row")


def na_to_null(value: Column) -> Column:
    """NULL for cells that stand for a missing value; blanks are kept as they are."""
    return F.when(~value.isin(*NA_TOKENS), value)


def has_multiline_cells(spark: SparkSession, path: str) -> bool:
    """Whether some physical line has an odd number of quotes.

    A record can span lines only if its first line leaves a quote open. Without
    such a line the files can be split at line ends.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def _wide(encoding: str) -> bool:
    return encoding.upper().startswith(("UTF-16", "UTF-32"))


def _reader(spark: SparkSession, encoding: str) -> DataFrameReader:
    return spark.read.option("header", True).option("encoding", encoding).option("escape", '"')


def read_csv_text(
    spark: SparkSession, path: str, encoding: str = "UTF-8", multiline: bool | None = None
) -> DataFrame:
    """A CSV dataset with header, every column as text.

    Spark's reader can split a file among tasks only if no cell spans lines.
    ``multiline=None`` looks for such cells first, and joins the lines of their records
    itself, many tasks to a file; ``True`` reads each file in one task, as encodings of
    several bytes a character have to be.
    """
    reader = _reader(spark, encoding)
    if multiline is None:
        if _wide(encoding):
            multiline = True
        elif has_multiline_cells(spark, path):
            return _joined_lines(spark, path, encoding, reader.option("multiLine", True).csv(path).schema)
    return reader.option("multiLine", bool(multiline)).csv(path)


def _joined_lines(spark: SparkSession, path: str, encoding: str, schema: T.StructType, with_place: bool = False) -> DataFrame:
    """The rows of files whose cells may span lines; the first record of each is its header.

    ``with_place`` gives the cells as one column, and file, block and row beside it.
    """
    records = framed(pieces(spark, path, "csv"), "csv")
    line = F.regexp_replace(F.decode("record", encoding), r"\r?\n\z", "")
    filled = records.select("file", "block", "row", line.alias("line")).filter(F.length("line") > 0)
    place = F.struct("block", "row")
    headers = filled.groupBy("file").agg(F.min(place).alias("header"))  # one row for each file
    rows = filled.join(F.broadcast(headers), "file").filter(place != F.col("header"))
    cells = F.from_csv("line", _ddl(schema), {"escape": '"'}).alias("cells")
    return rows.select(cells, *PLACE) if with_place else rows.select(cells).select("cells.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{_quoted(name)} string" for name in schema.names)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_org_list(
    spark: SparkSession,
    path: str,
    name_column: str = NAME_COLUMN,
    url_column: str = URL_COLUMN,
    encoding: str = "ISO-8859-1",
    multiline: bool | None = None,
) -> DataFrame:
    """Columns ``name`` and ``profile_url``; an absent column reads as empty text."""
    return org_list(read_csv_text(spark, path, encoding, multiline), name_column, url_column)


def org_list(cells: DataFrame, name_column: str = NAME_COLUMN, url_column: str = URL_COLUMN) -> DataFrame:
    return cells.select(*_cells(cells, name_column, url_column))


def stored_org_list(
    spark: SparkSession,
    path: str,
    name_column: str = NAME_COLUMN,
    url_column: str = URL_COLUMN,
    encoding: str = "ISO-8859-1",
    multiline: bool | None = None,
) -> DataFrame:
    """The organisation list with ``position``, its place in the list from 0 on.

    The CSV is read once, into a table in the shared work folder; whoever needs the list
    several times reads that. Files of a folder count in the order of their names.
    """
    copy = work_dir(spark, "organisations")
    if multiline is None and not _wide(encoding) and has_multiline_cells(spark, path):
        schema = _reader(spark, encoding).option("multiLine", True).csv(path).schema
        rows = _joined_lines(spark, path, encoding, schema, with_place=True)
        cells = rows.select("cells.*", *(F.col(c).alias(f"{c} of the record") for c in PLACE))
        wanted = cells.select(*_cells(cells, name_column, url_column), *(F.col(f"`{c} of the record`").alias(c) for c in PLACE))
        # numbers of records leave out those of the lines inside: rank them in their block
        rank = F.row_number().over(Window.partitionBy("file", "block").orderBy("row"))
        wanted.withColumn("row", rank.cast("bigint")).write.parquet(copy)
    else:
        cells = read_csv_text(spark, path, encoding, bool(multiline) or _wide(encoding))
        cells.select(*_cells(cells, name_column, url_column), *file_place()).write.parquet(copy)
    return dense_numbers(spark.read.parquet(copy), ["file", "block"])


def _cells(cells: DataFrame, name_column: str, url_column: str) -> list[Column]:
    def cell(column: str) -> Column:
        value = optional_column(cells, column)
        return na_to_null(value) if column in cells.columns else value

    return [cell(name_column).alias("name"), cell(url_column).alias("profile_url")]
