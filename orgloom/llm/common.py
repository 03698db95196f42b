"""What several operators need: tables, stages between jobs, words and Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgloom.session import work_dir

#: Python 3 ``bytes.split()`` and the pattern below agree: space and \x09 to \x0D divide words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a Parquet table in the shared folder.

    Cuts the lineage: a lost executor costs a read of these files, not the work before.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Narrow rows up to which a table may be broadcast.
BROADCAST_ROWS = 500_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, of narrow rows, to be broadcast if it has few of them; as it is otherwise."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def n_partitions(df: DataFrame) -> int:
    """The number of shuffle partitions that the cluster's owner has set."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def id_text(column: str) -> Column:
    return F.col(column).cast("string")


def fold(column: str, parts: int) -> Column:
    """crc32 of an id's text modulo ``parts``; -1 for a missing id."""
    return F.coalesce(F.crc32(id_text(column).cast("binary")) % parts, F.lit(-1))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def others(df: DataFrame, added: Iterable[str]) -> dict[str, Column]:
    """The columns of ``df`` by name, whatever their names hold, but those named like ``added``."""
    alike = str if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    taken = set(map(alike, added))
    return {c: F.col(quoted(c)) for c in df.columns if alike(c) not in taken}


def plainly_named(df: DataFrame, *core: str) -> DataFrame:
    """``df`` with other columns than ``core`` under names that clash with nothing, by position."""
    return df.toDF(*(c if c in core else f"passed_{i}" for i, c in enumerate(df.columns)))


def split_words(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes, unchanged."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes with A-Z lower-cased (other letters stay)."""
    return text.encode().lower().split() if text else []


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict | None]], schema: T.StructType | str
) -> DataFrame:
    """One output batch for each Arrow batch; ``make`` runs once in each task.

    What ``make`` returns turns a batch into columns by name, or None for no rows. Columns
    may have any names.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = arrow_schema(schema)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                columns = work(batch.rename_columns(names))
                if columns is not None:
                    yield from as_batches(columns, arrow)

    return plainly_named(df).mapInArrow(run, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def as_batches(columns: dict, arrow: pa.Schema, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    arrays = [
        columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type, from_pandas=False)
        for f in arrow
    ]
    whole = pa.RecordBatch.from_arrays(arrays, schema=arrow)
    for start in range(0, max(1, whole.num_rows), rows):
        yield whole.slice(start, rows)
