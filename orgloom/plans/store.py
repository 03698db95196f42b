"""A store of converted records that grows by appends, and the tables made from it.

Every append holds, as Parquet, the records of all five datasets with their lists normalised,
and for the role datasets the labels that no earlier append has, each with the place
where it is first seen. It counts as a whole or not at all, and no later append touches its
files: new roles are new rows of the dictionary, not new columns of a stored table. The
long tables are read off the lists without a shuffle; a wide table is an export, whose
columns are the dictionary in order of appends and places.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgloom.functions.values import default_time
from orgloom.operators import reshape
from orgloom.operators.order import in_order, written_place
from orgloom.plans import tables
from orgloom.schemas import DATASETS, Dataset
from orgloom.sinks.figures import Places, counted
from orgloom.sinks.publish import STAMP, publication, published
from orgloom.sinks.tables import write_csv
from orgloom.sources.records import read_optional

FIRST_SEEN = "struct<part:bigint,block:bigint,row:bigint,pos:int>"
LABELS_SCHEMA = f"label string, first_seen {FIRST_SEEN}"


def native_schema(dataset: Dataset) -> T.StructType:
    """Schema of a dataset's stored records: the JSON keys, the list as items."""
    items = [T.StructField("items", T._parse_datatype_string(reshape.ITEMS_TYPE))]
    return T.StructType([f for f in dataset.record_schema() if f.name != dataset.list_key] + (items if dataset.facet else []))


def native_records(records: DataFrame, dataset: Dataset, run_ts: str) -> DataFrame:
    """Records as they are stored; those without a time get that of the run that stores them."""
    stamped = records.withColumn("Time Stamp", default_time(F.col("Time Stamp"), run_ts))
    return tables.with_items(stamped, dataset) if dataset.facet else stamped


def append_records(
    spark: SparkSession,
    records_dir: str,
    store: str,
    run_ts: str,
    layout: str = "lines",
    mode: str = "FAILFAST",
    replace: bool = False,
) -> Places:
    """Store the five datasets below ``records_dir`` as one append; return its folder, with the rows of each table.

    With ``replace`` the append takes the place of all earlier ones. A dataset that is not
    there is stored as an empty one. Rows stand in the order of the records.
    """
    with publication(spark, store, replace) as folder:
        places = Places({"append": folder})
        for dataset in DATASETS.values():
            records = read_optional(
                spark, posixpath.join(records_dir, dataset.file_name), dataset, layout, with_order=True, mode=mode
            )
            rows = posixpath.join(folder, dataset.table_name)
            ordered = in_order(native_records(records, dataset, run_ts), "record_order").drop("record_order")
            places.figures[dataset.table_name] = counted(ordered, lambda df, rows=rows: df.write.parquet(rows))["rows"]
            if dataset.facet == "roles":
                found = first_places(spark.read.schema(native_schema(dataset)).parquet(rows))
                if not replace:
                    known = labels(spark, store, dataset).select("label")
                    found = found.join(known, "label", "left_anti")
                found.coalesce(1).write.parquet(posixpath.join(folder, _labels_of(dataset)))  # labels are few and narrow
    return places


def first_places(stored: DataFrame) -> DataFrame:
    """label and first_seen of the records of one append, read from its files."""
    placed = stored.select(F.struct(*written_place()).alias("place"), "items")
    found = reshape.role_columns(placed, order="place")
    seen = F.struct(F.col("first_seen.record.*"), F.col("first_seen.pos").alias("pos"))
    return found.select("label", seen.cast(FIRST_SEEN).alias("first_seen"))


def _labels_of(dataset: Dataset) -> str:
    return f"labels_{dataset.table_name}"


def _stored(spark: SparkSession, store: str, part: str, schema: T.StructType | str) -> DataFrame:
    appends = published(spark, store).appends
    if not appends:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(posixpath.join(a, part) for a in appends))


def stored_records(spark: SparkSession, store: str, dataset: Dataset) -> DataFrame:
    """All records of a dataset; only the columns that a query needs are read."""
    return _stored(spark, store, dataset.table_name, native_schema(dataset))


def labels(spark: SparkSession, store: str, dataset: Dataset) -> DataFrame:
    """label, append and first_seen: the roles of all appends, in order of the last two columns."""
    found = _stored(spark, store, _labels_of(dataset), LABELS_SCHEMA)
    append = F.regexp_extract(F.input_file_name(), STAMP, 1)
    return found.select("label", append.alias("append"), "first_seen")


def label_names(spark: SparkSession, store: str, dataset: Dataset) -> list[str]:
    """The roles as column names, in the order in which they were first seen."""
    return reshape.bounded_names(labels(spark, store, dataset).orderBy("append", "first_seen").select("label"))


def stored_table(
    spark: SparkSession,
    store: str,
    dataset: Dataset,
    roles_form: str = "wide",
    fallback_members: bool = True,
    keep_dash_column: bool = True,
) -> DataFrame:
    """The presentation table of a dataset; every hole has the missing mark."""
    records = stored_records(spark, store, dataset)
    if dataset.facet is None:
        return tables.about_table(records, "")
    if dataset.facet == "roles" and roles_form == "wide":
        return tables.wide_table(records, dataset, "", label_names(spark, store, dataset), keep_dash_column=keep_dash_column)
    return tables.long_table(records, dataset, "", fallback_members)


def export_tables(spark: SparkSession, store: str, out_dir: str, roles_form: str = "wide", **options: bool) -> Places:
    """Write the five tables as CSV and return their folders; an earlier export stays until the new one is whole."""
    if roles_form not in ("wide", "long"):
        raise ValueError(f"roles_form is wide or long, not {roles_form!r}")
    places = Places(figures={"renamed_roles": 0})
    for dataset in DATASETS.values():
        table = stored_table(spark, store, dataset, roles_form, **options)
        with publication(spark, posixpath.join(out_dir, f"{dataset.table_name}.csv"), replace=True) as folder:
            write_csv(table, folder)
        places.figures["renamed_roles"] += sum(c.endswith(reshape.RENAMED) for c in table.columns)
        places[dataset.table_name] = folder
    return places
