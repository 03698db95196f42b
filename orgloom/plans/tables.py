"""Record datasets -> presentation tables."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.functions.text import digits_only, size_clean
from orgloom.functions.urls import strip_query
from orgloom.functions.values import default_time, fill_missing, numbers_to_text, or_missing
from orgloom.operators import reshape
from orgloom.schemas import ABOUT_COLUMNS, DATASETS, Dataset
from orgloom.sinks.tables import append_csv, newest_version, write_csv
from orgloom.sources.records import read_optional


def _finished(table: DataFrame) -> DataFrame:
    return fill_missing(numbers_to_text(table))


def about_table(records: DataFrame, run_ts: str) -> DataFrame:
    """The about table: cleaned counts, sizes and URLs, one row per record."""
    special = {
        "Input Company Name": F.col("input_company_name"),
        "Associated Members": digits_only(F.col("`No. of associated members`")),
        "Company Size": size_clean(F.col("Company size")),
        "LinkedIn URL": strip_query(F.col("LinkedIn URL")),
        "Time Stamp": default_time(F.col("Time Stamp"), run_ts),
    }
    return _finished(records.select(*(special.get(c, F.col(c)).alias(c) for c in ABOUT_COLUMNS)))


def with_items(records: DataFrame, dataset: Dataset) -> DataFrame:
    """Replace the list field by normalised ``items``, unless the records have these already."""
    if "items" in records.columns:
        return records
    return records.withColumn(
        "items", reshape.normalise_items(F.col(dataset.list_key), dataset.label_key, dataset.default_label)
    ).drop(dataset.list_key)


def _base(dataset: Dataset, run_ts: str) -> dict[str, Column]:
    return {
        "Input Company Name": F.col("input_company_name"),
        "Company Name": F.col("Company Name"),
        "Time Stamp": default_time(F.col("Time Stamp"), run_ts),
        "Redirected to URL": F.col("Redirected to URL"),
        dataset.members_key: F.col(dataset.members_key),
    }


def long_table(
    records: DataFrame, dataset: Dataset, run_ts: str, fallback_members: bool = True
) -> DataFrame:
    """One row per role or location; a single stage without shuffle.

    ``fallback_members=False`` leaves the members value out of rows made from items
    that are not entries.
    """
    rows = reshape.explode_items(with_items(records, dataset))
    base = _base(dataset, run_ts)
    if not fallback_members:
        base[dataset.members_key] = F.when(F.col("is_entry"), base[dataset.members_key])
    columns = {
        "Input Company Name": base.pop("Input Company Name"),
        "Company Name": base.pop("Company Name"),
        dataset.label_key: F.col("label"),
        "Count": F.col("count"),
        **base,
    }
    return _finished(rows.select(*(value.alias(name) for name, value in columns.items())))


def roles_long(records: DataFrame, keyword: bool, run_ts: str) -> DataFrame:
    return long_table(records, DATASETS["roles_kw" if keyword else "roles_all"], run_ts)


def locations_long(
    records: DataFrame, keyword: bool, run_ts: str, fallback_members: bool = True
) -> DataFrame:
    dataset = DATASETS["locations_kw" if keyword else "locations_all"]
    return long_table(records, dataset, run_ts, fallback_members)


def wide_map(records: DataFrame, dataset: Dataset, run_ts: str) -> DataFrame:
    """The wide table before its columns are spread: a map per record, without limit."""
    base = _base(dataset, run_ts)
    order = ["Input Company Name", "Company Name", dataset.members_key, "Time Stamp", "Redirected to URL"]
    rows = with_items(records, dataset)
    return rows.select(
        *(or_missing(base[name]).alias(name) for name in order),
        reshape.last_wins(F.col("items")).alias("counts"),
    )


def wide_table(
    records: DataFrame,
    dataset: Dataset,
    run_ts: str,
    names: Sequence[str] | None = None,
    column_order: str = "first_seen",
    keep_dash_column: bool = True,
) -> DataFrame:
    """One row per record and one column per role.

    Without ``names`` the roles are looked up first; by first appearance this needs
    records that were read with ``with_order``.
    """
    if names is None:
        names = reshape.role_names(with_items(records, dataset), column_order=column_order)
    if not keep_dash_column:
        names = [n for n in names if n != "-"]
    return reshape.to_wide(wide_map(records, dataset, run_ts), names)


def roles_wide(records: DataFrame, keyword: bool, run_ts: str, **options) -> DataFrame:
    return wide_table(records, DATASETS["roles_kw" if keyword else "roles_all"], run_ts, **options)


def convert_all(
    spark: SparkSession,
    records_dir: str,
    run_ts: str,
    roles_form: str = "wide",
    layout: str = "lines",
) -> dict[str, DataFrame]:
    """All five tables by name; datasets that are not there give empty tables."""
    if roles_form not in ("wide", "long"):
        raise ValueError(f"roles_form is wide or long, not {roles_form!r}")
    tables = {}
    for dataset in DATASETS.values():
        path = os.path.join(records_dir, dataset.file_name)
        first_seen = dataset.facet == "roles" and roles_form == "wide"
        records = read_optional(spark, path, dataset, layout=layout, with_order=first_seen)
        if dataset.facet is None:
            tables[dataset.table_name] = about_table(records, run_ts)
        elif first_seen:
            tables[dataset.table_name] = wide_table(records, dataset, run_ts)
        else:
            tables[dataset.table_name] = long_table(records, dataset, run_ts)
    return tables


def write_tables(tables: dict[str, DataFrame], out_dir: str, append: bool = True) -> dict[str, str]:
    """Write every table as CSV and return where each one now lives."""
    places = {}
    for name, table in tables.items():
        path = os.path.join(out_dir, f"{name}.csv")
        if append:
            places[name] = append_csv(table, *newest_version(table.sparkSession, path))
        else:
            write_csv(table, path)
            places[name] = path
    return places
