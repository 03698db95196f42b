"""The two jobs a user runs: organisation list to records, records to tables."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import SparkSession

from orgloom.plans.extraction import classify, extract_datasets, rejects, write_datasets
from orgloom.plans.store import append_records, export_tables
from orgloom.schemas import NAME_COLUMN, URL_COLUMN, ExtractionSpec
from orgloom.sinks.figures import Places, counted
from orgloom.sinks.tables import write_csv
from orgloom.sources.org_list import stored_org_list
from orgloom.sources.pages import read_pages


def run_extraction(
    spark: SparkSession,
    org_csv: str,
    pages_path: str,
    out_dir: str,
    run_ts: str | None = None,
    spec: ExtractionSpec | None = None,
    pages_format: str = "parquet",
    pages_partitions: int | None = None,
    name_column: str = NAME_COLUMN,
    url_column: str = URL_COLUMN,
    encoding: str = "ISO-8859-1",
    multiline: bool | None = None,
    append: bool = False,
    **options: bool,
) -> Places:
    """Write the five JSON datasets and the rejected organisations; return the folders and figures.

    Records are in the order of the list. Earlier output in ``out_dir`` is replaced, or kept
    before the new records with ``append``. ``run_ts`` stamps records that have no
    capture time; give it to make a rerun produce the same records.
    """
    run_ts = run_ts or datetime.now().isoformat()
    orgs = stored_org_list(spark, org_csv, name_column, url_column, encoding, multiline)
    pages = read_pages(spark, pages_path, pages_format, pages_partitions)
    places = write_datasets(extract_datasets(orgs, pages, run_ts, spec, **options), out_dir, append)
    places["rejects"] = os.path.join(out_dir, "rejects.csv")
    without = classify(orgs, null_as_placeholder=options.get("null_as_placeholder", False))
    found = counted(rejects(without), lambda df: write_csv(df, places["rejects"], append))
    places.figures["rejects"] = found["rows"]
    return places


def run_conversion(
    spark: SparkSession,
    records_dir: str,
    out_dir: str,
    run_ts: str | None = None,
    roles_form: str = "wide",
    layout: str = "lines",
    append: bool = True,
    mode: str = "FAILFAST",
    export: bool = True,
    **options: bool,
) -> Places:
    """Store the records below ``out_dir``, write the five CSV tables, and return where they are.

    Roles are in ``wide`` or ``long`` form. A rerun appends its rows again unless ``append``
    is off. The store takes all five datasets or none and is never rewritten; the CSV tables are made
    from all of it. Without ``export`` only the records are stored, and the store's folder
    is returned. Further options are those of ``stored_table``. The figures are the numbers
    of records stored now, by table, and of roles whose column had to be renamed.
    """
    store = os.path.join(out_dir, "store")
    run_ts = run_ts or datetime.now().isoformat()
    appended = append_records(spark, records_dir, store, run_ts, layout, mode, replace=not append)
    places = export_tables(spark, store, out_dir, roles_form, **options) if export else Places({"store": store})
    places.figures |= appended.figures
    return places
