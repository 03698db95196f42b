"""A store that grows: nothing stored is rewritten, appends count whole, wide tables are exports."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from orgloom.catalogue import inputs as fx
from orgloom.operators import reshape
from orgloom.plans import store as stores
from orgloom.plans.jobs import run_conversion
from orgloom.schemas import ALL_MEMBERS, DATASETS
from orgloom.sinks.publish import published
from orgloom.sinks.tables import write_records
from orgloom.sources.org_list import read_csv_text

ROLES = DATASETS["roles_all"]


def landed(spark, path, **lists):
    """Record files of one role dataset: organisation -> its list as JSON."""
    rows = spark.createDataFrame([(n, n.upper(), j) for n, j in lists.items()], "n string, c string, j string").coalesce(1)
    records = rows.select(
        F.col("n").alias("input_company_name"), F.col("c").alias("Company Name"), F.parse_json("j").alias(ROLES.list_key)
    )
    write_records(records, f"{path}/{ROLES.file_name}", append=False)
    return path


def entry(*roles):
    return "[" + ",".join(f'{{"Role": "{r}", "Count": "{i}"}}' for i, r in enumerate(roles)) + "]"


def files(path):
    return {f: open(f, "rb").read() for f in glob.glob(f"{path}/**/*", recursive=True) if os.path.isfile(f)}


def grown(spark, tmp_path):
    store = str(tmp_path / "store")
    parts = [{"a": entry("x", "y"), "b": entry("y")}, {"c": entry("z", "x")}, {"d": entry("Freelance", "w"), "e": '"-"', "f": "[]"}]
    snapshots = []
    for k, part in enumerate(parts):
        stores.append_records(spark, landed(spark, str(tmp_path / f"in{k}"), **part), store, f"time{k}")
        snapshots.append(files(store))
    return store, snapshots


def test_three_appends_leave_every_old_file_unchanged(spark, tmp_path):
    store, snapshots = grown(spark, tmp_path)
    for before, after in zip(snapshots, snapshots[1:], strict=False):
        assert all(after[f] == data for f, data in before.items()) and len(after) > len(before)
    assert stores.label_names(spark, store, ROLES) == ["x", "y", "z", "Freelance", "w", "-"]
    kept = [spark.read.schema(stores.LABELS_SCHEMA).parquet(f"{a}/labels_{ROLES.table_name}").count() for a in published(spark, store).appends]
    assert kept == [2, 1, 3]  # new ones only


def test_the_wide_export_has_all_columns_and_no_holes(spark, tmp_path):
    store, _ = grown(spark, tmp_path)
    places = stores.export_tables(spark, store, str(tmp_path / "out"))
    rows = read_csv_text(spark, places[ROLES.table_name]).orderBy("`Input Company Name`")
    assert rows.columns[5:] == ["x", "y", "z", "Freelance", "w", "-"]
    got = {r["Input Company Name"]: (r["Time Stamp"], r[ALL_MEMBERS], tuple(r)[5:]) for r in rows.collect()}
    assert got == {
        "a": ("time0", "-", ("0", "1", "-", "-", "-", "-")),
        "b": ("time0", "-", ("-", "0", "-", "-", "-", "-")),
        "c": ("time1", "-", ("1", "-", "0", "-", "-", "-")),
        "d": ("time2", "-", ("-", "-", "-", "0", "1", "-")),
        "e": ("time2", "-", ("-",) * 6),
        "f": ("time2", "-", ("-",) * 6),
    }
    without = stores.stored_table(spark, store, ROLES, keep_dash_column=False)
    assert without.columns[5:] == ["x", "y", "z", "Freelance", "w"]


def test_an_append_stopped_anywhere_leaves_all_tables_as_they_were(spark, tmp_path, monkeypatch):
    """Five datasets and two dictionaries are written; the run ends before one of them."""
    store, snapshots = grown(spark, tmp_path)
    before = {n: stores.stored_records(spark, store, d).count() for n, d in DATASETS.items()}
    source = landed(spark, str(tmp_path / "more"), g=entry("q", "x"))
    writer = type(spark.range(1).write)
    parquet = writer.parquet
    for step in range(7):
        calls = []

        def failing(self, *args, calls=calls, step=step, **kwargs):
            calls.append(args)
            if len(calls) > step:
                raise RuntimeError("stopped")
            return parquet(self, *args, **kwargs)

        monkeypatch.setattr(writer, "parquet", failing)
        with pytest.raises(RuntimeError, match="stopped"):
            stores.append_records(spark, source, store, "later")
        monkeypatch.undo()
        assert stores.stored_records(spark, store, ROLES).count() == before["roles_all"], step
        assert "q" not in stores.label_names(spark, store, ROLES)
    assert {n: stores.stored_records(spark, store, d).count() for n, d in DATASETS.items()} == before
    assert all(files(store)[f] == data for f, data in snapshots[-1].items())
    stores.append_records(spark, source, store, "later")
    assert stores.stored_records(spark, store, ROLES).count() == before["roles_all"] + 1
    assert stores.label_names(spark, store, ROLES)[-1] == "q"


def test_long_rows_are_read_from_the_store_without_a_shuffle(spark, sf_dir, tmp_path):
    store = str(tmp_path / "store")
    stores.append_records(spark, fx.records_dir(spark, sf_dir), store, fx.RUN_TS)
    long = stores.stored_table(spark, store, ROLES, "long")
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "from_json" not in plan
    narrow = long.select("Role", "Count")._jdf.queryExecution().executedPlan().toString()
    assert "Redirected" not in narrow.split("ReadSchema")[1] and "Time Stamp" not in narrow.split("ReadSchema")[1]


def test_jobs_append_replace_and_store_only(spark, sf_dir, tmp_path):
    source, out = fx.records_dir(spark, sf_dir), str(tmp_path / "out")
    assert run_conversion(spark, source, out, fx.RUN_TS, export=False) == {"store": f"{out}/store"}
    n = fx.table(spark, sf_dir, "supplier").count()
    assert read_csv_text(spark, run_conversion(spark, source, out, fx.RUN_TS)["about_data"]).count() == 2 * n
    places = run_conversion(spark, source, out, fx.RUN_TS, "long", append=False, fallback_members=False)
    assert read_csv_text(spark, places["about_data"]).count() == n
    loose = read_csv_text(spark, places["where_they_live_without_quantum"])
    assert loose.filter(f"`{ALL_MEMBERS}` = '-'").count() > 0
    with pytest.raises(ValueError, match="wide or long"):
        stores.export_tables(spark, f"{out}/store", out, "tall")


def test_an_empty_store(spark, tmp_path):
    store = str(tmp_path / "nothing")
    assert stores.label_names(spark, store, ROLES) == []
    for name, dataset in DATASETS.items():
        assert stores.stored_table(spark, store, dataset).count() == 0, name


def test_too_many_labels_for_columns(spark):
    ranked = spark.range(12).select(F.col("id").cast("string"))
    assert len(reshape.bounded_names(ranked, 12)) == 12
    with pytest.raises(ValueError, match="long form"):
        reshape.bounded_names(ranked, 11)
