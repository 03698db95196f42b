"""Appends that count whole or not at all, and the order of records over several of them."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from orgloom.catalogue import inputs as fx
from orgloom.operators import reshape
from orgloom.operators.order import dense_numbers, file_place, in_order
from orgloom.plans import tables
from orgloom.operators.outcomes import OUTCOMES
from orgloom.plans.extraction import extract_datasets
from orgloom.plans.jobs import run_conversion, run_extraction
from orgloom.schemas import DATASETS
from orgloom.sinks.publish import MARK, publication, published, vacuum
from orgloom.sinks.tables import newest_version, write_csv, write_records
from orgloom.sources.org_list import stored_org_list
from orgloom.sources.records import read_records

ROLES = DATASETS["roles_all"]


def roles(spark, *labels, name="o"):
    rows = spark.createDataFrame([(f"{name}{i}", f'[{{"Role": "{r}", "Count": "{i}"}}]') for i, r in enumerate(labels)], "n string, j string")
    return rows.select(F.col("n").alias("input_company_name"), F.parse_json("j").alias("Roles"))


def names(spark, path):
    return sorted(r[0] for r in read_records(spark, path, ROLES).select("input_company_name").collect())


def contents(path):
    return {f: open(f, "rb").read() for f in glob.glob(f"{path}/**/*", recursive=True) if os.path.isfile(f)}


class Stopped(Exception):
    pass


@pytest.mark.parametrize("replace", [False, True])
@pytest.mark.parametrize("when", ["before any file", "half the files", "before the mark"])
def test_a_stopped_write_leaves_the_earlier_table(spark, tmp_path, replace, when):
    path = str(tmp_path / "r.json")
    write_records(roles(spark, "a", "b"), path)
    before = contents(path)
    with pytest.raises(Stopped):
        with publication(spark, path, replace=replace) as folder:
            if when != "before any file":
                roles(spark, "c", "d", name="new").repartition(2).write.json(folder)
            if when == "half the files":
                os.remove(sorted(glob.glob(f"{folder}/part-*"))[0])
                os.remove(f"{folder}/_SUCCESS")
            raise Stopped
    assert names(spark, path) == ["o0", "o1"]
    assert all(contents(path)[f] == data for f, data in before.items())
    write_records(roles(spark, "c", name="again"), path, append=not replace)
    assert names(spark, path) == (["again0"] if replace else ["again0", "o0", "o1"])


def test_the_first_append_may_be_stopped(spark, tmp_path):
    path = str(tmp_path / "r.json")
    with pytest.raises(Stopped), publication(spark, path) as folder:
        roles(spark, "a").write.json(folder)
        raise Stopped
    assert names(spark, path) == [] and published(spark, path).paths == []
    assert "record_order" in read_records(spark, path, ROLES, with_order=True).columns


def test_a_named_publication_takes_the_place_of_its_own_rest(spark, tmp_path):
    path, name = str(tmp_path / "r.json"), "0" * 19 + "7-batch-1"
    for label in ("a", "b"):
        with publication(spark, path, name=name) as folder:
            roles(spark, label).write.json(folder)
    assert read_records(spark, path, ROLES).count() == 1


def test_files_of_other_origin_are_the_beginning(spark, tmp_path):
    path = str(tmp_path / "r.json")
    roles(spark, "z", name="plain").write.json(path)
    roles(spark, "y", name="folder").write.json(path + "/2024")
    write_records(roles(spark, "a"), path)
    found = read_records(spark, path, ROLES, with_order=True).orderBy("record_order")
    assert [r.input_company_name for r in found.collect()][-1] == "o0" and names(spark, path) == ["folder0", "o0", "plain0"]
    write_records(roles(spark, "b", name="new"), path, append=False)
    assert names(spark, path) == ["new0"]
    assert not glob.glob(path + "/part-*") and os.path.isdir(path + "/2024")  # own files go, others' folders stay


def test_roles_of_six_appends_stand_in_the_order_written(spark, tmp_path):
    path = str(tmp_path / "r.json")
    for k in range(6):
        write_records(roles(spark, f"role{k}", "common", f"last{k}").repartition(3), path)
    records = tables.with_items(read_records(spark, path, ROLES, with_order=True), ROLES)
    found = reshape.role_names(records)
    assert [n for n in found if n.startswith("role")] == [f"role{k}" for k in range(6)]
    first = {n: i for i, n in enumerate(found)}
    assert all(first[f"last{k}"] < first[f"role{k + 1}"] for k in range(5))


def test_records_stand_in_the_order_of_the_list(spark, tmp_path):
    listed = [f"org {(i * 37) % 101:03d}" for i in range(101)]
    lines = [f'"{n}","-"' if i % 5 else f'"{n}\nInc","-"' for i, n in enumerate(listed)]  # cells that span lines
    (tmp_path / "orgs.csv").write_text("\n".join(["Name,LinkedIn", *lines]) + "\n")
    spark.createDataFrame([], "requested_url string, final_url string, html string, captured_at timestamp_ntz").write.parquet(str(tmp_path / "pages"))
    out = str(tmp_path / "out")
    for append in (False, True):
        places = run_extraction(spark, str(tmp_path / "orgs.csv"), str(tmp_path / "pages"), out, "t", append=append)
    for name in ("about", "roles_kw"):
        rows = read_records(spark, places[name], DATASETS[name], with_order=True).orderBy("record_order").collect()
        assert [r["Company Name"].removesuffix("\nInc") for r in rows] == listed * 2


def test_positions_are_dense_whatever_the_splits(spark, tmp_path):
    for k, n in ((1, 4000), (0, 2500), (2, 1)):
        (tmp_path / f"list-{k}.csv").write_text("Name,LinkedIn\n" + "".join(f"n{k}-{i},u\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
    try:
        rows = stored_org_list(spark, str(tmp_path)).orderBy("position").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.position for r in rows] == list(range(6501))
    assert [r.name for r in rows] == [f"n{k}-{i}" for k, n in ((0, 2500), (1, 4000), (2, 1)) for i in range(n)]
    assert rows[0].asDict().keys() == {"name", "profile_url", "position"}


def test_numbering_without_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "v int, file string, block long, row long")
    assert dense_numbers(empty, ["file", "block"]).columns == ["v", "position"]
    spark.range(10).select((9 - F.col("id")).alias("v")).repartition(3).write.parquet(str(tmp_path / "t"))
    in_order(spark.read.parquet(str(tmp_path / "t")), "v").write.parquet(str(tmp_path / "u"))
    placed = spark.read.parquet(str(tmp_path / "u")).select("v", *file_place())
    placed.write.parquet(str(tmp_path / "w"))
    assert {(r.v, r.position) for r in dense_numbers(spark.read.parquet(str(tmp_path / "w")), ["file", "block"]).collect()} == {(i, i) for i in range(10)}


def test_a_growth_without_its_mark_hides_no_rows(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    write_csv(spark.range(100).select(F.col("id").cast("string").alias("a")), path)
    write_csv(spark.range(10).select(F.col("id").cast("string").alias("a")), path + ".v2")
    os.remove(path + ".v2/_SUCCESS")
    assert newest_version(spark, path) == (path, path + ".v2")


def test_marks_are_no_data(spark, tmp_path):
    path = str(tmp_path / "r.json")
    write_records(roles(spark, "a"), path)
    (folder,) = published(spark, path).appends
    assert os.path.exists(f"{folder}/{MARK}") and read_records(spark, path, ROLES).count() == 1


def test_jobs_return_what_they_counted(spark, sf_dir, tmp_path):
    listed, captured, out = (str(tmp_path / x) for x in ("list.csv", "pages", "out"))
    orgs = fx.organisations(spark, sf_dir).select(F.col("name").alias("Name"), F.col("profile_url").alias("LinkedIn"))
    write_csv(orgs, listed)
    fx.captured_pages(spark, sf_dir).write.parquet(captured)
    places = run_extraction(spark, listed, captured, out, fx.RUN_TS)
    rows = extract_datasets(fx.organisations(spark, sf_dir), fx.captured_pages(spark, sf_dir), fx.RUN_TS).collect()
    assert places.figures["records"] == len(rows) and places.figures["errors"] == sum(r.error is not None for r in rows)
    for outcome in OUTCOMES:
        assert places.figures[outcome] == sum(r.outcome == outcome for r in rows)
    assert places.figures["rejects"] == orgs.filter("LinkedIn is null").count() and places.figures["without_source"] == 0
    tables = run_conversion(spark, out, str(tmp_path / "tables"), fx.RUN_TS)
    assert tables.figures == {"renamed_roles": 0, **{d.table_name: sum(r.dataset == n for r in rows) for n, d in DATASETS.items()}}


def test_what_stopped_writes_have_left_can_go(spark, tmp_path):
    path = str(tmp_path / "r.json")
    write_records(roles(spark, "a", "b"), path)
    roles(spark, "y", name="folder").write.json(path + "/2024")
    with pytest.raises(Stopped), publication(spark, path) as folder:
        roles(spark, "c").write.json(folder)
        raise Stopped
    assert vacuum(spark, path) == []  # it may still be running
    assert vacuum(spark, path, 0) == [os.path.basename(folder)] and not os.path.exists(folder)
    assert names(spark, path) == ["folder0", "o0", "o1"] and vacuum(spark, path, 0) == [] and vacuum(spark, path + "x") == []
