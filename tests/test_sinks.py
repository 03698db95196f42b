import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from orgloom.catalogue import inputs as fx
from orgloom.plans import tables
from orgloom.plans.jobs import run_conversion, run_extraction
from orgloom.schemas import ABOUT_COLUMNS, DATASETS
from orgloom.session import work_dir
from orgloom.sinks.tables import append_by_name, append_csv, newest_version, write_csv, write_native, write_records
from orgloom.sources.org_list import read_csv_text
from orgloom.sources.records import read_records
from orgloom.streaming.ingest import ingest_records

ROLES = DATASETS["roles_all"]


def pandas_csv(folder):
    import glob

    parts = [pd.read_csv(p, dtype=str, keep_default_na=False) for p in sorted(glob.glob(f"{folder}/part-*.csv"))]
    return pd.concat(parts, ignore_index=True)


def test_csv_values_survive(spark, tmp_path):
    values = [" a ", 'b "q" c', "d,e", "f\ng", "\\", '\\"', "007", "#x", "é", "-", "'1-5"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, `a b` string").coalesce(1)
    path = str(tmp_path / "t.csv")
    write_csv(df, path)
    assert list(pandas_csv(path)["a b"]) == values
    back = {r.i: r["a b"] for r in read_csv_text(spark, path).collect()}
    assert [back[str(i)] for i in range(len(values))] == values


def test_an_empty_table_has_a_header(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    empty = spark.createDataFrame([], DATASETS["about"].record_schema())
    write_csv(tables.about_table(empty, "t"), path)
    stored = read_csv_text(spark, path)
    assert stored.columns == list(ABOUT_COLUMNS) and stored.isEmpty()
    assert append_csv(tables.about_table(empty, "t"), path, path + ".v2") == path


def test_append_keeps_holes_unless_asked(spark):
    old = spark.createDataFrame([("a", "1")], ["n", "x"])
    new = spark.createDataFrame([("b", None, 2)], "n string, y string, z int")
    rows = sorted(tuple(r) for r in append_by_name(old, new).fillna("NULL").collect())
    assert rows == [("a", "1", "NULL", "NULL"), ("b", "NULL", "-", "2")]
    rows = sorted(tuple(r) for r in append_by_name(old, new, fill_all=True).collect())
    assert rows == [("a", "1", "-", "-"), ("b", "-", "-", "2")]


def test_growing_columns_move_to_a_new_version(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    one = spark.createDataFrame([("a", "1")], ["n", "x"])
    two = spark.createDataFrame([("b", "2")], ["n", "y"])
    for table in (one, one, two, one):
        place = append_csv(table, *newest_version(spark, path))
    assert place == path + ".v2"  # the last one brings no new column
    stored = read_csv_text(spark, place)
    assert stored.columns == ["n", "x", "y"] and stored.count() == 4
    assert read_csv_text(spark, path).count() == 2


def test_records_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "r.json")
    df = spark.createDataFrame([("a",)], ["Company Name"])
    for append, count in ((True, 1), (True, 2), (False, 1)):
        write_records(df, path, append=append)
        assert read_records(spark, path, ROLES).count() == count


def test_ingest_takes_each_file_once(spark, tmp_path):
    landing, store, seen = (str(tmp_path / x) for x in ("landing", "store", "seen"))
    for i in range(3):
        rows = spark.createDataFrame([(json.dumps([{"Role": "a", "Count": str(i)}]),)], ["j"])
        write_records(rows.select(F.lit(f"o{i}").alias("Company Name"), F.parse_json("j").alias("Roles")), landing)
        ingest_records(spark, landing, store, seen, ROLES, files_per_batch=1)
        ingest_records(spark, landing, store, seen, ROLES)
        assert read_records(spark, store, ROLES).count() == i + 1
    rows = read_records(spark, store, ROLES).select("Company Name", F.to_json("Roles").alias("r")).collect()
    assert {(r[0], r[1]) for r in rows} == {(f"o{i}", f'[{{"Count":"{i}","Role":"a"}}]') for i in range(3)}


def test_two_ingests_into_one_store(spark, tmp_path):
    store = str(tmp_path / "store")
    for k in range(2):
        landing, seen = str(tmp_path / f"landing{k}"), str(tmp_path / f"seen{k}")
        write_records(spark.createDataFrame([(f"n{k}",)], "input_company_name string"), landing)
        ingest_records(spark, landing, store, seen, ROLES)
        ingest_records(spark, landing, store, seen, ROLES)
    assert sorted(r.input_company_name for r in read_records(spark, store, ROLES).collect()) == ["n0", "n1"]


@pytest.mark.parametrize("ingest_first", [True, False])
def test_a_store_takes_ingested_and_written_records(spark, tmp_path, ingest_first):
    landing, store, seen = (str(tmp_path / x) for x in ("landing", "store", "seen"))
    one, two = (spark.createDataFrame([(n,)], "`Company Name` string") for n in ("in", "out"))
    write_records(one, landing)
    (tmp_path / "landing" / "broken.json").write_text('{"Company Name": "half\n')
    steps = [lambda: ingest_records(spark, landing, store, seen, ROLES), lambda: write_records(two, store)]
    for step in steps if ingest_first else steps[::-1]:
        step()
    ingest_records(spark, landing, store, seen, ROLES)
    assert sorted(r[0] for r in read_records(spark, store, ROLES).select("Company Name").collect()) == ["in", "out"]
    broken = spark.read.option("recursiveFileLookup", True).text(store + ".rejects").collect()
    assert [r[0] for r in broken] == ['{"Company Name": "half']


def test_an_append_of_known_columns_leaves_the_files_alone(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    write_csv(spark.createDataFrame([("1", "2")], "a string, b string"), path)
    old = {p.name: p.read_bytes() for p in (tmp_path / "t.csv").glob("part-*")}
    for new in (spark.createDataFrame([("4", "3")], "b string, a string"), spark.createDataFrame([("5",)], "b string")):
        assert append_csv(new, path, path + ".v2") == path
    now = {p.name: p.read_bytes() for p in (tmp_path / "t.csv").glob("part-*")}
    assert all(now[name] == data for name, data in old.items())
    rows = {tuple(r) for r in read_csv_text(spark, path).select("a", "b").collect()}
    assert rows == {("1", "2"), ("3", "4"), (None, "5")}


def test_a_stopped_write_does_not_block_the_table(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    write_csv(spark.createDataFrame([("1",)], "a string"), path)
    (tmp_path / "t.csv.v2" / "_temporary").mkdir(parents=True)
    current, grown = newest_version(spark, path)
    assert (current, grown) == (path, path + ".v2")
    assert append_csv(spark.createDataFrame([("2", "3")], "a string, c string"), current, grown) == grown
    assert read_csv_text(spark, grown).count() == 2


@pytest.mark.parametrize("form", ["wide", "long"])
def test_from_list_and_pages_to_tables(spark, sf_dir, form):
    listed, captured, out = (work_dir(spark, f"jobs-{x}") for x in ("list", "pages", "out"))
    orgs = fx.organisations(spark, sf_dir).select(F.col("name").alias("Name"), F.col("profile_url").alias("LinkedIn"))
    write_csv(orgs, listed)
    fx.captured_pages(spark, sf_dir).write.parquet(captured)
    for _ in range(2):  # a rerun replaces the records
        found = run_extraction(spark, listed, captured, out, fx.RUN_TS)
    assert read_records(spark, found["about"], DATASETS["about"]).count() == 9
    assert read_csv_text(spark, found["rejects"]).count() == 1
    for _ in range(2):  # a rerun appends the same rows again
        places = run_conversion(spark, out, out + "-csv", fx.RUN_TS, form)

    about = pandas_csv(places["about_data"])
    assert len(about) == 2 * 9 and list(about.columns) == list(ABOUT_COLUMNS)
    assert (about["Input Company Name"] == "-").sum() == 2 * 4
    roles = pandas_csv(places["what_they_do_without_quantum"])
    locations = pandas_csv(places["where_they_live_with_quantum"])
    bars = fx.bars(spark, sf_dir).filter("k % 10 in (0, 1, 2, 3, 8)")
    assert len(locations) == 2 * bars.filter("facet = 'locations' and keyword").count()
    if form == "wide":
        assert len(roles) == 2 * 9 and len(roles.columns) == 5 + 6
    else:
        assert len(roles) == 2 * bars.filter("facet = 'roles' and not keyword").count() and "Role" in roles.columns
    again = run_conversion(spark, out, out + "-csv", fx.RUN_TS, form, append=False)
    assert len(pandas_csv(again["about_data"])) == 9


def test_native_tables_have_a_number(spark, tmp_path):
    df = spark.createDataFrame([("1,234",), ("-",)], ["Associated Members"])
    write_native(df, str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t")).collect()
    assert {(r["Associated Members"], r.members_n) for r in rows} == {("1,234", 1234), ("-", None)}


def test_a_missing_dataset_gives_an_empty_table(spark, tmp_path):
    made = tables.convert_all(spark, str(tmp_path), fx.RUN_TS)
    assert {name: df.count() for name, df in made.items()} == {d.table_name: 0 for d in DATASETS.values()}
