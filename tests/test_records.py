import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from orgloom.operators import reshape
from orgloom.plans import tables
from orgloom.schemas import DATASETS, NA_TOKENS
from orgloom.sources.org_list import has_multiline_cells, read_org_list
from orgloom.sources.records import read_optional, read_records

RUN_TS = "2024-06-01T12:00:00"
ROLES, LOCATIONS = DATASETS["roles_all"], DATASETS["locations_all"]


def test_org_list(spark, tmp_path):
    path = tmp_path / "orgs.csv"
    path.write_bytes(
        'Extra,LinkedIn,Name\n1,https://h/company/a/,"Caf\xe9, ""A"""\n2,,B\n3,"",C\n4,NA,null\n5,  ,NaN \n\n6,-,n/a'.encode(
            "ISO-8859-1"
        )
    )
    assert [tuple(r) for r in read_org_list(spark, str(path)).collect()] == [
        ('Café, "A"', "https://h/company/a/"),
        ("B", None),
        ("C", None),
        (None, None),
        ("NaN ", "  "),
        (None, "-"),
    ]


@pytest.mark.parametrize("line_breaks", [False, True])
def test_org_list_reads_what_pandas_reads(spark, tmp_path, line_breaks):
    rng = random.Random(5)
    cells = [*NA_TOKENS, "a", " ", "  b ", 'say "x"', "c,d", "'", '"', '""', "Caf\xe9", "-", "01", "\\", "a\\", "#x", "\t"]
    cells += ["two\nlines", "\n"] if line_breaks else []
    rows = [(rng.choice(cells), str(i), rng.choice(cells)) for i in range(500)]
    path = str(tmp_path / "orgs.csv")
    pd.DataFrame(rows, columns=["Name", "n", "LinkedIn"]).to_csv(path, index=False, encoding="ISO-8859-1")
    assert has_multiline_cells(spark, path) == line_breaks
    expected = pd.read_csv(path, encoding="ISO-8859-1", dtype=str).astype(object)
    expected = expected.where(expected.notna(), None)[["Name", "LinkedIn"]]
    found = read_org_list(spark, path).collect()
    assert [tuple(r) for r in found] == [tuple(r) for r in expected.itertuples(index=False)]


def test_org_list_without_a_url_column(spark, tmp_path):
    path = tmp_path / "orgs.csv"
    path.write_text("Name\nA\n")
    assert [tuple(r) for r in read_org_list(spark, str(path)).collect()] == [("A", "")]


def test_cells_that_span_lines(spark, tmp_path):
    path = tmp_path / "orgs.csv"
    path.write_text('Name,LinkedIn\n"A\nB",-\nC,-\n')
    assert has_multiline_cells(spark, str(path))
    assert [r.name for r in read_org_list(spark, str(path)).collect()] == ["A\nB", "C"]
    path = tmp_path / "plain.csv"
    path.write_text('Name,LinkedIn\n"A ""x"" B",-\n')
    assert not has_multiline_cells(spark, str(path))


def sample(n=50):
    records = [
        {"Company Name": f'O{i}\n    }},\n', "Roles": [{"Count": str(i), "Role": "a"}, {"Role": "b"}], "Time Stamp": "t"}
        for i in range(n)
    ]
    return [*records, {"Company Name": float("nan"), "Roles": "-"}, {"input_company_name": "x", "Roles": []}]


@pytest.mark.parametrize("layout", ["array", "indented", "lines"])
def test_layouts_read_alike(spark, tmp_path, layout):
    path = tmp_path / "records.json"
    if layout == "lines":
        path.write_text("\n".join(json.dumps(r) for r in sample()))
    else:
        path.write_text(json.dumps(sample(), indent=4 if layout == "indented" else None))
    df = read_records(spark, str(path), ROLES, layout, with_order=True).orderBy("record_order")
    rows = df.select("Company Name", F.to_json("Roles").alias("roles"), "input_company_name").collect()
    assert [r["Company Name"] for r in rows[:50]] == [r["Company Name"] for r in sample()[:50]]
    assert json.loads(rows[3].roles) == [{"Count": "3", "Role": "a"}, {"Role": "b"}]
    assert rows[50]["Company Name"] is None and rows[50].roles == '"-"'
    assert rows[51].input_company_name == "x" and len(rows) == 52


def test_other_line_ends_and_shapes_lose_nothing(spark, tmp_path):
    path = tmp_path / "records.json"
    for text in (json.dumps(sample(), indent=4).replace("\n", "\r\n"), json.dumps(sample()), json.dumps(sample(), indent=1)):
        path.write_bytes(text.encode())
        df = read_records(spark, str(path), ROLES, "indented", with_order=True).orderBy("record_order")
        assert [r[0] for r in df.select("Company Name").collect()][:50] == [r["Company Name"] for r in sample()[:50]]
        assert df.count() == 52


@pytest.mark.parametrize("layout", ["array", "indented", "lines"])
def test_broken_json_stops_the_job(spark, tmp_path, layout):
    path = tmp_path / "records.json"
    path.write_text('[\n    {\n        "Company Name": "a"\n    },\n    {\n        "Company Name": \n    }\n]')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_records(spark, str(path), ROLES, layout).collect()


@pytest.mark.parametrize("n", [0, 1])
def test_short_indented_arrays(spark, tmp_path, n):
    path = tmp_path / "records.json"
    path.write_text(json.dumps(sample()[:n], indent=4))
    assert read_records(spark, str(path), ROLES, "indented").count() == n


def test_an_indented_array_is_split_among_tasks(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text(json.dumps(sample(5000), indent=4))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = read_records(spark, str(path), ROLES, "indented", with_order=True)
        assert df.rdd.getNumPartitions() > 4
        rows = df.orderBy("record_order").select("Company Name").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r[0] for r in rows[:5000]] == [r["Company Name"] for r in sample(5000)[:5000]]
    assert len(rows) == 5002


def test_a_missing_dataset_is_empty(spark, tmp_path):
    for order in (False, True):
        df = read_optional(spark, str(tmp_path / "nothing.json"), ROLES, with_order=order)
        assert df.isEmpty() and df.columns[:2] == ["input_company_name", "Company Name"]


def records(spark, lists, dataset=ROLES, **more):
    rows = []
    for i, value in enumerate(lists):
        listed = {} if value is ... else {dataset.list_key: value}
        names = {"Company Name": f"O{i}", "input_company_name": f"o{i}"}
        rows.append(json.dumps({**names, "Time Stamp": "t", **more, **listed}))
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "record_order int, j string").select(
        "record_order", F.from_json("j", dataset.record_schema()).alias("r")
    ).select("record_order", "r.*")


LISTS = [
    [{"Count": "1", "Role": "a"}, {"Count": "2", "Role": "a"}],  # the last of equal labels counts
    [],
    "-",
    ...,  # no list
    None,
    [{"Count": "3"}, {"Role": "b"}, {"Role": None, "Count": None}, {}],
    ["x", 5, 2.5, True, None],
    "ab",
    {"k": 1},
    7,
    [{"Count": True, "Role": "a"}, {"Count": 2, "Role": False}],
    [{"Count": 1, "Role": "a", "more": {"x": 1}}, None],
    "",
]


def items_of(spark, dataset=ROLES):
    df = tables.with_items(records(spark, LISTS, dataset), dataset).orderBy("record_order")
    return [[(i.label, i["count"]) for i in r["items"]] for r in df.collect()]


def test_every_list_shape(spark):
    assert items_of(spark) == [
        [("a", "1"), ("a", "2")],
        [],
        [("-", None)],
        [],
        [],
        [("Unknown Role", "3"), ("b", "-"), (None, "-"), ("Unknown Role", "-")],
        [("x", None), ("5", None), ("2.5", None), ("True", None), ("None", None)],
        [("a", None), ("b", None)],
        [("k", None)],
        [],
        [("a", "True"), ("False", "2")],
        [("a", "1"), ("None", None)],
        [],
    ]


def test_locations_default_to_the_mark(spark):
    assert items_of(spark, LOCATIONS)[5][0] == ("-", "3")


def test_long_rows(spark):
    df = tables.roles_long(records(spark, LISTS, **{"Associated Members": "1,000"}), False, RUN_TS)
    assert df.columns == [
        "Input Company Name", "Company Name", "Role", "Count", "Time Stamp", "Redirected to URL", "Associated Members",
    ]
    rows = df.filter("`Company Name` = 'O5'").collect()
    assert {(r.Role, r.Count) for r in rows} == {("Unknown Role", "3"), ("b", "-"), ("-", "-"), ("Unknown Role", "-")}
    assert {r["Company Name"] for r in df.collect()} == {"O0", "O2", "O5", "O6", "O7", "O8", "O10", "O11"}
    assert {r["Associated Members"] for r in rows} == {"1,000"} and {r["Redirected to URL"] for r in rows} == {"-"}


def test_missing_time_stamps_get_the_run_time(spark):
    df = records(spark, [["x"]]).withColumn("Time Stamp", F.lit(None).cast("string"))
    assert tables.roles_long(df, False, RUN_TS).collect()[0]["Time Stamp"] == RUN_TS


def test_members_of_rows_made_from_other_items(spark):
    source = records(spark, [[{"Count": "1", "Location": "L"}, "odd"]], LOCATIONS, **{"Associated Members": "9"})
    for fallback, expected in ((True, "9"), (False, "-")):
        rows = tables.locations_long(source, False, RUN_TS, fallback_members=fallback).collect()
        assert {(r.Location, r.Count, r["Associated Members"]) for r in rows} == {("L", "1", "9"), ("odd", "-", expected)}


def test_wide_keeps_every_record_and_first_seen_order(spark):
    lists = [
        [{"Count": "1", "Role": "z"}, {"Count": "2", "Role": "a.b"}],
        "-",
        ...,
        [{"Count": "3", "Role": "A"}, {"Count": "4", "Role": "a"}, {"Count": "5", "Role": "z"}, {"Count": "6", "Role": "z"}],
    ]
    df = tables.roles_wide(records(spark, lists), False, RUN_TS)
    assert df.columns[5:] == ["z", "a.b", "-", "A", "a"]
    rows = {r["Company Name"]: tuple(r)[5:] for r in df.collect()}
    assert rows == {
        "O0": ("1", "2", "-", "-", "-"),
        "O1": ("-",) * 5,
        "O2": ("-",) * 5,
        "O3": ("6", "-", "-", "3", "4"),
    }
    assert "-" not in tables.roles_wide(records(spark, lists), False, RUN_TS, keep_dash_column=False).columns
    named = tables.roles_wide(records(spark, lists), False, RUN_TS, column_order="name")
    assert named.columns[5:] == ["-", "A", "a", "a.b", "z"]


def test_a_role_named_like_a_base_column(spark):
    source = records(spark, [[{"Count": "1", "Role": "Company Name"}, {"Count": "2", "Role": "Company Name (role)"}]])
    df = tables.roles_wide(source, False, RUN_TS)
    row = df.collect()[0].asDict()
    assert row["Company Name"] == "O0" and row["Company Name (role)"] == "2"
    assert row["Company Name (role) (role)"] == "1"


def test_wide_takes_any_number_of_columns(spark):
    n = 25_000
    names = [f"role {i}" for i in range(n)]
    counts = F.map_from_arrays(F.array(F.lit("role 3"), F.lit(f"role {n - 1}")), F.array(F.lit("3"), F.lit("9")))
    wide = reshape.to_wide(spark.range(2).select("id", counts.alias("counts")), names)
    assert len(wide.columns) == n + 1
    row = wide.select("id", "`role 2`", "`role 3`", f"`role {n - 1}`").collect()[1]
    assert tuple(row) == (1, "-", "3", "9")


def test_the_form_of_roles_is_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="wdie"):
        tables.convert_all(spark, str(tmp_path), "2024", "wdie")


def test_windows_line_ends_are_split_too(spark, tmp_path):
    path = tmp_path / "crlf.json"
    rows = [{"Company Name": f"c{i}", "Roles": [{"Role": "a", "Count": "1"}]} for i in range(2000)]
    path.write_bytes(json.dumps(rows, indent=4).replace("\n", "\r\n").encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        df = read_records(spark, str(path), ROLES, "indented", with_order=True)
        places = df.select("Company Name", "record_order", F.spark_partition_id().alias("p")).orderBy("record_order").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r[0] for r in places] == [f"c{i}" for i in range(2000)]
    assert len({r["p"] for r in places}) > 3


def test_wide_goes_back_to_long(spark):
    lists = [[{"Count": str(i * 10 + j), "Role": f"r{j}"} for j in range(i)] for i in range(6)]
    wide = tables.roles_wide(records(spark, lists), False, RUN_TS)
    long = reshape.to_long(wide, wide.columns[:5])
    expected = {(f"O{i}", e["Role"], e["Count"]) for i, items in enumerate(lists) for e in items}
    assert {(r["Company Name"], r.label, r["count"]) for r in long.collect()} == expected


def test_last_wins_with_very_many_items(spark):
    n = 30_000
    entries = [{"Count": str(i), "Role": f"r{i % 1000}"} for i in range(n)]
    row = tables.wide_map(records(spark, [entries]), ROLES, RUN_TS).collect()[0]
    assert row.counts == {f"r{i}": str(n - 1000 + i) for i in range(1000)}


def test_about_table(spark):
    schema = DATASETS["about"].record_schema()
    rows = [
        {
            "Company Name": "A",
            "Company size": "'1K-5K",
            "No. of associated members": "1,234",
            "LinkedIn URL": "https://h/c?x=1?y",
            "Industry": None,
        },
        {"LinkedIn URL": "-", "Company size": "-", "No. of associated members": "-", "Time Stamp": "t", "Website": ""},
        {},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "j string").select(F.from_json("j", schema).alias("r"))
    found = {r["Company Name"] + r["Time Stamp"]: r for r in tables.about_table(df.select("r.*"), RUN_TS).collect()}
    a = found["A" + RUN_TS]
    assert (a["Company Size"], a["Associated Members"], a["LinkedIn URL"], a["Industry"]) == ("'1-5", "1234", "https://h/c", "-")
    b = found["-t"]
    assert (b["Company Size"], b["Associated Members"], b["Website"], b["Input Company Name"]) == ("-", "-", "", "-")
    assert len(found) == 3
