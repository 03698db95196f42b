"""One large file, many tasks: CSV cells that span lines, JSON arrays in any shape, cut at every place."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from orgloom.schemas import DATASETS, NA_TOKENS
from orgloom.sources.framing import framed, pieces
from orgloom.sources.org_list import read_csv_text, read_org_list, stored_org_list
from orgloom.sources.records import read_records

ROLES = DATASETS["roles_all"]


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cells(seed, n):
    rng = random.Random(seed)
    signs = ["a", "b", '"', '""', "\n", ",", " ", "é", "x" * 30, "\n\n", '"\n', "-"]
    return [["".join(rng.choices(signs, k=rng.randrange(9))) or "v", "".join(rng.choices(signs, k=rng.randrange(60))) or "w"] for _ in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_with_cells_over_lines(spark, tmp_path, small_splits, end):
    rows = {k: cells(k, 120) for k in range(3)}
    for k, mine in rows.items():
        text = io.StringIO()
        csv.writer(text, lineterminator=end).writerows([["Name", "LinkedIn"], *mine])
        (tmp_path / f"list-{k}.csv").write_bytes(text.getvalue().encode("latin-1"))
    df = read_csv_text(spark, str(tmp_path), "ISO-8859-1")
    assert df.columns == ["Name", "LinkedIn"]
    assert pieces(spark, str(tmp_path), "csv").rdd.getNumPartitions() > 10
    want = sorted((a, b) for mine in rows.values() for a, b in mine)
    assert sorted((r[0], r[1]) for r in df.collect()) == want
    listed = stored_org_list(spark, str(tmp_path)).orderBy("position").collect()
    assert [r.position for r in listed] == list(range(360))
    flat = [b for mine in rows.values() for _, b in mine]
    assert [r.profile_url for r in listed] == [None if x in NA_TOKENS else x for x in flat]
    assert [r.name for r in listed] == [None if a in NA_TOKENS else a for mine in rows.values() for a, _ in mine]
    assert read_org_list(spark, str(tmp_path)).count() == 360


def records(seed, n):
    rng = random.Random(seed)
    signs = ["a", "{", "}", "[", "]", '"', "\\", "\n", ",", "},", "é", "日", " " * 20, " "]
    text = lambda k: "".join(rng.choices(signs, k=rng.randrange(k)))
    made = []
    for i in range(n):
        roles = rng.choice([[], "-", [{"Role": text(6), "Count": str(j), "x": {"y": [{}]}} for j in range(rng.randrange(12))]])
        made.append({"Company Name": f"{i}:{text(50)}", "Roles": roles})
    return made


@pytest.mark.parametrize("shape", [{"indent": None}, {"indent": 1}, {"indent": 4}, {"separators": (",", ":")}, {"indent": 2, "ensure_ascii": False}])
def test_arrays_in_any_shape(spark, tmp_path, small_splits, shape):
    rows = {k: records(k, 90) for k in range(2)}
    for k, mine in rows.items():
        (tmp_path / f"part-{k:05d}.json").write_text(json.dumps(mine, **shape))
    df = read_records(spark, str(tmp_path), ROLES, "array", with_order=True)
    assert pieces(spark, str(tmp_path), "json").rdd.getNumPartitions() > 10
    got = df.orderBy("record_order").select("Company Name", F.to_json("Roles").alias("r")).collect()
    want = [r for mine in rows.values() for r in mine]
    assert [r[0] for r in got] == [r["Company Name"] for r in want]
    assert [json.loads(r.r) for r in got] == [r["Roles"] for r in want]


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = [{"Company Name": "{" * 5000 + '"}' * 300}, {"Company Name": "b"}, {"Company Name": "}" * 4000}]
    (tmp_path / "r.json").write_text(json.dumps(long))
    got = read_records(spark, str(tmp_path / "r.json"), ROLES, "array", with_order=True).orderBy("record_order").collect()
    assert [r["Company Name"] for r in got] == [r["Company Name"] for r in long]
    (tmp_path / "l.csv").write_text('Name,LinkedIn\n"' + "line\n" * 2000 + '",u\nb,v\n')
    assert [(len(r[0]), r[1]) for r in read_csv_text(spark, str(tmp_path / "l.csv")).collect()] in ([(10_000, "u"), (1, "v")], [(1, "v"), (10_000, "u")])


@pytest.mark.parametrize("text", ["[]", "[\n]", " [ ] \n", ""])
def test_nothing_in_an_array(spark, tmp_path, text):
    (tmp_path / "r.json").write_text(text)
    assert read_records(spark, str(tmp_path / "r.json"), ROLES, "array").count() == 0


@pytest.mark.parametrize("text", ['[{"Company Name": "a"}, 5, {"Company Name": "b"}]', '[{"Company Name": "a"}, {"Company', '[{"Company Name": }]'])
def test_what_is_no_record_stops_the_job(spark, tmp_path, text):
    (tmp_path / "r.json").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_records(spark, str(tmp_path / "r.json"), ROLES, "array").collect()


def test_no_text_is_shuffled(spark, tmp_path):
    (tmp_path / "l.csv").write_text('Name,LinkedIn\n"a\nb",u\n')
    plan = framed(pieces(spark, str(tmp_path / "l.csv"), "csv"), "csv")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
