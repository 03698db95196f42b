"""The physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orgloom.catalogue import inputs as fx
from orgloom.plans import tables
from orgloom.functions.urls import page_targets
from orgloom.operators.lookup import key_filter, probably_known
from orgloom.operators.order import in_order, n_ranges
from orgloom.plans.extraction import classify, extract_about, extract_datasets, page_facts, targeted_captures
from orgloom.schemas import DATASETS, PAGE_SCHEMA, ExtractionSpec
from orgloom.sources.pages import spread
from orgloom.sources.records import read_records


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reshaping_needs_no_shuffle(spark, sf_dir):
    for name in ("about_table", "roles_long", "locations_long", "roles_wide", "list_normalise", "roles_last_wins"):
        assert "Exchange" not in plan_of(entry.queries()[name](spark, sf_dir)), name


def test_extraction_from_a_page_needs_no_shuffle(spark, sf_dir):
    facts = page_facts(fx.captured_pages(spark, sf_dir), ExtractionSpec())
    plan = plan_of(facts)
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_the_caller_says_whether_a_corpus_is_spread(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages").select("url", "html")
    assert "RoundRobinPartitioning" in plan_of(spread(pages, 16))
    assert "Exchange" not in plan_of(spread(pages))


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_only_the_newest_captures_of_targets_are_parsed(spark, threshold):
    spec = ExtractionSpec()
    ending = spec.suffixes["about"]
    rows = spark.range(1000).select(
        F.concat(F.lit("https://x/"), F.col("id").cast("string"), F.lit(ending)).alias("requested_url"),
        F.lit("f").alias("final_url"),
        F.explode(F.expr("sequence(1, 3)")).alias("day"),
    )
    pages = rows.select(
        "requested_url", "final_url", F.concat(F.lit("<h1>"), "day", F.lit("</h1>")).alias("html"),
        F.expr("make_date(2024, 5, day)").cast("timestamp_ntz").alias("captured_at"),
    )
    targets = spark.range(10).select(F.concat(F.lit("https://x/"), F.col("id").cast("string"), F.lit(ending)).alias("target_url"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        parsed = targeted_captures(pages, targets.unionByName(targets), spec, ["about"]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(parsed) == 10 and {r.html for r in parsed} == {"<h1>3</h1>"}


def test_page_text_stays_below_the_parser(spark, sf_dir):
    records = extract_datasets(fx.organisations(spark, sf_dir), fx.captured_pages(spark, sf_dir), fx.RUN_TS)
    lines = plan_of(records).splitlines()
    assert sum("MapInArrow" in line for line in lines) == 1, "pages are parsed once for all five datasets"
    parser = next(i for i, line in enumerate(lines) if "MapInArrow" in line)
    assert not any(re.search(r"\bhtml#", line) for line in lines[:parser])


def test_shuffles_of_the_page_join_without_broadcast(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orgs, pages = fx.organisations(spark, sf_dir), fx.captured_pages(spark, sf_dir)
        plan = plan_of(extract_datasets(orgs, pages, fx.RUN_TS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # targets twice, distinct and for the join; captures as narrow rows, as chosen texts, as facts
    assert plan.count("Exchange hashpartitioning") <= 6 and "SortMergeJoin" in plan
    assert "partial_max_by" in plan


def foreign_corpus(spark, tmp_path, targets=40, foreign=99):
    """Pages on disk: three captures of each target, and ``foreign`` times as many that nobody asks for."""
    ending = ExtractionSpec().suffixes["about"]
    rows = spark.range(targets * (foreign + 1)).select(
        F.concat(F.lit("https://x/"), F.col("id").cast("string"), F.lit(ending)).alias("requested_url"),
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("final_url"),
        F.explode(F.expr("sequence(1, 3)")).alias("day"),
    )
    rows.select(
        "requested_url", "final_url",
        F.concat(F.lit("<h1>page "), "day", F.lit("</h1>"), F.repeat(F.lit("<p>text</p>"), 50)).alias("html"),
        F.expr("make_date(2024, 5, day)").cast("timestamp_ntz").alias("captured_at"),
    ).write.parquet(str(tmp_path / "pages"))
    orgs = spark.range(targets).select(
        F.concat(F.lit("o"), "id").alias("name"), F.concat(F.lit("https://x/"), F.col("id").cast("string"), F.lit("/a/b")).alias("profile_url")
    )
    named = orgs.withColumn("profile_url", F.concat(F.lit("https://x/"), F.expr("substring(name, 2)")))
    return named, spark.read.schema(PAGE_SCHEMA).parquet(str(tmp_path / "pages"))


def below_an_exchange(plan):
    """Lines of a plan that stand below a shuffle (not a broadcast) in the tree."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    below, at = [], None
    for line in plan.splitlines():
        if at is not None and depth(line) <= at:
            at = None
        if at is not None:
            below.append(line)
        elif re.search(r"\bExchange\b", line):
            at = depth(line)
    return below


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_no_page_text_crosses_a_shuffle(spark, tmp_path, threshold):
    orgs, pages = foreign_corpus(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        records = extract_about(orgs, pages, fx.RUN_TS)
        lines = plan_of(records).splitlines()
        rows = records.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    parser = next(i for i, line in enumerate(lines) if "MapInArrow" in line)
    # the text scan is the last thing under the parser, and no shuffle stands between
    under = lines[parser:]
    scan = next(i for i, line in enumerate(under) if "FileScan" in line and re.search(r"\bhtml#", line))
    assert not any(re.search(r"\bExchange\b", line) for line in under[: scan + 1])
    assert not any(re.search(r"\bhtml#", line) for line in lines[:parser])
    texts = [line for line in below_an_exchange("\n".join(under)) if re.search(r"\bhtml#", line)]
    assert not texts, texts
    assert len(rows) == 40 and all(r.outcome == "ok" and r.company_name == "page 3" for r in rows)


def test_only_targeted_pages_are_parsed(spark, tmp_path):
    orgs, pages = foreign_corpus(spark, tmp_path)
    spec = ExtractionSpec()
    targets = page_targets(classify(orgs), spec, ["about"])
    assert targeted_captures(pages, targets, spec, ["about"]).count() == 40  # of 12,000


def test_a_small_filter_lets_strangers_pass_and_no_key_is_held_back(spark):
    keys = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("u"))
    many = spark.range(20_000).select(F.concat(F.lit("u"), "id").alias("u"))
    for words, most in ((1 << 21, 5_010), (1 << 10, 9_000), (1, 20_000)):
        known = key_filter(keys, ["u"], words)
        passed = probably_known(many, known, ["u"], words)
        assert known.count() <= words
        assert keys.join(passed, "u", "left_anti").isEmpty() and 5000 <= passed.count() <= most
    nulls = spark.createDataFrame([(None, "a"), (None, None)], "u string, v string")
    assert probably_known(nulls, key_filter(nulls, ["u", "v"]), ["u", "v"]).count() == 2
    assert probably_known(nulls, key_filter(nulls.limit(0), ["u", "v"]), ["u", "v"]).isEmpty()


def test_only_pages_of_the_wanted_kind_are_read(spark, sf_dir):
    about = extract_about(fx.organisations(spark, sf_dir), fx.captured_pages(spark, sf_dir), fx.RUN_TS)
    assert "StringEndsWith(requested_url,/about/)" in plan_of(about)


def test_an_indented_array_is_parsed_once(spark, tmp_path):
    (tmp_path / "r.json").write_text("[]")
    plan = plan_of(read_records(spark, str(tmp_path / "r.json"), DATASETS["roles_all"], "indented"))
    assert plan.count("from_json") == 1


def test_role_columns_combine_before_the_shuffle(spark, sf_dir):
    plan = plan_of(entry.queries()["role_columns"](spark, sf_dir))
    assert plan.count("Exchange") == 1 and "partial_min" in plan


def test_columns_are_pruned(spark, sf_dir):
    plan = plan_of(entry.queries()["field_default"](spark, sf_dir))
    schema = re.search(r"ReadSchema: struct<(.*)", plan).group(1)
    assert "Specialties" not in schema and "Website" not in schema
    df = fx.table(spark, sf_dir, "pages").select(F.col("url"))
    assert "html" not in plan_of(df)


@pytest.mark.parametrize(("name", "maker", "column"), [
    ("convert_all", "about_table", "Founded"), ("convert_all", "long_table", "Count"),
    ("convert_all", "wide_table", "STANDARD"), ("convert_all_long", "long_table", "Role"),
])
def test_a_conversion_makes_every_cell(spark, sf_dir, monkeypatch, name, maker, column):
    made = getattr(tables, maker)

    def broken(*args, **options):
        table = made(*args, **options)
        return table.withColumn(column, F.raise_error(F.lit("a cell was made")).cast("string")) if column in table.columns else table

    monkeypatch.setattr(tables, maker, broken)
    with pytest.raises(Exception, match="a cell was made"):
        entry.queries()[name](spark, sf_dir).collect()


def test_keys_sent_to_the_driver_follow_the_rows_not_the_shuffle_partitions(spark):
    """A range takes some 300 sampled keys: 200 ranges would send every key of this table to the driver."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        rows = spark.range(0, 30_000, 1, 4).select((F.col("id") * 7919 % 30_011).alias("v"), "id")
        ordered = in_order(rows, "v")
        ranges = int(re.search(r"rangepartitioning\(.*?, (\d+)\)", plan_of(ordered))[1])
        assert ranges == spark.sparkContext.defaultParallelism < 20
        parts = ordered.select(F.spark_partition_id().alias("p"), "v").collect()
        assert [r.v for r in sorted(parts, key=lambda r: r.p)] == sorted(r.v for r in parts) and len(parts) == 30_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ranges_of_few_and_of_many_rows():
    assert [n_ranges(n, 8) for n in (0, 1, 1000, 1001, 7000, 400_000, 400_001, 10**9)] == [1, 1, 1, 2, 7, 8, 9, 20_000]
