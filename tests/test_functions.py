import datetime

import pytest
from pyspark.sql import functions as F

from orgloom.functions import text, urls, values
from orgloom.plans.extraction import classify, rejects
from orgloom.schemas import ExtractionSpec


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).collect()[0][0]


@pytest.mark.parametrize(
    "url, status, base",
    [
        ("https://x.example.com/company/01/", "valid", "https://x.example.com/company/01"),
        ("https://x.example.com/company/01", "valid", "https://x.example.com/company/01"),
        ("http://x.example.com/company/1/people/?a=b", "valid", "https://x.example.com/company/1"),
        ("www.x.example.com/company/1?a=1", "valid", "https://www.x.example.com/company/1?a=1"),
        ("https://x.example.com", "valid", "https://x.example.com"),
        ("https://", "valid", "https://"),
        ("HTTP://x.example.com", "invalid", None),
        (" https://x.example.com", "invalid", None),
        ("x.example.com/company/1", "invalid", None),
        ("", "blank", None),
        ("-", "blank", None),
        (" \t　\x1c", "blank", None),
        (None, "null", None),
    ],
)
def test_url_status_and_base(spark, url, status, base):
    orgs = spark.createDataFrame([("n", url)], "name string, profile_url string")
    row = classify(orgs).collect()[0]
    assert (row.url_status, row.base_url) == (status, base)


def test_null_urls_are_rejected_or_kept_as_placeholders(spark):
    orgs = spark.createDataFrame([("a", None), ("b", "-")], "name string, profile_url string")
    assert [r.name for r in rejects(classify(orgs)).collect()] == ["a"]
    assert rejects(classify(orgs, null_as_placeholder=True)).isEmpty()


def test_query_can_be_cut_first(spark):
    assert one(spark, "https://h/s/x?t=1", lambda u: urls.base_url(u, strip_query_first=True)) == "https://h/s/x"
    assert one(spark, "https://h/s/x?t=1", urls.base_url) == "https://h/s/x?t=1"


def test_truncation_is_idempotent(spark):
    url = "https://h/a/b/c/d?x=/y"
    cut = one(spark, url, urls.first_parts)
    assert cut == "https://h/a/b" == one(spark, cut, urls.first_parts)


def test_targets_follow_the_keyword(spark):
    orgs = spark.createDataFrame([("n", "https://h/c/1")], "name string, base_url string")
    found = {r.page_kind: r.target_url for r in urls.page_targets(orgs, ExtractionSpec(keyword="laser")).collect()}
    assert found == {
        "about": "https://h/c/1/about/",
        "people_kw": "https://h/c/1/people/?keywords=laser",
        "people": "https://h/c/1/people/",
    }


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2-10 employees", "'2-10"),
        ("10,001+ employees", "'10,001+"),
        ("1K-5K Employees", "'1K-5K"),
        ("11–50 employees", "'11–50"),
        ("employees", "'"),
        ("Self-employed", None),
        ("a employees b employees c", "'a employees b"),
        ("x\n5 employees", "'5"),
        (None, None),
    ],
)
def test_size_extract(spark, raw, expected):
    assert one(spark, raw, text.size_extract) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("'1K-5K", "'1-5"),
        ("'10,001+", "'10001"),
        ("'11–50", "'1150"),
        ("'", "'"),
        ("-", "-"),
        (None, "-"),
        ("'2-10", "'2-10"),
    ],
)
def test_size_clean(spark, raw, expected):
    assert one(spark, raw, text.size_clean) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("1,234 associated members", "1,234"),
        ("1 Associated Member", "1"),
        ("12\n associated members", "12"),
        ("12 of 34 associated members", "34"),
        ("members: 5", None),
        (None, None),
    ],
)
def test_members_extract(spark, raw, expected):
    assert one(spark, raw, text.members_extract) == expected


def test_long_texts_take_linear_time(spark):
    long_line, long_number, long_gap = "a" * 300_000, "1" * 300_000, " " * 300_000
    assert one(spark, long_line, text.size_extract) is None
    assert one(spark, long_number, text.members_extract) is None
    assert one(spark, f"a{long_gap}b", text.strip) == f"a{long_gap}b"


def test_digits_and_strip(spark):
    assert one(spark, "1,234 x", text.digits_only) == "1234"
    assert one(spark, "-", text.digits_only) is None
    assert one(spark, "  a b \n\x1f", text.strip) == "a b"
    assert one(spark, " a \n", text.strip) == "a"


def test_iso_text_leaves_a_zero_fraction_out(spark):
    at = datetime.datetime(2024, 5, 1, 2, 3, 4)
    assert one(spark, at, text.iso_text, "timestamp_ntz") == at.isoformat()
    at = at.replace(microsecond=250)
    assert one(spark, at, text.iso_text, "timestamp_ntz") == at.isoformat()
    assert one(spark, None, text.iso_text, "timestamp_ntz") is None


def test_numbers_become_text_before_the_fill(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "`a.b` int, c string")
    rows = values.fill_missing(values.numbers_to_text(df)).collect()
    assert [tuple(r) for r in rows] == [("1", "-"), ("-", "x")]


def test_members_column_of_a_variant(spark):
    df = spark.createDataFrame([("7",)], ["Associated Members"])
    assert df.select(values.members_column(df, keyword=False)).collect()[0].members == "7"
    assert df.select(values.members_column(df, keyword=True)).collect()[0].members is None
