"""Queries on the organisation list, URLs and scalar clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.catalogue import inputs as fx
from orgloom.catalogue.shared import BARS, ORGS, PAGES, SPEC, Query, with_ctes
from orgloom.functions import text, urls, values
from orgloom.operators.lookup import latest_capture, lookup
from orgloom.plans.extraction import classify, rejects
from orgloom.sources.org_list import org_list, read_org_list


def org_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        cells = fx.organisations(spark, sf_dir).select(
            F.when(F.col("k") % 7 == 0, "N/A").otherwise(F.concat("name", F.lit(', "é"'))).alias("Name"),
            F.lit("unused").alias("Notes"),
            F.coalesce("profile_url", F.when(F.col("k") % 20 == 17, F.lit("null"))).alias("LinkedIn"),
        )
        (
            cells.write.option("header", True)
            .option("encoding", "ISO-8859-1")
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )

    return read_org_list(spark, fx.written(spark, sf_dir, "org-list", write))


def optional_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orgs = org_list(fx.organisations(spark, sf_dir).select(F.col("name").alias("Name")))
    return classify(orgs).select("name", "profile_url", "url_status")


def url_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(fx.organisations(spark, sf_dir)).drop("k")


def org_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(classify(fx.organisations(spark, sf_dir)))


def _page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs in all scheme variants."""
    bare = F.regexp_replace("url", "^https?://", "")
    variants = [
        F.col("url"),
        F.concat(F.lit("http://"), bare),
        F.concat(F.lit("www."), bare),
        F.concat(F.lit("HTTP://"), bare),
        F.concat(F.lit("ftp://"), bare),
        bare,
        F.concat(F.lit(" "), "url"),
        F.concat(F.lit("https://"), bare, F.lit("/a/b?c/d")),
        F.lit("www."),
        F.concat("url", F.lit("?x=1?y=2")),
    ]
    pick = F.element_at(F.array(*variants), (F.col("page_id") % 10 + 1).cast("int"))
    return fx.table(spark, sf_dir, "pages").select("page_id", pick.alias("url"))


PAGE_URLS = """
variants AS (
  SELECT page_id, CASE page_id % 10
    WHEN 0 THEN url WHEN 1 THEN 'http://' || bare WHEN 2 THEN 'www.' || bare WHEN 3 THEN 'HTTP://' || bare
    WHEN 4 THEN 'ftp://' || bare WHEN 5 THEN bare WHEN 6 THEN ' ' || url
    WHEN 7 THEN 'https://' || bare || '/a/b?c/d' WHEN 8 THEN 'www.' ELSE url || '?x=1?y=2' END AS url
  FROM (SELECT page_id, url, regexp_replace(url, '^https?://', '') AS bare FROM pages)
)"""


def url_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_urls(spark, sf_dir).select("page_id", urls.with_https(F.col("url")).alias("url"))


def url_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_urls(spark, sf_dir).select("page_id", urls.first_parts(F.col("url")).alias("url"))


def url_strip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_urls(spark, sf_dir).select("page_id", urls.strip_query(F.col("url")).alias("url"))


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = classify(fx.organisations(spark, sf_dir)).filter("url_status = 'valid'")
    return urls.page_targets(valid.select("name", "base_url"), SPEC)


def page_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _targets(spark, sf_dir)


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = fx.captured_pages(spark, sf_dir).withColumn("is_old", F.col("html").contains("An earlier capture"))
    return lookup(_targets(spark, sf_dir), latest_capture(captures.drop("html")))


def page_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir).select(
        "name",
        "page_kind",
        "target_url",
        F.col("requested_url").isNotNull().alias("captured"),
        "final_url",
        text.iso_text(F.col("captured_at")).alias("captured_at"),
        "is_old",
    )


def redirect_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    final, target = F.col("final_url"), F.col("target_url")
    return (
        _found(spark, sf_dir)
        .filter("requested_url is not null")
        .select(
            "target_url",
            urls.is_redirected(final, target).alias("redirected"),
            urls.is_unavailable(final, target, SPEC).alias("unavailable"),
        )
    )


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.profiles(spark, sf_dir).select(
        "k", "n_kw", "n_all", fx.number(F.col("n_kw")).alias("kw"), fx.number(F.col("n_all")).alias("all")
    )


def digits_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("k") % 3 == 0, F.lit("no digits")).otherwise(F.concat(F.lit("~ "), "all", F.lit(" members")))
    return _numbers(spark, sf_dir).select("k", values.or_missing(text.digits_only(raw)).alias("digits"))


def size_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (
        F.when(F.col("k") % 5 == 0, F.lit("-"))
        .when(F.col("k") % 5 == 1, F.lit(None).cast("string"))
        .when(F.col("k") % 5 == 2, F.lit("Self employed"))
        .when(F.col("k") % 5 == 3, F.concat(F.lit("'"), "kw", F.lit("K-"), "all", F.lit("+")))
        .otherwise(F.concat("kw", F.lit("–"), "all"))
    )
    return _numbers(spark, sf_dir).select("k", text.size_clean(raw).alias("size"))


def size_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (
        F.when(F.col("k") % 4 == 0, F.concat("kw", F.lit("-"), "all", F.lit("  employees")))
        .when(F.col("k") % 4 == 1, F.concat("all", F.lit("+ EMPLOYEES, not all employees listed")))
        .when(F.col("k") % 4 == 2, F.concat("all", F.lit(" staff")))
        .otherwise(F.concat(F.lit("about\n "), "all", F.lit(" \nEmployees")))
    )
    return _numbers(spark, sf_dir).select("k", text.size_extract(raw).alias("size"))


def members_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (
        F.when(F.col("k") % 4 == 0, F.concat("all", F.lit(" associated members on the site")))
        .when(F.col("k") % 4 == 1, F.concat("kw", F.lit(" of "), "all", F.lit("Associated Member")))
        .when(F.col("k") % 4 == 2, F.concat("all", F.lit(" members")))
        .otherwise(F.concat(F.lit("Acme: "), "all", F.lit(" \n associated members")))
    )
    return _numbers(spark, sf_dir).select("k", values.or_missing(text.members_extract(raw)).alias("members"))


def time_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate").cast("timestamp_ntz"))
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", values.default_time(text.iso_text(ts), fx.RUN_TS).alias("time_stamp")
    )


def null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values.fill_missing(fx.organisations(spark, sf_dir))


def numeric_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    ordered = fx.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    joined = customers.join(ordered, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
    return values.fill_missing(values.numbers_to_text(joined))


QUERIES = {
    "org_list_scan": Query(
        org_list_scan,
        with_ctes(
            ORGS,
            select="""
SELECT CASE WHEN k % 7 = 0 THEN NULL ELSE name || ', "é"' END AS name, profile_url FROM orgs""",
        ),
    ),
    "optional_column": Query(
        optional_column, "SELECT s_name AS name, '' AS profile_url, 'blank' AS url_status FROM supplier"
    ),
    "url_status": Query(url_status, with_ctes(ORGS, select="SELECT name, profile_url, url_status, base_url FROM orgs")),
    "org_rejects": Query(
        org_rejects,
        with_ctes(
            ORGS,
            select="SELECT name, profile_url, 'no profile URL' AS reason FROM orgs WHERE url_status = 'null'",
        ),
    ),
    "url_normalise": Query(
        url_normalise,
        with_ctes(
            PAGE_URLS,
            select="""
SELECT page_id, CASE WHEN url LIKE 'http://%' THEN 'https://' || substr(url, 8)
  WHEN url LIKE 'www.%' THEN 'https://' || url WHEN url LIKE 'https://%' THEN url END AS url
FROM variants""",
        ),
    ),
    "url_truncate": Query(
        url_truncate,
        with_ctes(
            PAGE_URLS,
            select="SELECT page_id, array_to_string(list_slice(string_split(url, '/'), 1, 5), '/') AS url FROM variants",
        ),
    ),
    "url_strip_query": Query(
        url_strip_query, with_ctes(PAGE_URLS, select="SELECT page_id, split_part(url, '?', 1) AS url FROM variants")
    ),
    "page_targets": Query(
        page_targets,
        with_ctes(ORGS, PAGES, select="SELECT name, base_url, page_kind, target_url FROM targets"),
    ),
    "page_lookup": Query(
        page_lookup,
        with_ctes(
            ORGS,
            PAGES,
            select="""
SELECT name, page_kind, target_url, captured, final_url, stamp AS captured_at,
       CASE WHEN captured THEN false END AS is_old
FROM visits""",
        ),
    ),
    "redirect_class": Query(
        redirect_class,
        with_ctes(
            ORGS,
            PAGES,
            select="""
SELECT target_url, variant IN (4, 5) AS redirected, variant = 4 AS unavailable FROM visits WHERE captured""",
        ),
    ),
    "digits_only": Query(
        digits_only,
        with_ctes(
            BARS,
            select="SELECT k, CASE WHEN k % 3 = 0 THEN '-' ELSE n_all::VARCHAR END AS digits FROM totals",
        ),
    ),
    "size_clean": Query(
        size_clean,
        with_ctes(
            BARS,
            select="""
SELECT k, CASE k % 5 WHEN 0 THEN '-' WHEN 1 THEN '-' WHEN 2 THEN ''''
  WHEN 3 THEN '''' || n_kw || '-' || n_all ELSE '''' || n_kw || n_all END AS size
FROM totals""",
        ),
    ),
    "size_extract": Query(
        size_extract,
        with_ctes(
            BARS,
            select="""
SELECT k, CASE k % 4 WHEN 0 THEN '''' || format('{:,}', n_kw) || '-' || format('{:,}', n_all)
  WHEN 1 THEN '''' || format('{:,}', n_all) || '+ EMPLOYEES, not all'
  WHEN 2 THEN NULL ELSE '''' || format('{:,}', n_all) END AS size
FROM totals""",
        ),
    ),
    "members_extract": Query(
        members_extract,
        with_ctes(
            BARS,
            select="SELECT k, CASE k % 4 WHEN 2 THEN '-' ELSE format('{:,}', n_all) END AS members FROM totals",
        ),
    ),
    "time_default": Query(
        time_default,
        f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '{fx.RUN_TS}'
  ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN microsecond(o_orderdate) % 1000000 = 0 THEN '' ELSE strftime(o_orderdate, '.%f') END END AS time_stamp
FROM orders""",
    ),
    "null_fill": Query(
        null_fill, with_ctes(ORGS, select="SELECT k, name, coalesce(profile_url, '-') AS profile_url FROM orgs")
    ),
    "numeric_to_string": Query(
        numeric_to_string,
        """
SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey,
       coalesce(n_orders::VARCHAR, '-') AS n_orders
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey)
  ON c_custkey = o_custkey""",
    ),
}
