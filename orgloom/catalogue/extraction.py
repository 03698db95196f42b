"""Queries on pages: node table, extraction and the record datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.catalogue import inputs as fx
from orgloom.catalogue.shared import ABOUT_SQL, BARS, ORGS, PAGES, SPEC, Query, people_sql, with_ctes
from orgloom.functions.values import or_missing
from orgloom.operators import extract
from orgloom.operators.nodes import node_table, with_nodes
from orgloom.operators.order import dense_numbers
from orgloom.plans.extraction import extract_about, extract_datasets, extract_facet, page_facts, parsed_pages, write_datasets
from orgloom.plans.jobs import run_extraction
from orgloom.schemas import DATASETS, NAME_COLUMN, URL_COLUMN
from orgloom.session import work_dir
from orgloom.sinks.tables import write_csv
from orgloom.sources.pages import as_pages, spread
from orgloom.sources.records import read_records
from orgloom.streaming.facts import collect_facts, stored_facts



def _real(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = as_pages(fx.table(spark, sf_dir, "pages")).select("requested_url", "html")
    return spread(pages, spark.sparkContext.defaultParallelism)  # a single file


def page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All elements with all their text; its characters, sorted, tell texts of equal length apart."""
    nodes = node_table(with_nodes(_real(spark, sf_dir), SPEC, all_tags=True, all_texts=True))
    raw = F.sort_array(F.split(F.array_join(F.collect_list("text_raw"), ""), ""))
    return nodes.groupBy(F.col("requested_url").alias("url"), "tag").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("text_raw")).alias("raw_chars"),
        F.sum(F.length("text_stripped")).alias("stripped_chars"),
        F.md5(F.array_join(raw, "")).alias("chars_md5"),
        F.sum(F.size(F.map_filter("attrs", lambda k, v: k == "href"))).alias("links"),
    )


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every element, that of the elements inside included."""
    nodes = node_table(with_nodes(_real(spark, sf_dir), SPEC, all_tags=True, all_texts=True))
    return nodes.groupBy(F.col("requested_url").alias("url"), "tag").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("text_raw")).alias("raw_chars"),
        F.sum(F.length("text_stripped")).alias("stripped_chars"),
    )


def first_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_nodes(_real(spark, sf_dir), SPEC).select(
        F.col("requested_url").alias("url"), extract.first_heading(F.col("page")).alias("heading")
    )


def page_has_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = with_nodes(_real(spark, sf_dir), SPEC, all_tags=True, text_tags=frozenset())
    return nodes.select(
        F.col("requested_url").alias("url"),
        extract.has_class(F.col("page"), "ad").alias("has_ad"),
        extract.has_class(F.col("page"), SPEC.bar_class).alias("has_bars"),
    )


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of all rendered pages, earlier captures too."""
    return with_nodes(fx.captured_pages(spark, sf_dir).select("requested_url", "html"), SPEC)


def first_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered(spark, sf_dir).select("requested_url", extract.page_title(F.col("page"), SPEC).alias("title"))


def header_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered(spark, sf_dir).select(
        "requested_url", or_missing(extract.header_members(F.col("page"), SPEC)).alias("members")
    )


def dt_dd_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _rendered(spark, sf_dir).select("requested_url", F.inline(extract.dt_dd_pairs(F.col("page"))))
    return pairs.select("requested_url", "heading", "dd", "next_dd")


def profile_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _rendered(spark, sf_dir)
        .withColumn("pairs", extract.dt_dd_pairs(F.col("page"), SPEC.headings))
        .withColumn("profile_values", extract.profile_values(F.col("pairs")))
        .select("requested_url", extract.profile_fields(F.col("profile_values"), SPEC).alias("profile"))
        .select("requested_url", "profile.*")
    )


def facet_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    facets = F.array(
        *(
            F.struct(F.lit(facet).alias("facet"), extract.facet_bars(F.col("page"), index, SPEC).alias("bars"))
            for facet, index in (("locations", SPEC.locations_index), ("roles", SPEC.roles_index))
        )
    )
    rows = _rendered(spark, sf_dir).select("requested_url", F.inline(facets))
    return rows.select(
        "requested_url", "facet", F.posexplode("bars").alias("pos", "bar")
    ).select("requested_url", "facet", F.col("pos").cast("bigint").alias("pos"), "bar.label", "bar.count")


def facet_bars_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    def unlabelled(facet: str):
        return extract.has_unlabelled_bar(F.col(facet))

    def without(facet: str, part: str):
        return F.size(F.filter(facet, lambda b: b[part] == "-")).cast("bigint")

    return page_facts(fx.captured_pages(spark, sf_dir), SPEC).select(
        "requested_url",
        "has_bars",
        unlabelled("locations").alias("bad_locations"),
        unlabelled("roles").alias("bad_roles"),
        without("locations", "label").alias("without_label"),
        without("locations", "count").alias("without_count"),
    )


FLAT = (
    "dataset, outcome, input_company_name, company_name, profile_url, targeted_url, redirected_url, error, "
    "time_stamp, members"
).split(", ")


def _flat(records: DataFrame) -> DataFrame:
    """Records with the list as its labels and counts in order."""
    listed = F.transform("items", lambda i: F.concat(i["label"], F.lit("="), i["count"]))
    return records.select(*FLAT, F.array_join(listed, "|").alias("listed"), "items_missing")


def _facet(facet: str, keyword: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        orgs, pages = fx.organisations(spark, sf_dir), fx.captured_pages(spark, sf_dir)
        return _flat(extract_facet(orgs, pages, fx.RUN_TS, facet, keyword))

    return Query(run, with_ctes(ORGS, BARS, PAGES, select=people_sql(facet, keyword)))


def about_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    orgs, pages = fx.organisations(spark, sf_dir), fx.captured_pages(spark, sf_dir)
    return extract_about(orgs, pages, fx.RUN_TS).drop("items", "items_missing")


def _shown(key: str):
    return lambda entry: F.concat(entry[key], F.lit("="), entry["Count"])


def extraction_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole extraction job from a CSV list, and its five JSON datasets as they are read back."""
    listed, captured, out = (work_dir(spark, f"extraction-{x}") for x in ("list", "pages", "out"))
    orgs = fx.organisations(spark, sf_dir).select(F.col("name").alias(NAME_COLUMN), F.col("profile_url").alias(URL_COLUMN))
    write_csv(orgs, listed)
    fx.captured_pages(spark, sf_dir).write.parquet(captured)
    places = run_extraction(spark, listed, captured, out, fx.RUN_TS)
    parts = []
    for name, d in DATASETS.items():
        rows = read_records(spark, places[name], d)
        no_list = F.lit(False), F.lit(None).cast("string")
        if d.facet:
            entries = F.try_variant_get(F.col(d.list_key), "$", f"array<struct<Count:string,{d.label_key}:string>>")
            shown = F.transform(entries, _shown(d.label_key))
            is_text = F.coalesce(F.schema_of_variant(F.col(d.list_key)) == "STRING", F.lit(False))
            no_list = is_text, F.array_join(shown, "|")
        members = F.col(f"`{d.members_key or 'No. of associated members'}`")
        parts.append(
            rows.select(
                F.lit(name).alias("dataset"), "input_company_name", F.col("Company Name").alias("company_name"),
                F.col("LinkedIn URL").alias("profile_url"), F.col("Time Stamp").alias("time_stamp"),
                F.col("Redirected to URL").alias("redirected_url"), members.alias("members"),
                no_list[0].alias("list_is_text"), no_list[1].alias("listed"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def source_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of pages that were captured without a source, or with one that can't be parsed."""
    orgs = fx.organisations(spark, sf_dir).filter("k div 10 % 10 = 0")
    key = F.regexp_extract("requested_url", r"/(?:company/|o)\d*(\d)[/?]", 1)
    broken = F.when(key == "0", F.lit(None).cast("string")).when(key == "1", "<h1>x</h1><![no[").otherwise(F.col("html"))
    records = extract_datasets(orgs, fx.captured_pages(spark, sf_dir).withColumn("html", broken), fx.RUN_TS)
    kind = F.when(F.col("error").isin("no page source", "no h1 on page"), F.col("error")).when(F.col("error").isNotNull(), "other")
    return records.select("dataset", "input_company_name", "outcome", kind.alias("error"), "items_missing")


def extract_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five datasets from facts that were collected in two runs, each of which parsed what was new."""
    orgs, pages = fx.organisations(spark, sf_dir), fx.captured_pages(spark, sf_dir)
    landing, store, seen = (work_dir(spark, f"facts-{x}") for x in ("landing", "store", "checkpoint"))
    first = F.col("captured_at") < F.lit("2024-05-01 00:00:40").cast("timestamp_ntz")
    for part in (first, ~first):
        pages.filter(part).write.mode("append").parquet(landing)
        collect_facts(spark, landing, store, seen)
    return _flat(extract_datasets(orgs, stored_facts(spark, store), fx.RUN_TS))


def extract_from_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five datasets from a stored table of nodes."""
    orgs, path = fx.organisations(spark, sf_dir), work_dir(spark, "nodes")
    parsed_pages(fx.captured_pages(spark, sf_dir), SPEC).write.parquet(path)
    return _flat(extract_datasets(orgs, spark.read.parquet(path), fx.RUN_TS))


def record_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five datasets written by three appends, a third of the list each, and the order in which they are read."""
    orgs = fx.organisations(spark, sf_dir).withColumnRenamed("k", "position")
    pages, out = fx.captured_pages(spark, sf_dir), work_dir(spark, "positions")
    for third in (2, 0, 1):
        part = orgs.filter(F.col("position") % 3 == third)
        places = write_datasets(extract_datasets(part, pages, fx.RUN_TS), out, append=True)
    numbered = []
    for name, place in places.items():
        rows = read_records(spark, place, DATASETS[name], with_order=True)
        copy = work_dir(spark, "ordered")
        rows.select("record_order.*", "input_company_name", F.col("Company Name").alias("company_name")).write.parquet(copy)
        dense = dense_numbers(spark.read.parquet(copy).drop("pos"), ["append", "part", "file", "block"])
        numbered.append(dense.select(F.lit(name).alias("dataset"), "input_company_name", "company_name", "position"))
    return reduce(DataFrame.unionByName, numbered)


def five_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orgs, pages = fx.organisations(spark, sf_dir), fx.captured_pages(spark, sf_dir)
    return _flat(extract_datasets(orgs, pages, fx.RUN_TS))


def record_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    orgs, pages = fx.organisations(spark, sf_dir), fx.captured_pages(spark, sf_dir)
    return extract_datasets(orgs, pages, fx.RUN_TS).groupBy("dataset", "outcome").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("error").alias("errors"),
        F.count("redirected_url").alias("redirected"),
        F.count("members").alias("with_members"),
    )


_PEOPLE = [(f, k) for f in ("locations", "roles") for k in (True, False)]
_ALL_RECORDS = "\nUNION ALL\n".join(
    [
        f"SELECT {', '.join(FLAT)}, NULL::VARCHAR AS listed, "
        f"CASE WHEN outcome = 'placeholder' THEN false END AS items_missing FROM ({ABOUT_SQL})",
        *(f"SELECT {', '.join(FLAT)}, listed, items_missing FROM ({people_sql(f, k)})" for f, k in _PEOPLE),
    ]
)

# the last entity of a heading may lack its semicolon
_TEXT = (
    "regexp_replace(regexp_replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), "
    "'&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"
)


# Every text node counts for all elements that are open around it. An end tag closes back
# to its nearest open match; scripts and styles have no text.
PAGE_TEXTS_SQL = f"""
WITH RECURSIVE cleaned AS (
  SELECT page_id, url, regexp_replace(regexp_replace(html, '(<script[^>]*>).*?(</script>)', '\\1\\2', 'gs'),
    '(<style[^>]*>).*?(</style>)', '\\1\\2', 'gs') AS html FROM pages
),
pieces AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<!--.*?-->|<[^>]*>|[^<]+')) AS piece,
         generate_subscripts(regexp_extract_all(html, '<!--.*?-->|<[^>]*>|[^<]+'), 1) AS i FROM cleaned
),
tokens AS (
  SELECT page_id, url, i, regexp_extract(piece, '^</?([a-z][a-z0-9]*)', 1) AS tag, starts_with(piece, '</') AS closes,
         CASE WHEN NOT starts_with(piece, '<') THEN {_TEXT.format("piece")} END AS text FROM pieces
),
walk AS (
  SELECT DISTINCT page_id, 1::BIGINT AS i, []::VARCHAR[] AS around FROM pieces
  UNION ALL
  SELECT page_id, i + 1, CASE
    WHEN tag = '' OR tag IN ('br', 'hr', 'img', 'input', 'link', 'meta') THEN around
    WHEN NOT closes THEN list_append(around, tag)
    WHEN list_contains(around, tag) THEN list_slice(around, 1, len(around) - list_position(list_reverse(around), tag))
    ELSE around END
  FROM walk JOIN tokens USING (page_id, i)
),
inside AS (
  SELECT url, unnest(around) AS tag, CASE WHEN trim(text, E' \\n') <> '' THEN text WHEN contains(text, E'\\n') THEN E'\\n' ELSE ' ' END AS text
  FROM walk JOIN tokens USING (page_id, i) WHERE text IS NOT NULL
),
chars AS (
  SELECT url, tag, sum(length(text))::BIGINT AS raw_chars, sum(length(trim(text, E' \\n')))::BIGINT AS stripped_chars
  FROM inside GROUP BY url, tag
)
SELECT url, tag, n, coalesce(raw_chars, 0) AS raw_chars, coalesce(stripped_chars, 0) AS stripped_chars
FROM (SELECT url, tag, count(*) AS n FROM tokens WHERE tag <> '' AND NOT closes GROUP BY url, tag) LEFT JOIN chars USING (url, tag)"""

PAGE_NODES_SQL = PAGE_TEXTS_SQL.replace(
    "  SELECT url, tag, sum(length(text))",
    "  SELECT url, tag, md5(array_to_string(list_sort(string_split(string_agg(text, ''), '')), '')) AS chars_md5, sum(length(text))",
).replace(
    "AS stripped_chars\nFROM (", f"AS stripped_chars,\n  coalesce(chars_md5, md5('')) AS chars_md5, CASE WHEN tag = 'a' THEN n ELSE 0 END AS links\nFROM ("
)

VISITED = "FROM visits JOIN totals USING (k, name) WHERE captured"
# an earlier capture of each page of these organisations has a heading and nothing else
EARLIER = "FROM visits WHERE variant = 2"

QUERIES = {
    "page_nodes": Query(page_nodes, PAGE_NODES_SQL),
    "page_texts": Query(page_texts, PAGE_TEXTS_SQL),
    "first_heading": Query(
        first_heading,
        f"SELECT url, trim({_TEXT.format("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}) AS heading FROM pages",
    ),
    "page_has_class": Query(
        page_has_class, "SELECT url, html LIKE '%<div class=\"ad\">%' AS has_ad, false AS has_bars FROM pages"
    ),
    "first_by_class": Query(
        first_by_class,
        with_ctes(
            ORGS,
            BARS,
            PAGES,
            select=f"""
SELECT target_url AS requested_url,
       CASE WHEN page_kind <> 'about' AND variant <> 6 THEN name || ' & Co' END AS title {VISITED}
UNION ALL SELECT target_url, NULL {EARLIER}""",
        ),
    ),
    "header_members": Query(
        header_members,
        with_ctes(
            ORGS,
            BARS,
            PAGES,
            select=f"""
SELECT target_url AS requested_url, CASE WHEN page_kind = 'about' OR variant = 8 THEN '-'
  ELSE format('{{:,}}', CASE page_kind WHEN 'people' THEN n_all ELSE n_kw END) END AS members {VISITED}
UNION ALL SELECT target_url, '-' {EARLIER}""",
        ),
    ),
    "dt_dd_pairs": Query(
        dt_dd_pairs,
        with_ctes(
            ORGS,
            BARS,
            PAGES,
            select=f"""
, rows AS (
  SELECT target_url AS requested_url, variant, 'https://www.' || k || '.example.com' AS website, nation AS industry,
    format('{{:,}}', n_kw) || '-' || format('{{:,}}', n_all) || ' employees' AS size,
    format('{{:,}}', n_all) || ' associated members' AS members, nation || 'City' AS place,
    (1900 + k % 100)::VARCHAR AS founded, types {VISITED} AND page_kind = 'about'
)
SELECT requested_url, 'Website' AS heading, website AS dd,
       CASE WHEN variant = 1 THEN 'Superseded' ELSE industry END AS next_dd FROM rows
UNION ALL SELECT requested_url, 'Industry', 'Superseded', industry FROM rows WHERE variant = 1
UNION ALL SELECT requested_url, 'Industry', industry, size FROM rows
UNION ALL SELECT requested_url, 'Company size', size, members FROM rows
UNION ALL SELECT requested_url, 'Phone', place, founded FROM rows
UNION ALL SELECT requested_url, 'Headquarters', place, founded FROM rows
UNION ALL SELECT requested_url, 'Founded', founded, CASE WHEN variant <> 8 THEN types END FROM rows
UNION ALL SELECT requested_url, 'Specialties', types, NULL FROM rows WHERE variant <> 8""",
        ),
    ),
    "profile_fields": Query(
        profile_fields,
        with_ctes(
            ORGS,
            BARS,
            PAGES,
            select=f"""
SELECT target_url AS requested_url,
  CASE page_kind WHEN 'about' THEN 'https://www.' || k || '.example.com' ELSE '-' END AS website,
  CASE page_kind WHEN 'about' THEN nation ELSE '-' END AS industry,
  CASE page_kind WHEN 'about' THEN '''' || format('{{:,}}', n_kw) || '-' || format('{{:,}}', n_all) ELSE '-' END AS company_size,
  CASE page_kind WHEN 'about' THEN format('{{:,}}', n_all) ELSE '-' END AS members,
  CASE page_kind WHEN 'about' THEN nation || 'City' ELSE '-' END AS headquarters,
  CASE page_kind WHEN 'about' THEN (1900 + k % 100)::VARCHAR ELSE '-' END AS founded,
  CASE WHEN page_kind = 'about' AND variant <> 8 THEN types ELSE '-' END AS specialties {VISITED}
UNION ALL SELECT target_url, '-', '-', '-', '-', '-', '-', '-' {EARLIER}""",
        ),
    ),
    "facet_bars": Query(
        facet_bars,
        with_ctes(
            ORGS,
            BARS,
            PAGES,
            select="""
, shown AS (
  SELECT k, target_url AS requested_url, variant, CASE page_kind WHEN 'people' THEN '_all' ELSE '_kw' END AS ending
  FROM visits WHERE captured AND page_kind <> 'about' AND variant <> 7
),
sizes AS (SELECT k, dataset, count(*) AS n_bars FROM placed GROUP BY k, dataset)
SELECT requested_url, replace(dataset, ending, '') AS facet, pos, label, format('{:,}', n) AS count
FROM shown JOIN placed USING (k) WHERE ends_with(dataset, ending)
UNION ALL
SELECT requested_url, 'locations', coalesce(n_bars, 0) + step, CASE step WHEN 0 THEN 'No count' ELSE '-' END,
       CASE step WHEN 0 THEN '-' ELSE '7' END
FROM shown CROSS JOIN (VALUES (0), (1)) steps(step)
LEFT JOIN sizes ON sizes.k = shown.k AND dataset = 'locations' || ending WHERE variant = 1
UNION ALL
SELECT requested_url, 'roles', coalesce(n_bars, 0), NULL, '-'
FROM shown LEFT JOIN sizes ON sizes.k = shown.k AND dataset = 'roles' || ending WHERE variant = 9""",
        ),
    ),
    "facet_bars_edge": Query(
        facet_bars_edge,
        with_ctes(
            ORGS,
            BARS,
            PAGES,
            select=f"""
SELECT target_url AS requested_url, page_kind <> 'about' AND variant <> 7 AS has_bars, false AS bad_locations,
  page_kind <> 'about' AND variant = 9 AS bad_roles,
  CASE WHEN page_kind <> 'about' AND variant = 1 THEN 1 ELSE 0 END::BIGINT AS without_label,
  CASE WHEN page_kind <> 'about' AND variant = 1 THEN 1 ELSE 0 END::BIGINT AS without_count {VISITED}
UNION ALL SELECT target_url, false, false, false, 0, 0 {EARLIER}""",
        ),
    ),
    "about_extract": Query(about_extract, with_ctes(ORGS, BARS, PAGES, select=ABOUT_SQL)),
    **{f"{f}_{'kw' if k else 'all'}": _facet(f, k) for f, k in _PEOPLE},
    "extraction_written": Query(
        extraction_written,
        with_ctes(
            ORGS,
            BARS,
            PAGES,
            select=f"""
SELECT dataset, input_company_name, company_name, profile_url, time_stamp, redirected_url, members,
       coalesce(items_missing, false) AS list_is_text, listed
FROM ({_ALL_RECORDS})""",
        ),
    ),
    "source_errors": Query(
        source_errors,
        with_ctes(
            ORGS,
            BARS,
            PAGES,
            select="""
, listed AS (
  SELECT dataset, page_kind, k, name FROM visits JOIN (VALUES ('about', 'about'), ('locations_kw', 'people_kw'),
    ('locations_all', 'people'), ('roles_kw', 'people_kw'), ('roles_all', 'people')) d(dataset, page_kind) USING (page_kind)
  WHERE variant = 0
)
SELECT dataset, name AS input_company_name,
  CASE WHEN k % 10 = 1 AND dataset = 'about' THEN 'exception' WHEN k % 10 < 2 THEN 'not_loaded' ELSE 'ok' END AS outcome,
  CASE WHEN dataset = 'about' THEN CASE k % 10 WHEN 0 THEN 'no page source' WHEN 1 THEN 'other' END END AS error,
  CASE WHEN dataset <> 'about' THEN k % 10 < 2 END AS items_missing
FROM listed
UNION ALL
SELECT dataset, NULL, 'placeholder', NULL, false FROM orgs
CROSS JOIN (VALUES ('about'), ('locations_kw'), ('locations_all'), ('roles_kw'), ('roles_all')) d(dataset)
WHERE url_status IN ('blank', 'invalid') AND k // 10 % 10 = 0""",
        ),
    ),
    "extract_incremental": Query(extract_incremental, with_ctes(ORGS, BARS, PAGES, select=_ALL_RECORDS)),
    "extract_from_nodes": Query(extract_from_nodes, with_ctes(ORGS, BARS, PAGES, select=_ALL_RECORDS)),
    "record_positions": Query(
        record_positions,
        with_ctes(
            ORGS,
            BARS,
            PAGES,
            select=f"""
SELECT dataset, input_company_name, company_name,
       row_number() OVER (PARTITION BY dataset ORDER BY (k + 1) % 3, k) - 1 AS position
FROM ({_ALL_RECORDS}) JOIN (SELECT s_suppkey AS k, s_name FROM supplier) ON s_name = coalesce(input_company_name, company_name)""",
        ),
    ),
    "five_datasets": Query(five_datasets, with_ctes(ORGS, BARS, PAGES, select=_ALL_RECORDS)),
    "record_outcome": Query(
        record_outcome,
        with_ctes(
            ORGS,
            BARS,
            PAGES,
            select=f"""
SELECT dataset, outcome, count(*) AS n, count(error) AS errors, count(redirected_url) AS redirected,
       count(members) AS with_members
FROM ({_ALL_RECORDS}) GROUP BY dataset, outcome""",
        ),
    ),
}
