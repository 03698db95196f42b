"""Queries on records: list shapes, long and wide tables, writing and appending."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.catalogue import inputs as fx
from orgloom.catalogue.shared import BARS, Query, items_sql, with_ctes
from orgloom.functions.values import members_column, or_missing
from orgloom.operators import reshape
from orgloom.operators.order import in_order
from orgloom.plans import tables
from orgloom.plans.jobs import run_conversion
from orgloom.plans.store import append_records, export_tables, label_names, stored_table
from orgloom.schemas import ABOUT_COLUMNS, ALL_MEMBERS, DATASETS, KEYWORD_MEMBERS
from orgloom.session import work_dir
from orgloom.sinks.tables import append_by_name, append_csv, write_csv, write_records
from orgloom.sources.org_list import read_csv_text
from orgloom.sources.records import read_optional, read_records
from orgloom.streaming.ingest import ingest_records


def _records(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    return read_records(spark, fx.records_path(spark, sf_dir, name), DATASETS[name], **options)


def records_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.schema_of_variant("Roles")
    return _records(spark, sf_dir, "roles_all").select(
        "input_company_name",
        F.col("Company Name").alias("company_name"),
        F.col("Redirected to URL").alias("redirected_url"),
        F.regexp_extract(kind, "^[A-Z]+", 0).alias("list_kind"),
        F.coalesce(F.size(F.try_variant_get("Roles", "$", "array<variant>")), F.lit(-1)).cast("bigint").alias("n_items"),
    )


def optional_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    about = DATASETS["about"]
    there = read_optional(spark, fx.records_path(spark, sf_dir, "about"), about)
    absent = read_optional(spark, work_dir(spark, "never-written"), about)
    return there.unionByName(absent).select(F.col("Company Name").alias("company_name"), F.col("Industry").alias("industry"))


def list_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = DATASETS["roles_all"]
    rows = reshape.explode_items(tables.with_items(_records(spark, sf_dir, dataset.name), dataset))
    return rows.select("input_company_name", F.col("pos").cast("bigint").alias("pos"), "label", "count", "is_entry")


def field_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"input_company_name": "input_name", "Industry": "industry", "Company size": "size", "Headquarters": "headquarters"}
    return _records(spark, sf_dir, "about").select(
        F.col("Company Name").alias("company_name"), *(or_missing(F.col(c)).alias(a) for c, a in columns.items())
    )


def members_of_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        _records(spark, sf_dir, name).select(
            F.lit(name).alias("dataset"),
            "input_company_name",
            or_missing(members_column(_records(spark, sf_dir, name), keyword)).alias("members"),
        )
        for name, keyword in (("roles_kw", True), ("roles_all", False), ("locations_kw", True), ("locations_all", False))
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def about_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.about_table(_records(spark, sf_dir, "about"), fx.RUN_TS)


def roles_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.roles_long(_records(spark, sf_dir, "roles_all"), False, fx.RUN_TS)


def roles_long_kw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.roles_long(_records(spark, sf_dir, "roles_kw"), True, fx.RUN_TS)


def locations_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.locations_long(_records(spark, sf_dir, "locations_all"), False, fx.RUN_TS)


def locations_long_kw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.locations_long(_records(spark, sf_dir, "locations_kw"), True, fx.RUN_TS)


def locations_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir, "locations_all")
    return tables.locations_long(records, False, fx.RUN_TS, fallback_members=False)


def roles_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.roles_wide(_records(spark, sf_dir, "roles_all"), False, fx.RUN_TS, column_order="name")


def roles_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.wide_map(_records(spark, sf_dir, "roles_all"), DATASETS["roles_all"], fx.RUN_TS)
    return rows.select(F.col("Input Company Name").alias("name"), F.inline(F.map_entries("counts")).alias("label", "count"))


def _grown_store(spark: SparkSession, sf_dir: str) -> str:
    """A store of three appends; some roles are in the later ones only."""

    def write(store: str) -> None:
        for k, kept in enumerate(("< 4", "in (4, 5, 6, 7)", "> 7")):
            landed = work_dir(spark, f"landed-{k}")
            for name, dataset in DATASETS.items():
                records = _records(spark, sf_dir, name, with_order=True)
                shape = F.regexp_extract(F.coalesce("input_company_name", "Company Name"), r"(\d)( & Co)?$", 1)
                mine = records.withColumn("shape", shape.cast("int")).filter(f"shape {kept}")
                mine = in_order(mine, "record_order")
                write_records(mine.drop("shape", "record_order"), f"{landed}/{dataset.file_name}")
            append_records(spark, landed, store, fx.RUN_TS)

    return fx.written(spark, sf_dir, "store", write)


def store_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table of a store whose roles grew, as exported."""
    places = export_tables(spark, _grown_store(spark, sf_dir), work_dir(spark, "exported"))
    return read_csv_text(spark, places[DATASETS["roles_all"].table_name])


def store_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_table(spark, _grown_store(spark, sf_dir), DATASETS["roles_all"], "long")


def store_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roles of a grown store in the order in which they were first seen."""
    dataset = DATASETS["roles_all"]
    names = label_names(spark, _grown_store(spark, sf_dir), dataset)
    return spark.createDataFrame(list(enumerate(names)), "place long, label string")


def role_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = DATASETS["roles_all"]
    # by the order in which the records were written, that of the organisations' keys
    records = tables.with_items(_records(spark, sf_dir, dataset.name, with_order=True), dataset)
    named = records.withColumn("place", F.struct("record_order", "input_company_name"))
    found = reshape.role_columns(named, order="place")
    return found.select(
        "label",
        F.col("first_seen.record.input_company_name").alias("first_record"),
        F.col("first_seen.pos").cast("bigint").alias("first_pos"),
    )


def _converted(spark: SparkSession, sf_dir: str, roles_form: str) -> dict[str, DataFrame]:
    """The five tables by name, as the whole job stored them: every cell is made and written."""
    places = run_conversion(
        spark, fx.records_dir(spark, sf_dir), work_dir(spark, f"converted-{roles_form}"), fx.RUN_TS, roles_form
    )
    return {name: read_csv_text(spark, place) for name, place in places.items()}


def _sizes(stored: dict[str, DataFrame]) -> DataFrame:
    parts = [
        table.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(table.columns)).cast("bigint").alias("n_columns")
        )
        for name, table in stored.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _rows(stored: dict[str, DataFrame]) -> DataFrame:
    """All rows of all tables; the cells of a row by column name."""

    def cells(table: DataFrame):
        return [F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`"), F.lit(""))) for c in sorted(table.columns)]

    parts = [t.select(F.lit(n).alias("table_name"), F.concat_ws("|", *cells(t)).alias("cells")) for n, t in stored.items()]
    return reduce(DataFrame.unionByName, parts)


def convert_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sizes(_converted(spark, sf_dir, "wide"))


def convert_all_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sizes(_converted(spark, sf_dir, "long"))


def convert_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(_converted(spark, sf_dir, "wide"))


def convert_all_long_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(_converted(spark, sf_dir, "long"))


def _people_columns(records: DataFrame) -> DataFrame:
    """Name, members and the list that was written, as labels and counts in order."""
    rows = tables.with_items(records, DATASETS["roles_all"])
    part = lambda i, name: or_missing(i[name])
    listed = F.transform("items", lambda i: F.concat(part(i, "label"), F.lit("="), part(i, "count")))
    return rows.select(
        "input_company_name",
        F.col(ALL_MEMBERS).alias("members"),
        F.coalesce(F.array_join(listed, "|"), F.lit("")).alias("listed"),
    )


def records_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, path = _records(spark, sf_dir, "roles_all"), work_dir(spark, "append")
    write_records(records, path)
    write_records(records, path)
    return _people_columns(read_records(spark, path, DATASETS["roles_all"]))


def records_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "overwrite")
    write_records(_records(spark, sf_dir, "locations_all"), path)
    write_records(_records(spark, sf_dir, "roles_all"), path, append=False)
    return _people_columns(read_records(spark, path, DATASETS["roles_all"]))


def records_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, store, seen = (work_dir(spark, f"ingest-{x}") for x in ("landing", "store", "checkpoint"))
    write_records(_records(spark, sf_dir, "roles_all"), landing)
    ingest_records(spark, landing, store, seen, DATASETS["roles_all"])
    write_records(_records(spark, sf_dir, "roles_all"), store)  # both ways into one store
    return _people_columns(read_records(spark, store, DATASETS["roles_all"]))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "roundtrip")
    pages = fx.table(spark, sf_dir, "pages").select("page_id", "url", F.concat(F.lit(" "), "html", F.lit("\n")).alias("html"))
    write_csv(pages, path)
    stored = read_csv_text(spark, path)
    return stored.select("page_id", "url", F.md5("html").alias("html_md5"))


def append_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, grown = work_dir(spark, "stored"), work_dir(spark, "stored-v2")
    suppliers = fx.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    customers = fx.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    append_csv(suppliers, path, grown)
    append_csv(suppliers, path, grown)
    return read_csv_text(spark, append_csv(customers, path, grown))


def wide_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    def snapshot(name: str) -> DataFrame:
        records = _records(spark, sf_dir, name)
        wide = tables.wide_table(records, DATASETS[name], fx.RUN_TS, column_order="name")
        return wide.drop("Time Stamp", "Redirected to URL")

    return append_by_name(snapshot("roles_kw"), snapshot("roles_all"), fill_all=True)


ROLE_COLUMNS = ("STANDARD", "PROMO", "LARGE", "SMALL", "ECONOMY", "MEDIUM", "-", "Unknown Role", "No count", "Freelance")
_PIVOT = ", ".join(f"coalesce(max(count) FILTER (label = '{c}'), '-') AS \"{c}\"" for c in ROLE_COLUMNS)
_PRESENT = (
    'input_company_name AS "Input Company Name", company_name AS "Company Name", '
    'time_stamp AS "Time Stamp", redirected_url AS "Redirected to URL"'
)


def _long_sql(dataset: str, members: str = "members") -> str:
    d = DATASETS[dataset]
    return with_ctes(
        BARS,
        items_sql(dataset),
        select=f"""
SELECT {_PRESENT}, label AS "{d.label_key}", count AS "Count", {members} AS "{d.members_key}"
FROM records JOIN items USING (k)""",
    )


def _last_sql(dataset: str, suffix: str = "") -> str:
    return f"""{items_sql(dataset).replace("items AS", f"items{suffix} AS").replace("records AS", f"records{suffix} AS")},
last{suffix} AS (SELECT k, label, arg_max(count, pos) AS count FROM items{suffix} GROUP BY k, label)"""


_TABLE_ROWS = f"""
SELECT '{DATASETS["about"].table_name}' AS table_name, (SELECT count(*) FROM totals) AS n_rows, 12::BIGINT AS n_columns
"""


def _stored_sql(times: int) -> str:
    """The records of a store that was written so often."""
    return f"""
SELECT input_company_name, nullif(members, '-') AS members, coalesce(listed, '') AS listed
FROM records LEFT JOIN (
  SELECT k, string_agg(label || '=' || count, '|' ORDER BY pos) AS listed FROM items GROUP BY k
) USING (k) CROSS JOIN range({times})"""


def _convert_sql(roles_form: str) -> str:
    ctes, selects = [BARS], [_TABLE_ROWS]
    for name, dataset in DATASETS.items():
        if dataset.facet is None:
            continue
        ctes.append(_last_sql(name, f"_{name}"))
        if dataset.facet == "roles" and roles_form == "wide":
            rows, columns = "SELECT count(*) FROM totals", f"SELECT 5 + count(DISTINCT label) FROM items_{name}"
        else:
            rows, columns = f"SELECT count(*) FROM items_{name}", "SELECT 7::BIGINT"
        selects.append(f"SELECT '{dataset.table_name}', ({rows}), ({columns})")
    return with_ctes(*ctes, select="\nUNION ALL\n".join(selects))


QUERIES = {
    "records_scan": Query(
        records_scan,
        with_ctes(
            BARS,
            select="""
SELECT name AS input_company_name, CASE WHEN k % 10 = 6 THEN '-' ELSE name || ' & Co' END AS company_name,
  CASE WHEN k % 10 <> 7 THEN 'https://orgs.example.com/company/' || k END AS redirected_url,
  CASE k % 10 WHEN 6 THEN 'STRING' WHEN 7 THEN NULL ELSE 'ARRAY' END AS list_kind,
  CASE k % 10 WHEN 5 THEN 0 WHEN 6 THEN -1 WHEN 7 THEN -1 WHEN 4 THEN n + 1 WHEN 8 THEN n + 1 WHEN 9 THEN n + 2
    ELSE n END AS n_items
FROM totals JOIN (SELECT k, count(*) AS n FROM counted WHERE facet = 'roles' GROUP BY k) USING (k)""",
        ),
    ),
    "optional_dataset": Query(
        optional_dataset, with_ctes(BARS, select="SELECT name || ' & Co' AS company_name, nation AS industry FROM totals")
    ),
    "list_normalise": Query(
        list_normalise,
        with_ctes(
            BARS,
            items_sql("roles_all"),
            select="SELECT input_company_name, pos, label, count, is_entry FROM records JOIN items USING (k)",
        ),
    ),
    "field_default": Query(
        field_default,
        with_ctes(
            BARS,
            select="""
SELECT name || ' & Co' AS company_name, CASE WHEN k % 10 = 4 THEN '-' ELSE name END AS input_name, nation AS industry,
  CASE WHEN k % 5 = 1 THEN '-' ELSE '''' || format('{:,}', n_kw) || '-' || format('{:,}', n_all) END AS size,
  CASE WHEN k % 3 = 0 THEN '-' ELSE nation END AS headquarters
FROM totals""",
        ),
    ),
    "members_column": Query(
        members_of_variant,
        with_ctes(
            BARS,
            select="""
SELECT dataset, name AS input_company_name, CASE WHEN k % 10 = 7 THEN '-'
  ELSE format('{:,}', CASE WHEN ends_with(dataset, 'kw') THEN n_kw ELSE n_all END) END AS members
FROM totals CROSS JOIN (VALUES ('roles_kw'), ('roles_all'), ('locations_kw'), ('locations_all')) d(dataset)""",
        ),
    ),
    "about_table": Query(
        about_table,
        with_ctes(
            BARS,
            select=f"""
SELECT CASE WHEN k % 10 = 4 THEN '-' ELSE name END AS "Input Company Name", name || ' & Co' AS "Company Name",
  CASE WHEN k % 5 = 2 THEN '-' ELSE n_all::VARCHAR END AS "Associated Members",
  'https://www.' || k || '.example.com' AS "Website", nation AS "Industry",
  CASE WHEN k % 5 = 1 THEN '-' ELSE '''' || n_kw || '-' || n_all END AS "Company Size",
  CASE WHEN k % 3 = 0 THEN '-' ELSE nation END AS "Headquarters", (1900 + k % 100)::VARCHAR AS "Founded",
  types AS "Specialties", 'https://orgs.example.com/company/' || k AS "LinkedIn URL",
  CASE WHEN k % 4 = 3 THEN '{fx.RUN_TS}' ELSE '2024-05-01T00:00:00' END AS "Time Stamp",
  'https://orgs.example.com/company/' || k AS "Redirected to URL"
FROM totals""",
        ),
    ),
    "roles_long": Query(roles_long, _long_sql("roles_all")),
    "roles_long_kw": Query(roles_long_kw, _long_sql("roles_kw")),
    "locations_long": Query(locations_long, _long_sql("locations_all")),
    "locations_long_kw": Query(locations_long_kw, _long_sql("locations_kw")),
    "locations_fallback": Query(
        locations_fallback, _long_sql("locations_all", "CASE WHEN is_entry THEN members ELSE '-' END")
    ),
    "roles_wide": Query(
        roles_wide,
        with_ctes(
            BARS,
            _last_sql("roles_all"),
            select=f"""
SELECT {_PRESENT}, members AS "{ALL_MEMBERS}", {_PIVOT} FROM records LEFT JOIN last USING (k)
GROUP BY k, input_company_name, company_name, time_stamp, redirected_url, members""",
        ),
    ),
    "store_wide": Query(
        store_wide,
        with_ctes(
            BARS,
            _last_sql("roles_all"),
            select=f"""
SELECT {_PRESENT}, members AS "{ALL_MEMBERS}", {_PIVOT} FROM records LEFT JOIN last USING (k)
GROUP BY k, input_company_name, company_name, time_stamp, redirected_url, members""",
        ),
    ),
    "store_long": Query(store_long, _long_sql("roles_all")),
    "store_labels": Query(
        store_labels,
        with_ctes(
            BARS,
            items_sql("roles_all"),
            select="""
SELECT row_number() OVER (ORDER BY first) - 1 AS place, label FROM (
  SELECT label, min({'a': CASE WHEN k % 10 < 4 THEN 0 WHEN k % 10 < 8 THEN 1 ELSE 2 END, 'k': k, 'pos': pos}) AS first
  FROM items GROUP BY label
)""",
        ),
    ),
    "roles_last_wins": Query(
        roles_last_wins,
        with_ctes(
            BARS,
            _last_sql("roles_all"),
            select="SELECT input_company_name AS name, label, count FROM records JOIN last USING (k)",
        ),
    ),
    "role_columns": Query(
        role_columns,
        with_ctes(
            BARS,
            items_sql("roles_all"),
            select="""
, ranked AS (
  SELECT label, input_company_name, pos,
         row_number() OVER (PARTITION BY label ORDER BY input_company_name, pos) AS place
  FROM records JOIN items USING (k)
)
SELECT label, input_company_name AS first_record, pos AS first_pos FROM ranked WHERE place = 1""",
        ),
    ),
    "convert_all": Query(convert_all, _convert_sql("wide")),
    "convert_all_long": Query(convert_all_long, _convert_sql("long")),
    "records_append": Query(
        records_append,
        with_ctes(
            BARS,
            items_sql("roles_all"),
            select=_stored_sql(2),
        ),
    ),
    "records_overwrite": Query(
        records_overwrite,
        with_ctes(
            BARS,
            items_sql("roles_all"),
            select=_stored_sql(1),
        ),
    ),
    "records_ingest": Query(
        records_ingest,
        with_ctes(
            BARS,
            items_sql("roles_all"),
            select=_stored_sql(2),
        ),
    ),
    "csv_roundtrip": Query(
        csv_roundtrip, "SELECT page_id::VARCHAR AS page_id, url, md5(' ' || html || chr(10)) AS html_md5 FROM pages"
    ),
    "append_union_by_name": Query(
        append_union_by_name,
        """
SELECT s_name AS name, s_nationkey::VARCHAR AS nation, NULL AS segment FROM supplier
UNION ALL SELECT s_name, s_nationkey::VARCHAR, NULL FROM supplier
UNION ALL SELECT c_name, NULL, c_mktsegment FROM customer""",
    ),
    "wide_accumulate": Query(
        wide_accumulate,
        with_ctes(
            BARS,
            _last_sql("roles_kw", "_kw"),
            _last_sql("roles_all", "_all"),
            select=f"""
SELECT input_company_name AS "Input Company Name", company_name AS "Company Name",
       members AS "{KEYWORD_MEMBERS}", '-' AS "{ALL_MEMBERS}", {_PIVOT}
FROM records_kw LEFT JOIN last_kw USING (k) GROUP BY k, input_company_name, company_name, members
UNION ALL
SELECT input_company_name, company_name, '-', members, {_PIVOT}
FROM records_all LEFT JOIN last_all USING (k) GROUP BY k, input_company_name, company_name, members""",
        ),
    ),
}


def _rows_sql(roles_form: str) -> str:
    """Every cell of the five tables, the cells of a row by column name."""

    def cell(column: str) -> str:
        return f"""'{column}=' || coalesce("{column}", '')"""

    def rows(name: str, columns: tuple[str, ...], sql: str) -> str:
        return f"SELECT '{name}' AS table_name, {" || '|' || ".join(map(cell, sorted(columns)))} AS cells FROM ({sql})"

    present = ("Input Company Name", "Company Name", "Time Stamp", "Redirected to URL")
    parts = [rows(DATASETS["about"].table_name, ABOUT_COLUMNS, QUERIES["about_table"].sql)]
    for name, d in DATASETS.items():
        if d.facet is None:
            continue
        if d.facet == "locations" or roles_form == "long":
            parts.append(rows(d.table_name, (*present, d.label_key, "Count", d.members_key), _long_sql(name)))
            continue
        fixed = "\nUNION ALL ".join(f"SELECT k, '{c}' AS name, \"{c}\" AS cell FROM shown" for c in (*present, d.members_key))
        wide = with_ctes(
            BARS,
            _last_sql(name),
            select=f"""
, shown AS (SELECT k, {_PRESENT}, members AS "{d.members_key}" FROM records),
cells AS (
  {fixed}
  UNION ALL
  SELECT k, label, coalesce(count, '-')
  FROM (SELECT k, label FROM records CROSS JOIN (SELECT DISTINCT label FROM items)) LEFT JOIN last USING (k, label)
)
SELECT string_agg(name || '=' || cell, '|' ORDER BY name) AS cells FROM cells GROUP BY k""",
        )
        parts.append(f"SELECT '{d.table_name}' AS table_name, cells FROM ({wide})")
    return "\nUNION ALL\n".join(parts)


QUERIES |= {
    "convert_all_rows": Query(convert_all_rows, _rows_sql("wide")),
    "convert_all_long_rows": Query(convert_all_long_rows, _rows_sql("long")),
}
