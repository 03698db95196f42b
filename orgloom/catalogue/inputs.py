"""Organisations, captured pages and records rendered from the star schema.

Organisations are the suppliers; location bars count their line items per customer
nation, role bars per part type; the keyword pages see the returned items only.
The shape of an organisation's URL follows from ``s_suppkey % 10``, what happened
to its pages from ``s_suppkey div 10 % 10``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.operators.order import in_order
from orgloom.plans.extraction import classify
from orgloom.schemas import DATASETS, HEADING_COLUMNS, Dataset, ExtractionSpec
from orgloom.session import work_dir
from orgloom.sinks.tables import write_records

RUN_TS = "2024-06-01T12:00:00"
KEYWORD_FLAG = "R"
HOST = "orgs.example.com"

_written: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def written(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path of a rendered input, written to the shared work folder once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = work_dir(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k``, ``name``, ``profile_url`` in ten URL shapes."""
    k = F.col("s_suppkey").cast("string")
    shapes = [
        F.concat(F.lit(f"https://{HOST}/company/"), k, F.lit("/")),
        F.concat(F.lit(f"https://{HOST}/company/"), k),
        F.concat(F.lit(f"http://{HOST}/company/"), k, F.lit("/people/x")),
        F.concat(F.lit(f"www.{HOST}/company/"), k, F.lit("?trk=1")),
        F.concat(F.lit(f"{HOST}/company/"), k),
        F.lit("-"),
        F.lit("   "),
        F.lit(None).cast("string"),
        F.concat(F.lit(f"https://{HOST}/o"), k),
        F.concat(F.lit(f"HTTP://{HOST}/company/"), k),
    ]
    url = F.element_at(F.array(*shapes), (F.col("s_suppkey") % 10 + 1).cast("int"))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), url.alias("profile_url")
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, facet, keyword, label, n``: what the bars of each organisation show."""

    def write(path: str) -> None:
        items = table(spark, sf_dir, "lineitem").select(
            F.col("l_suppkey").alias("k"),
            "l_orderkey",
            "l_partkey",
            (F.col("l_returnflag") == KEYWORD_FLAG).cast("int").alias("hit"),
        )
        nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        lived = (
            items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("k", "hit", F.lit("locations").alias("facet"), F.col("n_name").alias("label"))
        )
        done = items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
            "k", "hit", F.lit("roles").alias("facet"), F.col("p_type").alias("label")
        )
        both = F.array(
            F.struct(F.lit(False).alias("keyword"), F.col("n_all").alias("n")),
            F.struct(F.lit(True).alias("keyword"), F.col("n_hit").alias("n")),
        )
        (
            lived.unionByName(done)
            .groupBy("k", "facet", "label")
            .agg(F.count(F.lit(1)).alias("n_all"), F.sum("hit").alias("n_hit"))
            .select("k", "facet", "label", F.inline(both))
            .filter("n > 0")
            .write.parquet(path)
        )

    return spark.read.parquet(written(spark, sf_dir, "bars", write))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier with everything its pages and records show.

    The lists have at most one entry per nation or part type.
    """
    per_org = (
        bars(spark, sf_dir)
        .groupBy("k")
        .agg(
            *(
                F.array_sort(
                    F.collect_list(
                        F.when(
                            (F.col("facet") == facet) & (F.col("keyword") == keyword),
                            F.struct((-F.col("n")).alias("minus_n"), "label", "n"),
                        )
                    )
                ).alias(f"{facet}_{'kw' if keyword else 'all'}")
                for facet in ("locations", "roles")
                for keyword in (True, False)
            )
        )
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), "s_nationkey"
    )

    empty = F.array().cast(per_org.schema["roles_kw"].dataType)
    lists = ["locations_kw", "locations_all", "roles_kw", "roles_all"]
    return (
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(per_org, "k", "left")
        .select("k", "name", F.col("n_name").alias("nation"), *(F.coalesce(c, empty).alias(c) for c in lists))
        .withColumn("n_kw", F.aggregate("roles_kw", F.lit(0).cast("bigint"), lambda a, b: a + b["n"]))
        .withColumn("n_all", F.aggregate("roles_all", F.lit(0).cast("bigint"), lambda a, b: a + b["n"]))
    )


def number(n: Column) -> Column:
    return F.format_number(n, 0)


def captured_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages of all valid organisations, with every outcome among them."""

    def write(path: str) -> None:
        # several files, so that small inputs are parsed on all cores as well
        files = spark.sparkContext.defaultParallelism
        _render_pages(spark, sf_dir, ExtractionSpec()).repartition(files, "requested_url").write.parquet(path)

    path = written(spark, sf_dir, "pages", write)
    return spark.read.parquet(path)


def _tag(name: str, *content, attrs: str = "") -> Column:
    parts = [c if isinstance(c, Column) else F.lit(c) for c in content]
    return F.concat(F.lit(f"<{name}{attrs}>"), *parts, F.lit(f"</{name}>"))


def _bars_html(items: Column, spec: ExtractionSpec) -> Column:
    button = f' class="{spec.bar_class} t-14"'
    span = f' class="{spec.category_class}"'
    return F.concat_ws(
        "\n",
        F.transform(
            items,
            lambda i: _tag(
                "button",
                _tag("div", _tag("strong", "\n ", number(i["n"]), " "), _tag("span", i["label"], attrs=span)),
                attrs=button,
            ),
        ),
    )


def _people_html(items_suffix: str, spec: ExtractionSpec) -> Column:
    variant = F.col("variant")
    button = f' class="{spec.bar_class}"'
    span = f' class="{spec.category_class}"'
    title = F.when(
        variant != 6, _tag("h1", " ", F.col("name"), " &amp; Co\n", attrs=f' class="{spec.title_class} ember"')
    ).otherwise("")
    header = F.when(
        variant != 8,
        _tag(
            "div",
            _tag("h2", " ", number(F.col(f"n_{items_suffix}")), " associated members "),
            attrs=f' class="{spec.header_class}"',
        ),
    ).otherwise("<div><h2>1 associated member</h2></div>")
    odd_bars = F.when(
        variant == 1,
        F.concat(
            _tag("button", _tag("span", "No count", attrs=span), attrs=button),
            _tag("button", _tag("strong", "7"), attrs=button),
        ),
    ).otherwise("")
    bad_bar = F.when(variant == 9, _tag("button", _tag("span", "x"), attrs=button)).otherwise("")

    def item(index: str, *content) -> Column:
        return _tag("li", *content, attrs=f' {spec.item_attr}="{index}"')

    lists = F.when(
        variant != 7,
        _tag(
            "ul",
            item(spec.locations_index, _bars_html(F.col(f"locations_{items_suffix}"), spec), odd_bars),
            item("1", _tag("button", _tag("strong", "99"), attrs=button)),
            item(spec.roles_index, _bars_html(F.col(f"roles_{items_suffix}"), spec), bad_bar),
            item(spec.roles_index, _tag("button", _tag("strong", "98"), attrs=button)),
        ),
    ).otherwise("")
    return _tag("html", _tag("body", title, header, lists))


def _about_html() -> Column:
    variant = F.col("variant")
    title = F.when(variant != 6, _tag("h1", "\n", F.col("name"), " &amp; <i>Co</i> ")).otherwise("")
    specialties = F.array_join(F.array_sort(F.transform("roles_all", lambda r: r["label"])), ", ")
    rows = F.concat(
        _tag("dt", "Website"),
        F.lit("<!-- link -->"),
        _tag("dd", "<a href='#'> https://www.", F.col("k").cast("string"), ".example.com </a>"),
        F.when(variant == 1, F.concat(_tag("dt", "Industry"), _tag("dd", "Superseded"))).otherwise(""),
        _tag("dt", " Industry "),
        _tag("dd", " ", F.col("nation"), "<br>"),
        _tag("dt", "Company size"),
        _tag("dd", number(F.col("n_kw")), "-", number(F.col("n_all")), " employees"),
        _tag("dd", number(F.col("n_all")), " associated members"),
        _tag("dt", "Phone"),
        _tag("dt", "Headquarters"),
        _tag("dd", F.col("nation"), " <b>City</b>"),
        _tag("dt", "Founded"),
        _tag("dd", (F.col("k") % 100 + 1900).cast("string")),
        F.when(variant != 8, F.concat(_tag("dt", "Specialties"), _tag("dd", specialties))).otherwise(""),
    )
    return _tag("html", _tag("body", title, _tag("dl", rows)))


def _render_pages(spark: SparkSession, sf_dir: str, spec: ExtractionSpec) -> DataFrame:
    valid = classify(organisations(spark, sf_dir)).filter("url_status = 'valid'").select("k", "base_url")
    kinds = F.array(*(F.lit(kind) for kind in spec.suffixes))
    suffix = F.create_map(*(F.lit(x) for pair in spec.suffixes.items() for x in pair))
    rendered = (
        profiles(spark, sf_dir)
        .join(valid, "k")
        .withColumn("variant", F.expr("k div 10 % 10"))
        .filter("variant != 3")
        .select("*", F.explode(kinds).alias("kind"))
        .withColumn("requested_url", F.concat("base_url", F.element_at(suffix, F.col("kind"))))
        .withColumn(
            "final_url",
            F.when(F.col("variant") == 4, f"https://{HOST}/unavailable/")
            .when(F.col("variant") == 5, F.concat("requested_url", F.lit("#moved")))
            .otherwise(F.col("requested_url")),
        )
        .withColumn(
            "html",
            F.when(F.col("kind") == "about", _about_html())
            .when(F.col("kind") == "people_kw", _people_html("kw", spec))
            .otherwise(_people_html("all", spec)),
        )
        .withColumn(
            "captured_at",
            F.expr(
                "timestamp_ntz'2024-05-01 00:00:00' + make_dt_interval(0, 0, 0, "
                "cast(k % 86400 as decimal(18,6)) + if(kind = 'people_kw', 0.25, 0))"
            ),
        )
    )
    current = rendered.select("requested_url", "final_url", "html", "captured_at", "variant")
    earlier = current.filter("variant = 2").select(
        "requested_url",
        "final_url",
        F.lit("<h1>An earlier capture</h1>").alias("html"),
        F.expr("captured_at - interval 1 day").alias("captured_at"),
    )
    return current.drop("variant").unionByName(earlier)


def _json_items(items: Column, label_key: str) -> Column:
    return F.transform(items, lambda i: F.to_json(F.struct(number(i["n"]).alias("Count"), i["label"].alias(label_key))))


def _people_records(people: DataFrame, dataset: Dataset) -> DataFrame:
    items = F.col(dataset.name)
    shape = F.col("k") % 10
    key = dataset.label_key

    def text_list(*more: Column) -> Column:
        return F.concat(F.lit("["), F.array_join(F.concat(_json_items(items, key), F.array(*more)), ","), F.lit("]"))

    first = F.to_json(F.struct(F.lit("0").alias("Count"), F.get(items, F.lit(0))["label"].alias(key)))
    listed = (
        F.when(shape == 4, text_list(first))
        .when(shape == 5, F.lit("[]"))
        .when(shape == 6, F.lit('"-"'))
        .when(shape == 7, F.lit(None).cast("string"))
        .when(shape == 8, text_list(F.lit('{"Count": "7"}')))
        .when(shape == 9, text_list(F.lit(f'{{"{key}": "No count"}}'), F.lit('"Freelance"')))
        .otherwise(text_list(F.lit(None).cast("string")))
    )
    return people.select(
        F.col("name").alias("input_company_name"),
        F.when(shape != 6, F.concat("name", F.lit(" & Co"))).otherwise("-").alias("Company Name"),
        F.when(F.col("k") % 4 != 3, F.concat(F.lit("2024-05-01T00:00:"), F.format_string("%02d", F.col("k") % 60))).alias(
            "Time Stamp"
        ),
        F.when(shape != 7, F.concat(F.lit(f"https://{HOST}/company/"), F.col("k").cast("string"))).alias(
            "Redirected to URL"
        ),
        F.when(shape != 7, number(F.col("n_kw" if dataset.name.endswith("kw") else "n_all"))).alias(dataset.members_key),
        F.parse_json(listed).alias(dataset.list_key),
    )


def _about_records(people: DataFrame) -> DataFrame:
    k = F.col("k")
    values = {
        "Website": F.concat(F.lit("https://www."), k.cast("string"), F.lit(".example.com")),
        "Industry": F.col("nation"),
        "Company size": F.when(k % 5 != 1, F.concat(F.lit("'"), number(F.col("n_kw")), F.lit("-"), number(F.col("n_all")))),
        "No. of associated members": F.when(k % 5 != 2, number(F.col("n_all"))).otherwise("-"),
        "Headquarters": F.when(k % 3 != 0, F.col("nation")),
        "Founded": (k % 100 + 1900).cast("string"),
        "Specialties": F.array_join(F.array_sort(F.transform("roles_all", lambda r: r["label"])), ", "),
    }
    return people.select(
        F.when(k % 10 != 4, F.col("name")).alias("input_company_name"),
        F.concat("name", F.lit(" & Co")).alias("Company Name"),
        F.concat(F.lit(f"https://{HOST}/company/"), k.cast("string"), F.lit("?trk=1")).alias("LinkedIn URL"),
        F.when(k % 4 != 3, F.lit("2024-05-01T00:00:00")).alias("Time Stamp"),
        F.concat(F.lit(f"https://{HOST}/company/"), k.cast("string")).alias("Redirected to URL"),
        *(values[h].alias(h) for h in HEADING_COLUMNS),
    )


def records_dir(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the five record datasets as JSON Lines, all list shapes among them."""

    def write(path: str) -> None:
        stage = written(spark, sf_dir, "people", lambda place: profiles(spark, sf_dir).write.parquet(place))
        people = in_order(spark.read.parquet(stage), "k")
        for dataset in DATASETS.values():
            records = _about_records(people) if dataset.facet is None else _people_records(people, dataset)
            write_records(records, os.path.join(path, dataset.file_name), append=False)

    return written(spark, sf_dir, "records", write)


def records_path(spark: SparkSession, sf_dir: str, dataset: str) -> str:
    return os.path.join(records_dir(spark, sf_dir), DATASETS[dataset].file_name)
