"""Organisation list and captured pages -> the five record datasets."""

from __future__ import annotations

import os
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgloom.functions import urls
from orgloom.operators import extract, outcomes
from orgloom.operators.lookup import key_filter, latest_capture, lookup, probably_known
from orgloom.operators.nodes import with_nodes
from orgloom.operators.order import in_order
from orgloom.schemas import COMMON_KEYS, DATASETS, HEADING_COLUMNS, Dataset, ExtractionSpec
from orgloom.session import work_dir
from orgloom.sinks.figures import Places, counted
from orgloom.sinks.tables import write_records


def classify(
    orgs: DataFrame, null_as_placeholder: bool = False, strip_query_first: bool = False
) -> DataFrame:
    """Add ``url_status`` and ``base_url`` (NULL unless the status is valid)."""
    url = F.col("profile_url")
    status = urls.url_status(url)
    if null_as_placeholder:
        status = F.when(url.isNull(), "blank").otherwise(status)
    return orgs.withColumn("url_status", status).withColumn(
        "base_url", F.when(F.col("url_status") == "valid", urls.base_url(url, strip_query_first))
    )


def rejects(classified: DataFrame) -> DataFrame:
    """Organisations that get no record at all, kept beside the result."""
    return classified.filter(F.col("url_status") == "null").select(
        "name", "profile_url", F.lit("no profile URL").alias("reason")
    )


def has_ending(spec: ExtractionSpec, kinds: Iterable[str]) -> Column:
    """Whether a page's URL is one of these kinds of page."""
    return reduce(or_, [F.col("requested_url").endswith(spec.suffixes[kind]) for kind in sorted(kinds)])


CAPTURE = ("requested_url", "captured_at", "final_url")


def newest_captures(pages: DataFrame, targets: DataFrame, spec: ExtractionSpec, kinds: Iterable[str]) -> DataFrame:
    """The newest capture of every URL that some target asks for, without its text.

    Captures of equal time and end are one row. Only narrow columns are read.
    """
    asked = targets.select(F.col("target_url").alias("requested_url")).distinct()
    known = pages.filter(has_ending(spec, kinds)).select(*CAPTURE)
    newest = known.join(asked, "requested_url", "left_semi").groupBy("requested_url").agg(
        F.max(F.struct("captured_at", "final_url")).alias("newest")
    )
    return newest.select("requested_url", "newest.captured_at", "newest.final_url")


def targeted_captures(pages: DataFrame, targets: DataFrame, spec: ExtractionSpec, kinds: Iterable[str]) -> DataFrame:
    """The newest capture of every URL that some target asks for, with its text.

    Which captures these are is settled on narrow columns and kept as a filter of bounded
    size, which the scan of the texts is held against where it stands: no text crosses a
    shuffle, whether it is wanted or not. With very many targets the filter lets some
    other captures pass. These cost their parsing and do not change the result: a newer
    one of the same URL is always there too, and other URLs are asked for by nobody.
    Captures that tie stay for later.
    """
    chosen = key_filter(newest_captures(pages, targets, spec, kinds), CAPTURE)
    return probably_known(pages.filter(has_ending(spec, kinds)), chosen, CAPTURE)


def parsed_pages(pages: DataFrame, spec: ExtractionSpec) -> DataFrame:
    """Captures with the nodes of their pages in place of the text, all that any dataset needs."""
    return with_nodes(pages.select(*CAPTURE, F.xxhash64("html").alias("capture_hash"), "html"), spec)


def page_facts(pages: DataFrame, spec: ExtractionSpec, kinds: Iterable[str] | None = None) -> DataFrame:
    """Everything later steps need from a page, one small row per capture.

    Page text is read, parsed and dropped inside one map-only stage; it crosses no
    shuffle unless the pages given do before. With ``kinds`` the scan keeps only pages of these kinds,
    which their URLs tell by the ending, and only the facts they are read for. Pages
    that have their nodes already (see ``parsed_pages``) are not parsed again.
    """
    wanted = set(spec.suffixes if kinds is None else kinds)
    parsed = pages if "page" in pages.columns else parsed_pages(pages, spec)
    if kinds is not None:
        parsed = parsed.filter(has_ending(spec, wanted))
    page = F.col("page")
    facts = []
    if "about" in wanted:
        facts += [
            extract.first_heading(page).alias("heading"),
            extract.profile_fields(F.col("profile_values"), spec).alias("profile"),
        ]
    if wanted - {"about"}:
        facts += [
            extract.page_title(page, spec).alias("title"),
            extract.header_members(page, spec).alias("header_members"),
            extract.has_class(page, spec.bar_class).alias("has_bars"),
            extract.facet_bars(page, spec.locations_index, spec).alias("locations"),
            extract.facet_bars(page, spec.roles_index, spec).alias("roles"),
        ]
    if "about" in wanted:
        parsed = parsed.withColumn("pairs", extract.dt_dd_pairs(page, spec.headings)).withColumn(
            "profile_values", extract.profile_values(F.col("pairs"))
        )
    return parsed.select("requested_url", "final_url", "captured_at", "capture_hash", "parse_error", *facts)


def looked_up(classified: DataFrame, pages: DataFrame, spec: ExtractionSpec, kinds: Iterable[str]) -> DataFrame:
    """Valid organisations x page kinds with the facts of the page each target leads to.

    Only valid organisations take part: a missing URL must not become a join key. ``pages``
    are captures with text, with nodes, or facts of all kinds that were kept earlier.
    """
    kinds = list(kinds)
    known = [c for c in ("position", "name", "base_url") if c in classified.columns]
    valid = classified.filter(F.col("url_status") == "valid").select(*known)
    targets = urls.page_targets(valid, spec, kinds)
    if "heading" in pages.columns:
        return lookup(targets, latest_capture(pages.filter(has_ending(spec, kinds))))
    wanted = targeted_captures(pages, targets, spec, kinds)
    return lookup(targets, latest_capture(page_facts(wanted, spec, kinds)))


def extract_datasets(
    orgs: DataFrame,
    pages: DataFrame,
    run_ts: str,
    spec: ExtractionSpec | None = None,
    datasets: Iterable[str] = tuple(DATASETS),
    null_as_placeholder: bool = False,
    strip_query_first: bool = False,
) -> DataFrame:
    """Records of the wanted datasets in one table, told apart by ``dataset``.

    Each page is parsed once and feeds every dataset that is made from it. Write
    the result partitioned by ``dataset`` to get the five outputs in one pass. If the
    organisations have a ``position``, the records have it too.
    """
    spec = spec or ExtractionSpec()
    wanted = [DATASETS[name] for name in datasets]
    classified = classify(orgs, null_as_placeholder, strip_query_first)

    kinds = list(dict.fromkeys(d.page_kind for d in wanted))
    routed = outcomes.route(looked_up(classified, pages, spec, kinds), wanted, spec)
    without_page = classified.filter(F.col("url_status").isin("blank", "invalid"))
    return outcomes.page_records(routed, kinds, run_ts).unionByName(
        outcomes.placeholder_records(without_page, wanted, run_ts)
    )


def extract_about(orgs: DataFrame, pages: DataFrame, run_ts: str, **options) -> DataFrame:
    return extract_datasets(orgs, pages, run_ts, datasets=["about"], **options)


def extract_facet(
    orgs: DataFrame, pages: DataFrame, run_ts: str, facet: str, keyword: bool, **options
) -> DataFrame:
    """One of the four people datasets: ``locations`` or ``roles``, keyword page or all."""
    name = f"{facet}_{'kw' if keyword else 'all'}"
    return extract_datasets(orgs, pages, run_ts, datasets=[name], **options)


def as_json_records(records: DataFrame, dataset: Dataset) -> DataFrame:
    """One dataset's records under their JSON keys; absent keys are NULL.

    The list field is a variant because it holds either a list or the text "-".
    """
    mine = records.filter(F.col("dataset") == dataset.name)
    common = [F.col(column).alias(key) for key, column in COMMON_KEYS.items()]
    if dataset.facet is None:
        return mine.select(*common, *(F.col(c).alias(h) for h, c in HEADING_COLUMNS.items()))
    entries = F.transform(
        "items", lambda i: F.struct(i["count"].alias("Count"), i["label"].alias(dataset.label_key))
    )
    listed = F.when(F.col("items_missing"), F.parse_json(F.lit('"-"'))).otherwise(F.to_variant_object(entries))
    return mine.select(*common, F.col("members").alias(dataset.members_key), listed.alias(dataset.list_key))


def write_datasets(records: DataFrame, out_dir: str, append: bool = False) -> Places:
    """Write the five JSON datasets and return their folders, with the numbers of records, errors and outcomes.

    The records are computed once into a table in the shared work folder, so pages
    are not parsed again for each dataset. If they have a ``position``, each dataset is
    written in that order.
    """
    spark = records.sparkSession
    stage = work_dir(spark, "records")
    counts = {outcome: F.col("outcome") == outcome for outcome in outcomes.OUTCOMES}
    errors = {"errors": F.col("error").isNotNull(), "without_source": F.col("error").eqNullSafe(outcomes.NO_SOURCE)}
    found = counted(records, lambda df: df.write.partitionBy("dataset").parquet(stage), **errors, **counts)
    stored = spark.read.schema(records.schema).parquet(stage)
    places = Places(figures={"records": found.pop("rows"), **found})
    for name, dataset in DATASETS.items():
        places[name] = os.path.join(out_dir, dataset.file_name)
        mine = stored.filter(F.col("dataset") == name)
        ordered = in_order(mine, "position") if "position" in mine.columns else mine
        write_records(as_json_records(ordered, dataset), places[name], append)
    return places
