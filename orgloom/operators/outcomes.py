"""Outcome routing: one record per organisation and dataset, whatever happened."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgloom.functions.text import iso_text
from orgloom.functions.urls import is_unavailable
from orgloom.functions.values import default_time, or_missing
from orgloom.operators.extract import has_unlabelled_bar
from orgloom.schemas import HEADING_COLUMNS, MISSING, Dataset, ExtractionSpec

#: What may become of an organisation's page in a dataset.
OUTCOMES = ("ok", "no_bars", "unavailable", "not_loaded", "exception", "placeholder")
NOT_CAPTURED = "page not captured"
NO_SOURCE = "no page source"
NO_HEADING = "no h1 on page"
NO_CATEGORY = "a bar has spans but no category"

PROFILE_COLUMNS = [c for c in HEADING_COLUMNS.values() if c != "members"]
ITEMS_TYPE = "array<struct<label:string,count:string>>"

RECORD_COLUMNS = {
    "dataset": "string",
    "outcome": "string",
    "input_company_name": "string",
    "company_name": "string",
    "profile_url": "string",
    "targeted_url": "string",
    "redirected_url": "string",
    "error": "string",
    "time_stamp": "string",
    "members": "string",
    **{c: "string" for c in PROFILE_COLUMNS},
    "items": ITEMS_TYPE,
    "items_missing": "boolean",
}


def _record(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Select the record columns; those not given are absent, that is NULL.

    ``position``, the organisation's place in the list, goes along if it is known.
    """
    return df.select(
        *(F.col(c) for c in df.columns if c == "position"),
        *(
            (values[c].cast(t) if c in values else F.expr(f"cast(null as {t})")).alias(c)
            for c, t in RECORD_COLUMNS.items()
        )
    )


def _outcome(dataset: Dataset, spec: ExtractionSpec) -> Column:
    reached = F.when(F.col("requested_url").isNull(), "exception").when(
        is_unavailable(F.col("final_url"), F.col("target_url"), spec), "unavailable"
    )
    if dataset.facet is None:
        return (
            reached.when(F.col("parse_error") != NO_SOURCE, "exception")
            .when(F.col("heading").isNull(), "not_loaded")
            .otherwise("ok")
        )
    return (
        reached.when(F.col("parse_error").isNotNull(), "not_loaded")
        .when(~F.col("has_bars"), "no_bars")
        .when(has_unlabelled_bar(F.col(dataset.facet)), "exception")
        .otherwise("ok")
    )


def route(found: DataFrame, datasets: Iterable[Dataset], spec: ExtractionSpec) -> DataFrame:
    """One row per looked-up page and dataset made from it, with its ``outcome``."""
    by_kind: dict[str, list[Column]] = {}
    for dataset in datasets:
        items = F.expr(f"cast(null as {ITEMS_TYPE})") if dataset.facet is None else F.col(dataset.facet)
        routed = F.struct(
            F.lit(dataset.name).alias("dataset"), _outcome(dataset, spec).alias("outcome"), items.alias("items")
        )
        by_kind.setdefault(dataset.page_kind, []).append(routed)
    made = F.coalesce(*(F.when(F.col("page_kind") == kind, F.array(*r)) for kind, r in by_kind.items()))
    others = [c for c in found.columns if c not in ("locations", "roles")]
    return found.select(*others, F.inline(made))


def _about_values() -> dict[str, Column]:
    outcome = F.col("outcome")
    ok = outcome == "ok"
    error = F.coalesce(
        F.when(F.col("requested_url").isNull(), NOT_CAPTURED), F.col("parse_error"), F.lit(NO_HEADING)
    )
    return {
        "company_name": F.when(ok, F.col("heading")).otherwise(MISSING),
        "profile_url": F.col("base_url"),
        "redirected_url": F.when(outcome.isin("ok", "unavailable"), F.col("final_url")),
        "error": F.when(outcome.isin("not_loaded", "exception"), error),
        **{c: F.when(ok, F.col(f"profile.{c}")) for c in ["members", *PROFILE_COLUMNS]},
    }


def _people_values() -> dict[str, Column]:
    outcome = F.col("outcome")
    read = outcome.isin("ok", "no_bars")
    unavailable = outcome == "unavailable"
    error = F.when(F.col("requested_url").isNull(), NOT_CAPTURED).otherwise(NO_CATEGORY)
    return {
        "company_name": F.when(read, or_missing(F.col("title"))).otherwise(MISSING),
        "profile_url": F.when(unavailable, F.col("base_url")),
        "redirected_url": F.when(outcome != "exception", F.col("final_url")),
        "error": F.when(outcome == "exception", error),
        "members": F.when(read, or_missing(F.col("header_members"))).when(~unavailable, MISSING),
        "items": F.when(outcome == "ok", F.col("items")),
        "items_missing": outcome.isin("not_loaded", "no_bars", "exception"),
    }


def page_records(routed: DataFrame, kinds: Iterable[str], run_ts: str) -> DataFrame:
    """Records of routed pages; each outcome has its own set of keys, the others are NULL."""
    kinds = set(kinds)
    about = _about_values() if "about" in kinds else {}
    people = _people_values() if kinds - {"about"} else {}
    if about and people:
        is_about, absent = F.col("page_kind") == "about", F.lit(None)
        values = {
            c: F.when(is_about, about.get(c, absent)).otherwise(people.get(c, absent))
            for c in {**about, **people}
        }
    else:
        values = about or people
    shared = {
        "dataset": F.col("dataset"),
        "outcome": F.col("outcome"),
        "input_company_name": F.col("name"),
        "targeted_url": F.when(F.col("outcome") == "unavailable", F.col("target_url")),
        "time_stamp": default_time(iso_text(F.col("captured_at")), run_ts),
    }
    return _record(routed, {**values, **shared})


def placeholder_records(orgs: DataFrame, datasets: Iterable[Dataset], run_ts: str) -> DataFrame:
    """One record per dataset for each organisation whose URL is blank or invalid."""
    names = F.array(*(F.lit(d.name) for d in datasets))
    return _record(
        orgs.select(*(c for c in ("position", "name", "profile_url") if c in orgs.columns), F.explode(names).alias("dataset")),
        {
            "dataset": F.col("dataset"),
            "outcome": F.lit("placeholder"),
            "company_name": F.col("name"),
            "profile_url": F.col("profile_url"),
            "time_stamp": F.lit(run_ts),
            "items_missing": F.lit(False),
        },
    )
