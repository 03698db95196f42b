"""Profile-URL classification, cleaning and target building."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgloom.functions.text import is_space
from orgloom.schemas import ExtractionSpec

URL_PARTS = 5


def with_https(url: Column) -> Column:
    """Give the URL an https scheme; NULL when it has no known start."""
    return (
        F.when(url.startswith("http://"), F.concat(F.lit("https://"), F.substring(url, 8, 2**31 - 1)))
        .when(url.startswith("www."), F.concat(F.lit("https://"), url))
        .when(url.startswith("https://"), url)
    )


def first_parts(url: Column, parts: int = URL_PARTS) -> Column:
    """Keep the first ``/``-separated parts: scheme, blank, host, section, slug."""
    return F.substring_index(url, "/", parts)


def strip_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def base_url(url: Column, strip_query_first: bool = False) -> Column:
    cleaned = with_https(url)
    return first_parts(strip_query(cleaned) if strip_query_first else cleaned)


def url_status(url: Column) -> Column:
    """``null``, ``blank``, ``invalid`` or ``valid``."""
    return (
        F.when(url.isNull(), "null")
        .when((url == "") | (url == "-") | is_space(url), "blank")
        .when(with_https(url).isNull(), "invalid")
        .otherwise("valid")
    )


def page_targets(orgs: DataFrame, spec: ExtractionSpec, kinds: Iterable[str] | None = None) -> DataFrame:
    """One row per organisation and page kind, with the URL to look up."""
    wanted = spec.suffixes if kinds is None else {kind: spec.suffixes[kind] for kind in kinds}
    targets = F.array(
        *(
            F.struct(F.lit(kind).alias("page_kind"), F.concat("base_url", F.lit(suffix)).alias("target_url"))
            for kind, suffix in wanted.items()
        )
    )
    return orgs.select("*", F.inline(targets))


def is_redirected(final_url: Column, target_url: Column) -> Column:
    return ~final_url.eqNullSafe(target_url)


def is_unavailable(final_url: Column, target_url: Column, spec: ExtractionSpec) -> Column:
    return F.coalesce(
        is_redirected(final_url, target_url) & final_url.contains(spec.unavailable_marker), F.lit(False)
    )
