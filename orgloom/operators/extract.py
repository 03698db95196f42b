"""Expressions over one parsed page.

Each helper reads the arrays of one row, so nothing here shuffles. Arrays are in
document order: the first match is the first element, and the inside of an element
is a slice, which keeps the work linear in the size of the page.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgloom.functions.text import members_extract, size_extract, strip
from orgloom.functions.values import let, or_missing
from orgloom.operators.nodes import text_raw, text_stripped
from orgloom.schemas import MEMBERS_HEADING, SIZE_HEADING, ExtractionSpec


def _first(nodes: Column, keep) -> Column:
    return F.get(F.filter(nodes, keep), F.lit(0))


def first_by_tag(nodes: Column, tag: str) -> Column:
    return _first(nodes, lambda n: n["tag"] == tag)


def first_by_class(nodes: Column, tag: str, token: str) -> Column:
    return _first(nodes, lambda n: (n["tag"] == tag) & F.array_contains(n["classes"], token))


def has_class(page: Column, token: str) -> Column:
    return F.coalesce(F.exists(page["nodes"], lambda n: F.array_contains(n["classes"], token)), F.lit(False))


def inside(page: Column, node: Column) -> Column:
    """The kept elements inside ``node``; NULL without a node."""
    return F.slice(page["nodes"], node["pos"] + 2, node["n_inner"])


def first_heading(page: Column) -> Column:
    """Text of the first ``h1``, cut at the ends; NULL without one."""
    return let(first_by_tag(page["nodes"], "h1"), lambda h1: strip(text_raw(page, h1)))


def page_title(page: Column, spec: ExtractionSpec) -> Column:
    return let(first_by_class(page["nodes"], "h1", spec.title_class), lambda h1: text_stripped(page, h1))


def header_members(page: Column, spec: ExtractionSpec) -> Column:
    """The member count in the first ``h2`` of the people header; NULL without one."""
    header = let(
        first_by_class(page["nodes"], "div", spec.header_class),
        lambda div: first_by_tag(inside(page, div), "h2"),
    )
    return let(header, lambda h2: members_extract(text_stripped(page, h2)))


def dt_dd_pairs(page: Column, headings: Iterable[str] | None = None) -> Column:
    """Each ``dt`` with the next ``dd`` sibling and the ``dd`` sibling after that.

    Siblings become neighbours by sorting on the parent. In that order, a ``dt`` at
    position p that has m other ``dt`` before it has p - m ``dd`` before it, so its
    next ``dd`` is number p - m of all ``dd``: one sort, then lookups by index. With
    ``headings`` only the ``dt`` with one of these texts are paired.
    """
    wanted = ("parent_id", "node_id", "tag", "text_from", "text_count")
    items = F.array_sort(
        F.transform(
            F.filter(page["nodes"], lambda n: n["tag"].isin("dt", "dd")),
            lambda n: F.struct(*(n[c].alias(c) for c in wanted)),
        )
    )

    def pairs(siblings: Column) -> Column:
        placed = F.transform(siblings, lambda n, p: F.struct(n.alias("n"), p.alias("p")))
        dts = F.transform(
            F.filter(placed, lambda x: x["n"]["tag"] == "dt"),
            lambda x, m: F.struct(
                x["n"].alias("n"), (x["p"] - m).alias("next"), text_stripped(page, x["n"]).alias("heading")
            ),
        )
        if headings is not None:
            dts = F.filter(dts, lambda dt: dt["heading"].isin(*headings))
        dds = F.filter(siblings, lambda n: n["tag"] == "dd")
        return let(dds, lambda bound: F.transform(dts, lambda dt: pair(bound, dt)))

    def pair(dds: Column, dt: Column) -> Column:
        def text_at(index: Column) -> Column:
            return let(
                F.get(dds, index),
                lambda dd: F.when(dd["parent_id"] == dt["n"]["parent_id"], text_stripped(page, dd)),
            )

        return F.struct(
            dt["n"]["node_id"].alias("dt_id"),
            dt["heading"].alias("heading"),
            text_at(dt["next"]).alias("dd"),
            text_at(dt["next"] + 1).alias("next_dd"),
        )

    return let(items, pairs)


def profile_values(pairs: Column) -> Column:
    """Every value a heading gives: ``array<struct<dt_id, field, value>>``.

    A company size yields its number, and the ``dd`` after it the member count.
    """

    def found(source: Column, field, value) -> Column:
        return F.transform(
            source,
            lambda p: F.struct(p["dt_id"].alias("dt_id"), field(p).alias("field"), value(p).alias("value")),
        )

    def own(pair: Column) -> Column:
        return F.when(pair["heading"] == SIZE_HEADING, size_extract(pair["dd"])).otherwise(pair["dd"])

    sizes = F.filter(pairs, lambda p: (p["heading"] == SIZE_HEADING) & p["dd"].isNotNull())
    members = found(sizes, lambda p: F.lit(MEMBERS_HEADING), lambda p: members_extract(p["next_dd"]))
    values = F.concat(found(pairs, lambda p: p["heading"], own), members)
    return F.filter(values, lambda v: v["value"].isNotNull())


def profile_fields(values: Column, spec: ExtractionSpec) -> Column:
    """A struct with one column per wanted heading; the last value in the page wins."""

    def last(heading: str) -> Column:
        return or_missing(F.array_max(F.filter(values, lambda v: v["field"] == heading))["value"])

    return F.struct(*(last(heading).alias(column) for heading, column in spec.headings.items()))


def facet_bars(page: Column, index: str, spec: ExtractionSpec) -> Column:
    """The bars of one facet: ``array<struct<label, count>>`` in document order.

    Empty without the facet. A bar without any ``span`` has the missing mark as
    label; a bar that has spans but no category among them has a NULL label.
    """

    def bar(button: Column) -> Column:
        return let(inside(page, button), label_and_count)

    def label_and_count(inner: Column) -> Column:
        category = first_by_class(inner, "span", spec.category_class)
        return F.struct(
            F.when(~F.exists(inner, lambda n: n["tag"] == "span"), "-")
            .otherwise(let(category, lambda span: strip(text_raw(page, span))))
            .alias("label"),
            or_missing(let(first_by_tag(inner, "strong"), lambda n: strip(text_raw(page, n)))).alias("count"),
        )

    item = _first(page["nodes"], lambda n: (n["tag"] == "li") & (n["attrs"][spec.item_attr] == index))
    bars = let(
        item,
        lambda li: F.transform(
            F.filter(
                inside(page, li),
                lambda n: (n["tag"] == "button") & F.array_contains(n["classes"], spec.bar_class),
            ),
            bar,
        ),
    )
    return F.coalesce(bars, F.expr("cast(array() as array<struct<label:string,count:string>>)"))


def has_unlabelled_bar(bars: Column) -> Column:
    return F.exists(bars, lambda b: b["label"].isNull())
