"""Record lists -> long rows, wide rows and role columns."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgloom.functions.values import let, or_missing
from orgloom.schemas import MISSING

log = logging.getLogger(__name__)

#: What is added to a label that is named like a base column.
RENAMED = " (role)"
#: Labels up to which a wide table is made; its columns are names in the plan and on the driver.
MAX_COLUMNS = 50_000
ITEMS_TYPE = "array<struct<label:string,count:string>>"


def _python_text(value: Column) -> Column:
    """Text of a JSON scalar as Python prints it."""
    return (
        F.when(F.is_variant_null(value), "None")
        .when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(F.try_variant_get(value, "$", "string")))
        .otherwise(F.try_variant_get(value, "$", "string"))
    )


def _is_plain(value: Column) -> Column:
    """Whether a cast key is there and no JSON boolean, which Python prints differently."""
    return value.isNotNull() & ~value.isin("true", "false")


def _key(entry: Column, key: str, default: str) -> Column:
    """A key of an entry: the default if absent, NULL if it is an explicit null."""
    value = F.try_variant_get(entry, f"$.{key}", "variant")
    return F.when(value.isNull(), F.lit(default)).when(~F.is_variant_null(value), _python_text(value))


def _characters(text: Column) -> Column:
    places = F.when(F.char_length(text) > 0, F.sequence(F.lit(1), F.char_length(text)))
    return F.transform(places, lambda place: F.substr(text, place, F.lit(1)))


def normalise_items(listed: Column, label_key: str, default_label: str = MISSING) -> Column:
    """The list field as ``array<struct<label, count>>``.

    A list gives one item per element, a text one item per character, an object one
    per key, and an absent, null or numeric field none. An element that is not an
    object becomes a label whose count is NULL; the count of an entry never is.

    Most lists hold complete entries only. One cast reads such a list as a whole, and
    the others take the general way, element by element.
    """
    entry_type = f"struct<{label_key}:string,Count:string>"

    def chosen(entries: Column) -> Column:
        complete = F.forall(entries, lambda e: _is_plain(e[label_key]) & _is_plain(e["Count"]))
        return F.when(complete, entries.cast(ITEMS_TYPE)).otherwise(
            let(
                F.try_variant_get(listed, "$", "array<variant>"),
                lambda elements: F.when(elements.isNotNull(), F.transform(elements, item)).otherwise(
                    _other_items(listed)
                ),
            )
        )

    def item(element: Column) -> Column:
        return let(F.try_variant_get(element, "$", entry_type), lambda entry: from_entry(element, entry))

    def from_entry(element: Column, entry: Column) -> Column:
        label, count = entry[label_key], entry["Count"]
        text = F.when(element.isNull(), "None").otherwise(_python_text(element))
        no_count = F.lit(None).cast("string")
        return F.struct(
            F.when(entry.isNull(), text)
            .when(_is_plain(label), label)
            .otherwise(_key(element, label_key, default_label))
            .alias("label"),
            F.when(entry.isNull(), no_count)
            .when(_is_plain(count), count)
            .otherwise(or_missing(_key(element, "Count", MISSING)))
            .alias("count"),
        )

    entries = F.try_variant_get(listed, "$", f"array<{entry_type}>")
    return F.when(listed.isNotNull(), let(entries, chosen)).otherwise(F.array().cast(ITEMS_TYPE))


def _other_items(listed: Column) -> Column:
    """Items of a list field that is not a list: the characters of a text, the keys of an object."""
    kind = F.schema_of_variant(listed)
    labels = F.when(kind == "STRING", _characters(F.try_variant_get(listed, "$", "string"))).when(
        F.startswith(kind, F.lit("OBJECT")), F.map_keys(F.try_variant_get(listed, "$", "map<string,variant>"))
    )
    items = F.transform(
        labels, lambda label: F.struct(label.alias("label"), F.lit(None).cast("string").alias("count"))
    )
    return F.coalesce(items, F.array().cast(ITEMS_TYPE))


def explode_items(records: DataFrame, items: str = "items") -> DataFrame:
    """One row per item with its place; a record without items has no row."""
    others = [F.col(f"`{c}`") for c in records.columns if c != items]
    placed = F.transform(
        F.col(items),
        lambda i, p: F.struct(
            p.alias("pos"),
            or_missing(i["label"]).alias("label"),
            or_missing(i["count"]).alias("count"),
            i["count"].isNotNull().alias("is_entry"),
        ),
    )
    return records.select(*others, F.inline(placed))


def last_wins(items: Column) -> Column:
    """``map<label, count>`` of one record; the last of several equal labels counts."""
    by_label = F.array_sort(
        F.transform(
            items,
            lambda i, p: F.struct(
                or_missing(i["label"]).alias("label"), p.alias("pos"), or_missing(i["count"]).alias("count")
            ),
        )
    )

    def keep_last(ordered: Column) -> Column:
        following = lambda p: F.get(ordered, p + 1)["label"]
        return F.filter(ordered, lambda i, p: ~i["label"].eqNullSafe(following(p)))

    return let(
        by_label,
        lambda ordered: F.map_from_entries(
            F.transform(keep_last(ordered), lambda i: F.struct(i["label"], i["count"]))
        ),
    )


def role_columns(records: DataFrame, order: str = "record_order", items: str = "items") -> DataFrame:
    """Every label with the place where it is first seen.

    The minimum combines on the map side, so a label that fills a third of all
    rows leaves each task as one row.
    """
    exploded = explode_items(records.select(order, items), items)
    place = F.struct(F.col(order).alias("record"), F.col("pos"))
    return exploded.groupBy("label").agg(F.min(place).alias("first_seen"))


def role_names(
    records: DataFrame,
    order: str = "record_order",
    items: str = "items",
    column_order: str = "first_seen",
) -> list[str]:
    """The labels as column names, by first appearance or by name.

    Only the distinct labels come to the driver, where a table's column names have
    to be, and no more than ``MAX_COLUMNS``. The long table and the map column need none
    of them.
    """
    if column_order == "name":
        labels = explode_items(records.select(items), items).select("label").distinct()
        ranked = labels.orderBy("label")
    elif column_order == "first_seen":
        ranked = role_columns(records, order, items).orderBy("first_seen").select("label")
    else:
        raise ValueError(f"unknown column order {column_order!r}")
    return bounded_names(ranked)


def bounded_names(ranked: DataFrame, most: int = MAX_COLUMNS) -> list[str]:
    """The labels as a list, which has to fit the driver and a table's schema."""
    names = [row[0] for row in ranked.limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} labels are too many columns: use the long form")
    return names


def free_names(names: Sequence[str], taken: Sequence[str]) -> dict[str, str]:
    """Label -> column name; a label equal to a base column gets a suffix."""
    used, result = set(taken), {}
    labels = set(names)
    for name in names:
        column = name
        while column in used or (column != name and column in labels):
            column += RENAMED
        used.add(column)
        result[name] = column
    return result


def to_wide(records: DataFrame, names: Sequence[str], counts: str = "counts") -> DataFrame:
    """One column per label, read off the record's map: no shuffle, one row per record.

    The map is written as JSON and read back under the labels once, so the cost is
    linear in columns plus entries.
    """
    base = [c for c in records.columns if c != counts]
    columns = free_names(names, base)
    renamed = [name for name, column in columns.items() if name != column]
    if renamed:
        log.warning("%d role columns renamed, they are named like base columns: %s", len(renamed), renamed)
    if not columns:
        return records.select(*(F.col(f"`{c}`") for c in base))
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    cells = F.inline(F.array(F.from_json(F.to_json(counts), schema)))
    wide = records.select(*(F.col(f"`{c}`") for c in base), cells).toDF(*base, *columns.values())
    return wide.select(*(F.col(f"`{c}`") for c in base), *(or_missing(F.col(_quoted(c))).alias(c) for c in columns.values()))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def to_long(wide: DataFrame, base: Sequence[str], label: str = "label", count: str = "count") -> DataFrame:
    """The wide table back as one row per filled cell."""
    roles = [c for c in wide.columns if c not in base]
    cells = F.array(
        *(F.struct(F.lit(c).alias(label), F.col(f"`{c}`").alias(count)) for c in roles)
    )
    return wide.select(*(F.col(f"`{c}`") for c in base), F.inline(cells)).filter(F.col(count) != MISSING)
