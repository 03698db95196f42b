"""Page corpus -> element nodes: one array per page, or the node table."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgloom.functions.text import strip
from orgloom.operators import tokenizer
from orgloom.schemas import ExtractionSpec

# Workers get the tokenizer with the task, so a cluster need not install the package.
cloudpickle.register_pickle_by_value(tokenizer)

NODE_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.IntegerType()),
        T.StructField("parent_id", T.IntegerType()),
        T.StructField("last_desc_id", T.IntegerType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("n_inner", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("classes", T.ArrayType(T.StringType())),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text_from", T.IntegerType()),
        T.StructField("text_count", T.IntegerType()),
    ]
)

# Output batches are cut at about this much page text. A worker holds its elements as Python
# objects, which take some 25 times the room of the text.
BATCH_CHARS = 512 * 1024


def with_nodes(
    pages: DataFrame,
    spec: ExtractionSpec,
    all_tags: bool = False,
    text_tags: frozenset[str] | None = None,
    all_texts: bool = False,
) -> DataFrame:
    """Replace ``html`` by ``page``; a map-only step without shuffle.

    ``page.nodes`` holds the kept elements in document order, so everything extracted
    from a page later is an expression over one row. ``pos`` is an element's index in
    the array and ``n_inner`` the number of kept elements inside, so the inside of an
    element is a slice. ``page.texts`` holds each text node once and ``page.stripped``
    the same cut at both ends; an element's text is a slice of these. ``all_texts``
    keeps the text of every kept element, whatever its tag.
    """
    run = tokenizer.batch_tokenizer(
        keep_tags=None if all_tags else spec.text_tags | {"li", "button"},
        keep_classes=spec.marker_classes,
        keep_attrs=spec.marker_attrs,
        text_tags=None if all_texts else spec.text_tags if text_tags is None else text_tags,
        max_chars=BATCH_CHARS,
    )
    kept = [f for f in pages.schema.fields if f.name != "html"]
    schema = T.StructType(
        [
            *kept,
            T.StructField("nodes", T.ArrayType(NODE_SCHEMA)),
            T.StructField("texts", T.ArrayType(T.StringType())),
            T.StructField("parse_error", T.StringType()),
        ]
    )
    parsed = pages.mapInArrow(run, schema).withColumn("stripped", F.transform("texts", strip))
    return parsed.select(
        *(F.col(f.name) for f in kept), F.struct("nodes", "texts", "stripped").alias("page"), "parse_error"
    )


def _text(texts: Column, node: Column) -> Column:
    return F.array_join(F.slice(texts, node["text_from"] + 1, node["text_count"]), "")


def text_raw(page: Column, node: Column) -> Column:
    """The element's text nodes as they are, joined; NULL if its text was not kept."""
    return _text(page["texts"], node)


def text_stripped(page: Column, node: Column) -> Column:
    """The element's text nodes, each cut at both ends, joined without a separator."""
    return _text(page["stripped"], node)


def node_table(parsed: DataFrame) -> DataFrame:
    """One row per element, with both forms of its text."""
    page = F.col("page")
    others = [c for c in parsed.columns if c not in ("page", "parse_error")]
    columns = [f.name for f in NODE_SCHEMA if not f.name.startswith("text")]
    rows = F.transform(
        page["nodes"],
        lambda n: F.struct(
            *(n[c].alias(c) for c in columns),
            text_raw(page, n).alias("text_raw"),
            text_stripped(page, n).alias("text_stripped"),
        ),
    )
    return parsed.select(*others, F.inline(rows))
