"""Fill-in-middle transformation as an Arrow compute pipeline.

A text is cut into units (white space with the word behind it, or white space at the end),
and two cuts between units divide it into prefix, middle and suffix. Every step works on
whole batches: units become list arrays, these are flattened with the number of their
text, ordinals tell the role of each unit, the units of a role are filtered and made lists
again, and the lists are joined to pieces. Batches are taken in slices of about ``SLICE``
bytes, so what a task holds is bounded by that and its longest text.

The cuts and the form depend on the seed and the row's id alone, so a task that runs again
gives the same rows, and so does another layout of the table.

Defined results: a null text is an empty one; an empty text, and one that holds one of the
marks, stays plain, so every output can be turned back; white space alone is one unit; a
missing id draws like an empty one; rows with equal id and text get the same output; an
empty table gives none. All columns pass through but those named like the added ones,
which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgloom.llm.common import arrow_schema, as_batches, id_text, others, table

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: Marks of prefix, suffix and middle. No end of one is the beginning of another.
MARKS = ("<P>", "<S>", "<M>")
#: Hundredths of the rows that are transformed, and of these the ones with the suffix first.
RATE, SUFFIX_FIRST = 50, 80
SEED = 42
SLICE = 1 << 23
#: A byte that UTF-8 never has.
END = b"\xff"
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def draws(seed: int, column: str = "doc_id") -> list[Column]:
    """Four numbers below 2**32 from seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_text(column), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def form_of(text: Column, third: Column, fourth: Column, rate: int, suffix_first: int, marks: tuple[str, ...]) -> Column:
    kept = (text == "") | (F.pmod(third, F.lit(100)) >= rate)
    for mark in marks:
        kept = kept | text.contains(mark)
    return F.when(kept, "plain").when(F.pmod(fourth, F.lit(100)) < suffix_first, "spm").otherwise("psm")


def units(text: pa.Array) -> pa.ListArray:
    """The units of each text as a list; an empty piece ends every list."""
    return pc.split_pattern(pc.replace_substring_regex(text, UNIT, rb"\0" + END), END)


def remainder(number: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(number, pc.multiply(pc.divide(number, by), by))


def pieces(lists: pa.ListArray, first: pa.Array, last: pa.Array) -> pa.Array:
    """The units from ``first`` on and before ``last`` of each list, joined."""
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    begin = pc.subtract(lists.offsets[:-1], lists.offsets[0]).cast(pa.int64())
    ordinal = pc.subtract(pa.arange(0, len(flat)), pc.take(begin, parent))
    mine = pc.and_(
        pc.greater_equal(ordinal, pc.take(first, parent)),
        pc.less(ordinal, pc.take(last, parent)),
    )
    sizes = pc.cumulative_sum(pc.subtract(last, first))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), sizes.cast(pa.int32())])
    return pc.binary_join(pa.ListArray.from_arrays(offsets, flat.filter(mine)), b"")


def transform(text: pa.Array, one: pa.Array, two: pa.Array, form: pa.Array, marks: tuple[str, ...] = MARKS) -> dict:
    """n, prefix_chars, middle_chars and output of texts (bytes) with two draws and a form."""
    lists = units(text)
    n = pc.subtract(pc.list_value_length(lists), 1).cast(pa.int64())
    moved = pc.not_equal(form, "plain")
    cut = [remainder(x, pc.add(n, 1)).filter(moved) for x in (one, two)]
    low, high = pc.min_element_wise(*cut), pc.max_element_wise(*cut)
    inside, size = lists.filter(moved), n.filter(moved)
    prefix = pieces(inside, pc.multiply(low, 0), low)
    middle = pieces(inside, low, high)
    suffix = pieces(inside, high, size)
    p, s, m = (pa.scalar(x.encode(), pa.binary()) for x in marks)
    joined = pc.if_else(
        pc.equal(form.filter(moved), "psm"),
        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, b""),
        pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, b""),
    )

    def chars(piece: pa.Array) -> pa.Array:
        return pc.utf8_length(piece.cast(pa.string())).cast(pa.int64())

    def placed(values: pa.Array, rest: pa.Array) -> pa.Array:
        return pc.replace_with_mask(rest, moved, values)

    none = pa.nulls(len(text), pa.int64())
    return {
        "n": n,
        "prefix_chars": placed(chars(prefix), none),
        "middle_chars": placed(chars(middle), none),
        "output": placed(joined, text).cast(pa.string()),
    }


def slices(text: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Begin and length of runs of texts with about ``most`` bytes, a longer text alone."""
    begin, held = 0, 0
    for i, size in enumerate(pc.binary_length(text).to_pylist()):
        if held and held + size > most:
            yield begin, i - begin
            begin, held = i, 0
        held += size
    if len(text) > begin:
        yield begin, len(text) - begin


def transformed(
    docs: DataFrame,
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    marks: tuple[str, ...] = MARKS,
) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output."""
    passed = others(docs, ADDED)
    text = F.coalesce("text", F.lit(""))
    one, two, third, fourth = draws(seed)
    asked = docs.select(
        F.struct(*passed.values()).alias("row") if passed else F.lit(None).cast("int").alias("row"),
        text.cast("binary").alias("text"),
        one.alias("one"),
        two.alias("two"),
        form_of(text, third, fourth, rate, suffix_first, marks).alias("form"),
    )
    schema = T.StructType(
        [
            asked.schema["row"],
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output", T.StringType()),
        ]
    )
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, length in slices(batch["text"]):
                part = batch.slice(begin, length)
                made = transform(part["text"], part["one"], part["two"], part["form"], marks)
                yield from as_batches(made | {"row": part["row"], "form": part["form"]}, arrow)

    made = asked.mapInArrow(run, schema)
    return made.select(*(F.col("row").getField(c).alias(c) for c in passed), *ADDED)


def restored(output: Column, form: Column, marks: tuple[str, ...] = MARKS) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, "|".join(rf"\Q{mark}\E" for mark in marks), -1)
    first, second, middle = parts[1], parts[2], parts[3]
    return (
        F.when(form == "psm", F.concat(first, middle, second))
        .when(form == "spm", F.concat(second, middle, first))
        .otherwise(output)
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transformed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT doc_id, t, regexp_extract_all(t, '{UNIT}') AS units,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM d
), cut AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n,
           least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS low,
           greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS high,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {RATE}
                THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, coalesce(array_to_string(units[1:low], ''), '') AS p,
           coalesce(array_to_string(units[low + 1:high], ''), '') AS m,
           coalesce(array_to_string(units[high + 1:], ''), '') AS s
    FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
