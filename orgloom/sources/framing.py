"""Records of one large file, shared among tasks although their ends can't be told locally.

Whether a line break ends a CSV record depends on the quotes before it, and whether a
brace ends a JSON record on the quotes and braces before it, back to the start of the
file. The file is read in pieces that end at every candidate (a line break, a closing
brace), which Spark can share among tasks. One narrow pass finds what each split does to
the state; added up over the splits of a file (one row for each), that gives the state in which each
split begins. In a second pass every task then joins its pieces to records.
Only records that reach over a split's end leave their task, as a few parts that are
joined by file. Records are parsed by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orgloom.operators.order import file_place

#: What ends a piece, by format.
ENDS = {"csv": "\n", "json": "}"}
SPLIT = ["file", "block"]
_SCHEMA = "file string, block long, row long, whole boolean, ends boolean, record binary"


def pieces(spark: SparkSession, path: str | list[str], fmt: str) -> DataFrame:
    """file, block, row and value (bytes) of every piece, without its end."""
    text = spark.read.option("lineSep", ENDS[fmt]).option("recursiveFileLookup", True).text(path)
    return text.select(*file_place(), F.col("value").cast("binary").alias("value"))


def _quotes(value: Column, fmt: str) -> Column:
    """How many quotes of a piece open or close a text."""
    text = F.decode(value, "ISO-8859-1")  # one character for each byte
    plain = F.regexp_replace(text, r"(?s)\\.", "") if fmt == "json" else text
    return F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))


def _opened(value: Column, inside: int) -> Column:
    """Braces that a piece opens outside of texts, if it begins inside one or not, less the one that ends it."""
    text = F.regexp_replace(F.decode(value, "ISO-8859-1"), r"(?s)\\.", "")
    parts = F.split(text, '"', -1)
    outside = F.filter(parts, lambda _, i: i % 2 == inside)
    opened = F.aggregate(outside, F.lit(0), lambda n, s: n + F.length(s) - F.length(F.replace(s, F.lit("{"), F.lit(""))))
    closes = F.size(parts) % 2 == (0 if inside else 1)  # the brace that ends the piece is outside
    return opened - closes.cast("int")


def split_states(found: DataFrame, fmt: str) -> DataFrame:
    """file, block, inside and depth: in what state each split begins."""
    sums = [F.sum(_quotes(F.col("value"), fmt)).alias("quotes")]
    if fmt == "json":
        # the state inside a split follows from the quotes before each piece in it
        before = Window.partitionBy(*SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
        narrow = found.select(*SPLIT, "row", _quotes(F.col("value"), fmt).alias("q"), *(_opened(F.col("value"), i).alias(f"d{i}") for i in (0, 1)))
        odd = F.coalesce(F.sum("q").over(before), F.lit(0)) % 2
        placed = narrow.select(*SPLIT, "q", F.when(odd == 0, F.col("d0")).otherwise(F.col("d1")).alias("out"), F.when(odd == 0, F.col("d1")).otherwise(F.col("d0")).alias("in"))
        totals = placed.groupBy(*SPLIT).agg(F.sum("q").alias("quotes"), F.sum("out").alias("out"), F.sum("in").alias("in"))
    else:
        totals = found.groupBy(*SPLIT).agg(*sums)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).cast("int")
    states = totals.withColumn("inside", inside)
    if fmt == "json":
        change = F.when(F.col("inside") == 1, F.col("in")).otherwise(F.col("out"))
        states = states.withColumn("change", change).withColumn("depth", F.coalesce(F.sum("change").over(earlier), F.lit(0)).cast("int"))
    else:
        states = states.withColumn("depth", F.lit(0))
    return states.select(*SPLIT, "inside", "depth")


class Frame:
    """Follows the state of one split and says after each piece whether a record ends there."""

    def __init__(self, fmt: str, inside: int, depth: int):
        self.json, self.inside, self.depth = fmt == "json", inside, depth

    def ends(self, value: bytes) -> bool:
        if not self.json:
            self.inside ^= value.count(b'"') & 1
            return not self.inside
        plain = re.sub(rb"\\.", b"", value, flags=re.DOTALL) if b"\\" in value else value
        parts = plain.split(b'"')
        self.depth += sum(p.count(b"{") for p in parts[self.inside :: 2])
        self.inside ^= (len(parts) - 1) & 1
        if self.inside:
            return False
        self.depth -= 1  # the brace that ends the piece
        return self.depth == 0


def framed(found: DataFrame, fmt: str) -> DataFrame:
    """file, block, row (of a record's first piece) and record (bytes, with its last piece's end).

    What follows the last record of a file comes as a record of its own.
    """
    known = found.join(F.broadcast(split_states(found, fmt)), SPLIT)
    end = ENDS[fmt].encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, frame, held, first, whole, out = None, None, [], None, True, []

        def row(ends: bool) -> tuple:
            return (*at, first, whole and ends, ends, b"".join(held))

        def sent() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            names = ["file", "block", "row", "whole", "ends", "record"]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("file", "block", "row", "value", "inside", "depth")]
            for file, block, number, value, inside, depth in zip(*columns, strict=True):
                if (file, block) != at:
                    if held:
                        out.append(row(False))
                    at, frame, held = (file, block), Frame(fmt, inside, depth), []
                    whole = not inside and not depth  # or the first record began in an earlier split
                if not held:
                    first = number
                held += (value, end)
                if frame.ends(value):
                    out.append(row(True))
                    held, whole = [], True
            if out:
                yield sent()
        if held:
            out.append(row(False))
            yield sent()

    made = known.select(*SPLIT, "row", "value", "inside", "depth").mapInArrow(run, _SCHEMA)
    parts = made.filter("not whole")
    # Parts of records that reach over splits: a record's parts are those with as many ends before them.
    before = Window.partitionBy("file").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, -1)
    numbered = parts.withColumn("record_no", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
    part = F.struct("block", "row", "record")
    joined = numbered.groupBy("file", "record_no").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    record = F.aggregate("parts", F.lit(b"").cast("binary"), lambda whole, p: F.concat(whole, p["record"]))
    over = joined.select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["row"].alias("row"), record.alias("record"))
    return made.filter("whole").select("file", "block", "row", "record").unionByName(over)
