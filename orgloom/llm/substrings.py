"""Substring deduplication by super-k-mer partitioning.

A window is ``SPAN`` consecutive words. Its minimiser is the smallest hash among its runs
of ``MINIMISER`` words. Consecutive windows of a document with the same minimiser form a
super-k-mer, which travels as one packed string to the minimiser's bucket. All copies of
a window meet there, and sorting the bucket's windows finds the smallest document of each.

1. A narrow pass (one row of two numbers for each super-k-mer) finds the minimisers that
   occur in more than one document. No other window can have a copy. They are kept in a
   bit table of a fixed size, in which a clash only lets a needless string travel.
2. The super-k-mers with such minimisers are packed and dealt out by minimiser.
3. In a bucket equal strings lie together: all but those of the smallest document are
   repeats as a whole. The windows of the distinct strings are sorted by their hashes.
4. The repeated stretches of words are joined to the documents, whose other words stay.

A bucket is read as a sorted stream. If it holds more than ``HELD`` distinct strings
(a frequent phrase in very many surroundings), their windows go on as rows and Spark's
own aggregation, which spills, finds their smallest documents; nothing is left out.

Words and strings are compared as they are, windows by 128 bits of two rolling hashes.
Defined results: a null or empty text has no words and loses none; texts shorter than a
window keep all; windows repeated only within one document stay; rows with one doc_id
never remove each other's words; a missing doc_id counts as larger than all others;
windows, and strings of hot minimisers, are told apart by hashes of 128 and 64 bits; an
empty table gives no rows; columns besides id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orgloom.llm.common import arrow_schema, as_batches, map_batches, n_partitions, small, split_words, staged, table
from orgloom.llm.hashing import WordHashes, rolling_hashes, sequence_hashes, signed

SPAN = 50
MINIMISER = 8
HELD = 50_000
#: Bits of the table of repeated minimisers (16 MB), and rows of output that a task gathers.
TABLE_BITS = 1 << 27
ROWS = 20_000
#: Documents of a minimiser up to which it may be one task's work, however many tasks there are.
HOT = 1_000
LAST = (1 << 63) - 1




def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive numbers, from prefixes and suffixes of blocks."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def super_kmers(hashes: np.ndarray, span: int = SPAN, part: int = MINIMISER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of each super-k-mer."""
    if len(hashes) < span:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    part = min(part, span)
    least = sliding_min(sequence_hashes(hashes, part), span - part + 1)
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return least[starts], starts, np.diff(np.append(starts, len(least)))


def keyed(docs: DataFrame) -> DataFrame:
    """doc (``LAST`` for a missing id), th (a hash that tells rows of one id apart) and text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("th"), "text"
    )


def minimisers(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """mini and doc, once for each task's batch and document."""

    def make():
        hashes = WordHashes()

        def run(batch: pa.RecordBatch) -> dict:
            minis, of = [], []
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = split_words(text)
                if len(words) >= span:
                    found = np.unique(super_kmers(hashes(words), span)[0])
                    minis.append(found)
                    of.append(np.full(len(found), doc, np.int64))
            if not minis:
                return None
            return {"mini": pa.array(signed(np.concatenate(minis))), "doc": pa.array(np.concatenate(of))}

        return run

    return map_batches(docs.select("doc", "text"), make, "mini long, doc long")


def repeated(minis: DataFrame) -> DataFrame:
    """mini and n (documents, or more) of the minimisers that occur in several documents."""
    sums = minis.groupBy("mini").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n"))
    return staged(sums.filter("low != high").select("mini", "n"), "minimisers")


def hot_minimisers(several: DataFrame, least: int = HOT) -> DataFrame:
    """Minimisers with more than a quarter of what a task has on average: four for each task at most."""
    total = several.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return several.filter(F.col("n") > max(least, total // (4 * n_partitions(several)))).select("mini")


def repeated_table(several: DataFrame, bits: int = TABLE_BITS) -> np.ndarray:
    """Bits, by minimiser modulo ``bits``, of these minimisers.

    Spark gathers the bits into words; at most ``bits / 64`` words reach the driver.
    """
    place = F.pmod("mini", F.lit(bits))
    words = several.select(
        F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(mini, {bits}L) % 64 as int))").alias("bit")
    )
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[got["word"].to_numpy()] = got["bits"].to_numpy()
    return out


def packed(docs: DataFrame, repeated: np.ndarray, span: int = SPAN) -> DataFrame:
    """mini, ph (a hash of the string), doc, th, start and the packed string of each super-k-mer that may repeat."""
    bits = repeated.size * 64
    shared = docs.sparkSession.sparkContext.broadcast(repeated)
    schema = StructType.fromDDL("mini long, ph long, doc long, th long, start int, words int, packed binary")
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, table = WordHashes(), shared.value
        for batch in batches:
            out: list[tuple] = []
            for doc, th, text in zip(*[batch[c].to_pylist() for c in ("doc", "th", "text")], strict=True):
                words = split_words(text)
                if len(words) < span:
                    continue
                minis, starts, counts = super_kmers(hashes(words), span)
                minis = signed(minis)
                place = minis % bits
                may = (table[place >> 6] >> (place & 63)) & 1
                for i in np.flatnonzero(may):
                    start = int(starts[i])
                    string = b" ".join(words[start : start + int(counts[i]) + span - 1])
                    ph = xxhash.xxh3_64_intdigest(string) - (1 << 63)
                    out.append((int(minis[i]), ph, doc, th, start, int(counts[i]) + span - 1, string))
                if len(out) >= ROWS:
                    yield from as_batches(dict(zip(arrow.names, zip(*out, strict=True), strict=True)), arrow)
                    out = []
            if out:
                yield from as_batches(dict(zip(arrow.names, zip(*out, strict=True), strict=True)), arrow)

    return docs.mapInArrow(run, schema)


class Bucket:
    """The distinct strings of one minimiser, and what they show to be repeated."""

    def __init__(self, span: int, hashes: WordHashes):
        self.span, self.hashes = span, hashes
        self.strings: list[bytes] = []
        self.docs: list[int] = []
        self.places: list[dict[tuple[int, int], None]] = []
        self.spilled = False

    def windows(self, string: bytes) -> tuple[np.ndarray, np.ndarray]:
        h = self.hashes(string.split(b" "))
        return rolling_hashes(h, self.span, 11), rolling_hashes(h, self.span, 23)

    def repeats(self) -> Iterator[tuple[int, int, int, int]]:
        """(doc, th, first word, last word) of stretches whose windows a smaller document has."""
        if len(self.strings) < 2 or min(self.docs) == max(self.docs):
            return
        pairs = [self.windows(s) for s in self.strings]
        sizes = np.array([len(a) for a, _ in pairs])
        one, two = np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs])
        docs = np.repeat(np.array(self.docs, np.int64), sizes)
        order = np.lexsort((docs, two, one))
        fresh = np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])])
        least = docs[order][fresh][np.cumsum(fresh) - 1]
        repeated = np.zeros(len(docs), bool)
        repeated[order] = least < docs[order]
        ends = np.cumsum(sizes)
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(repeated), side="right")):
            at = np.flatnonzero(repeated[ends[i] - sizes[i] : ends[i]])
            for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                for th, start in self.places[i]:
                    yield self.docs[i], th, start + int(run[0]), start + int(run[-1]) + self.span - 1

    def rows(self) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(fp1, fp2, doc, th, first, last) of every window, for Spark to compare."""
        for string, doc, places in zip(self.strings, self.docs, self.places, strict=True):
            one, two = self.windows(string)
            for th, start in places:
                for j, (a, b) in enumerate(zip(signed(one).tolist(), signed(two).tolist(), strict=True)):
                    yield a, b, doc, th, start + j, start + j + self.span - 1
        self.strings, self.docs, self.places, self.spilled = [], [], [], True


def bucket_rows(strings: DataFrame, span: int = SPAN, held: int = HELD) -> DataFrame:
    """doc, th, first, last of repeated stretches; with fp1 and fp2 instead, windows that remain to be compared."""
    schema = StructType.fromDDL("fp1 long, fp2 long, doc long, th long, first int, last int")
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        out: list[tuple] = []
        bucket, mini, string, least, n = Bucket(span, hashes), None, None, None, 0

        def sent() -> Iterator[pa.RecordBatch]:
            yield from as_batches(dict(zip(arrow.names, zip(*out, strict=True), strict=True)), arrow)
            out.clear()

        def done() -> None:
            if bucket.spilled:
                out.extend(bucket.rows())
            else:
                out.extend((None, None, *row) for row in bucket.repeats())

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("mini", "doc", "th", "start", "packed")]
            for of, doc, th, start, this in zip(*columns, strict=True):
                if of != mini:
                    done()
                    bucket, mini, string = Bucket(span, hashes), of, None
                if this != string:
                    string, least, n = this, doc, this.count(b" ") + 1
                    bucket.strings.append(string)
                    bucket.docs.append(doc)
                    bucket.places.append({(th, start): None})
                elif doc == least:
                    if bucket.places:
                        bucket.places[-1][th, start] = None
                    else:  # its string has gone on as rows already
                        bucket.strings.append(string)
                        bucket.docs.append(doc)
                        bucket.places.append({(th, start): None})
                else:
                    out.append((None, None, doc, th, start, start + n - 1))
                if len(bucket.strings) > held:
                    for row in bucket.rows():
                        out.append(row)
                        if len(out) >= 5 * ROWS:
                            yield from sent()
                if len(out) >= ROWS:
                    yield from sent()
        done()
        if out:
            yield from sent()

    dealt = strings.repartition(n_partitions(strings), "mini").sortWithinPartitions("mini", "ph", "doc", "th", "start")
    return dealt.mapInArrow(run, schema)


def hot_rows(strings: DataFrame, span: int = SPAN) -> DataFrame:
    """Like ``bucket_rows`` for strings of hot minimisers, which are never gathered in one task.

    Of equal strings, those of the smallest document stand for all: the others repeat them
    whole. The windows of what stands are compared like those of a bucket that is too large.
    """
    least = staged(strings.groupBy("mini", "ph").agg(F.min("doc").alias("least")), "least")
    known = small(least.select(F.col("mini").alias("m"), F.col("ph").alias("p"), "least"))
    placed = strings.join(known, (F.col("mini") == F.col("m")) & (F.col("ph") == F.col("p")))
    last = (F.col("start") + F.col("words") - 1).cast("int").alias("last")
    none = [F.lit(None).cast("long").alias(c) for c in ("fp1", "fp2")]
    again = placed.filter("doc != least").select(*none, "doc", "th", F.col("start").alias("first"), last)
    schema = StructType.fromDDL("fp1 long, fp2 long, doc long, th long, first int, last int")
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, out = WordHashes(), []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("doc", "th", "start", "packed")]
            for doc, th, start, string in zip(*columns, strict=True):
                bucket = Bucket(span, hashes)
                bucket.strings, bucket.docs, bucket.places = [string], [doc], [{(th, start): None}]
                out += bucket.rows()
                if len(out) >= ROWS:
                    yield from as_batches(dict(zip(arrow.names, zip(*out, strict=True), strict=True)), arrow)
                    out = []
        if out:
            yield from as_batches(dict(zip(arrow.names, zip(*out, strict=True), strict=True)), arrow)

    standing = placed.filter("doc = least").select("doc", "th", "start", "packed").mapInArrow(run, schema)
    return again.unionByName(standing)


def repeated_stretches(docs: DataFrame, span: int = SPAN, held: int = HELD, hot: int = HOT) -> DataFrame:
    """doc, th and stretches (first and last word) to be removed, from ``keyed`` documents."""
    several = repeated(minimisers(docs, span))
    strings, often = packed(docs, repeated_table(several), span), hot_minimisers(several, hot)
    if often.isEmpty():
        found = bucket_rows(strings.drop("words"), span, held)
    else:
        strings, often = staged(strings, "strings"), F.broadcast(often)  # see ``hot_minimisers`` for how many
        found = bucket_rows(strings.join(often, "mini", "left_anti").drop("words"), span, held)
        found = found.unionByName(hot_rows(strings.join(often, "mini", "left_semi"), span))
    found = staged(found, "stretches")
    known = found.filter("fp1 is null").select("doc", "th", "first", "last")
    left = found.filter("fp1 is not null")
    # Windows of several documents, combined before the shuffle; a window that very many hold is one row of these.
    sums = left.groupBy("fp1", "fp2").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    least = staged(sums.filter("least < most").select("fp1", "fp2", "least"), "windows")
    more = left.join(small(least), ["fp1", "fp2"]).filter("least < doc").select("doc", "th", "first", "last")
    return known.unionByName(more).groupBy("doc", "th").agg(F.collect_set(F.struct("first", "last")).alias("stretches"))


def deduplicated(docs: DataFrame, span: int = SPAN, held: int = HELD, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed and kept, the words that stay joined by one space."""
    rows = keyed(docs)
    cut = repeated_stretches(rows, span, held, hot)
    joined = rows.join(cut, ["doc", "th"], "left").select("doc", "text", "stretches")

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            ids, n, removed, kept = [], [], [], []
            columns = [batch[c].to_pylist() for c in ("doc", "text", "stretches")]
            for doc, text, stretches in zip(*columns, strict=True):
                words = split_words(text)
                stay = remaining(words, [(s["first"], s["last"]) for s in stretches or ()])
                ids.append(None if doc == LAST else doc)
                n.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(b" ".join(stay).decode())
            return {"doc_id": ids, "n_words": n, "n_removed": removed, "kept": kept}

        return run

    return map_batches(joined, make, "doc_id long, n_words long, n_removed long, kept string")


def remaining(words: list[bytes], stretches: list[tuple[int, int]]) -> list[bytes]:
    if not stretches:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for first, last in stretches:
        edges[first] += 1
        edges[last + 1] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int | None, str | None]], span: int = SPAN) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) of each row, with every window in one dictionary."""
    least: dict[tuple, int] = {}
    split = [(LAST if i is None else i, split_words(t)) for i, t in rows]
    for doc, words in split:
        for w in zip(*[words[k:] for k in range(span)], strict=False):
            least[w] = min(least.get(w, LAST), doc)
    out = []
    for (doc, words), (doc_id, _) in zip(split, rows, strict=True):
        windows = enumerate(zip(*[words[k:] for k in range(span)], strict=False))
        stay = remaining(words, [(i, i + span - 1) for i, w in windows if least[w] < doc])
        out.append((doc_id, len(words), len(words) - len(stay), hashlib.sha256(b" ".join(stay)).hexdigest()))
    return out
