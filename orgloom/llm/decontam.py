"""Benchmark decontamination by a distributed positional inverted index.

The index holds one posting (document, position) for each occurrence of a term in the
training documents; for a given benchmark only its terms need postings. Postings stay
with the partition that read their documents, so building the index shuffles nothing.

A window, so many consecutive words of a benchmark item, is looked up from its rarest
terms: the postings of the two rarest, moved by their offsets in the item, are
intersected, which leaves few places (document, alignment with the item). There the
postings of all the item's terms are intersected, and runs of consecutive matches as long
as a window are exact occurrences. Frequent terms thus are only ever read at places that
rare terms have named.

All steps are DataFrame operations. What is broadcast (benchmark terms, anchors) is
checked by ``small``; beyond, the same joins are shuffled, and AQE splits
a frequent term's share.

Defined results: words are runs of letters, digits and non-ASCII characters with A-Z
lower-cased; a null or wordless text has no words, hits or items; an item without words
is never found; a null item_id counts for hits and not as an item; rows with one doc_id
and different texts are looked up apart, equal rows give equal results; extra columns
are ignored, and pass through ``clean`` whatever their names; empty tables give no rows,
or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orgloom.llm.common import plainly_named, small, staged, table

WINDOW = 13
#: Contaminated: a hit, and at least one word in so many hit.
PART = 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["doc_id", "th"]


def words(text: Column) -> Column:
    """Words in order, with an empty string at either end where the text begins or ends between words."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.split(F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)), _BETWEEN)


def word_count(text: Column) -> Column:
    ws = words(text)
    n = F.size(ws)
    ends = (F.element_at(ws, 1) == "").cast("long") + ((n > 1) & (F.element_at(ws, -1) == "")).cast("long")
    return F.when(text.isNull(), F.lit(0)).otherwise(n - ends).cast("long")


def postings(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """doc_id, th (hash of the text), term and pos: of all terms, or of those in ``terms``."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(words(F.col("text"))).alias("pos", "term"))
    rows = rows.filter("term != ''")
    return rows if terms is None else rows.join(small(terms.select("term").distinct()), "term", "left_semi")


def item_terms(benchmark: DataFrame) -> DataFrame:
    """item (a number for each row), item_id, q (position from 0) and term."""
    rows = benchmark.select(F.col("item_id").cast("string"), words(F.col("text")).alias("ws"))
    rows = rows.withColumn("item", F.monotonically_increasing_id())  # before the words become rows
    each = rows.select("item", "item_id", F.posexplode("ws").alias("pos", "term"))
    found = staged(each.filter("term != ''"), "items")
    first = Window.partitionBy("item")  # the position counts from the first word
    return found.withColumn("q", F.col("pos") - F.min("pos").over(first)).drop("pos")


def windows(items: DataFrame, frequencies: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, s (start), q1, t1, q2 and t2: each window's rarest and second rarest place.

    Windows with a term that no document has can't occur and are left out.
    """
    known = items.join(frequencies, "term", "left")
    ahead = Window.partitionBy("item").orderBy("q").rowsBetween(0, window - 1)
    length = F.count("*").over(Window.partitionBy("item"))
    ranked = known.select(
        "item",
        F.col("q").alias("s"),
        length.alias("length"),
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "q", "term")).over(ahead)).alias("by_n"),
    )
    whole = ranked.filter((F.size("by_n") == window) | ((F.col("s") == 0) & (F.col("length") < window)))
    possible = whole.filter(F.col("by_n")[0]["n"] > 0)
    second = F.coalesce(F.get("by_n", F.lit(1)), F.col("by_n")[0])
    return possible.select(
        "item",
        "s",
        F.col("by_n")[0]["q"].alias("q1"),
        F.col("by_n")[0]["term"].alias("t1"),
        second["q"].alias("q2"),
        second["term"].alias("t2"),
    )


def alignments(index: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, th, item and shift: places where some window's two rarest terms both stand.

    ``shift`` is the document's position of the item's first word.
    """
    anchors = found.select("item", "q1", "t1", "q2", "t2").distinct()
    first = index.join(small(anchors), F.col("term") == F.col("t1")).select(
        *KEY, "item", "t2", (F.col("pos") - F.col("q1")).alias("shift"), (F.col("pos") - F.col("q1") + F.col("q2")).alias("at")
    )
    rare = index.join(small(found.select(F.col("t2").alias("term")).distinct()), "term", "left_semi")
    rare = rare.select(F.col("doc_id").alias("d2"), F.col("th").alias("h2"), F.col("pos").alias("p2"), F.col("term").alias("w2"))
    both = first.join(
        rare, F.col("doc_id").eqNullSafe(F.col("d2")) & F.expr("th = h2 AND at = p2 AND t2 = w2"), "left_semi"
    )
    return both.select(*KEY, "item", "shift").distinct()


def matched_runs(index: DataFrame, items: DataFrame, places: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, th, item, pos of every document word in an occurrence of a window of the item."""
    lengths = items.groupBy("item").agg(F.count("*").alias("length"), F.min("item_id").alias("item_id"))
    wanted = places.join(small(items.select("item", "q", "term")), "item").select(
        F.col("doc_id").alias("d"), F.col("th").alias("h"), "item", "shift", "q", F.col("term").alias("t"), (F.col("shift") + F.col("q")).alias("p")
    )
    named = places.select(F.col("doc_id").alias("d0"), F.col("th").alias("h0")).distinct()
    near = index.join(small(named), F.expr("th = h0") & F.col("doc_id").eqNullSafe(F.col("d0")), "left_semi")
    hit = near.join(wanted, F.expr("th = h AND pos = p AND term = t") & F.col("doc_id").eqNullSafe(F.col("d")))
    one = Window.partitionBy("doc_id", "th", "item", "shift").orderBy("q")
    runs = hit.select(*KEY, "item", "shift", "q", "pos").distinct().withColumn("run", F.col("q") - F.row_number().over(one))
    sized = runs.withColumn("n", F.count("*").over(Window.partitionBy("doc_id", "th", "item", "shift", "run")))
    return (
        sized.join(small(lengths), "item")
        .filter(F.col("n") >= F.least("length", F.lit(window)))
        .select(*KEY, "item", "item_id", "pos")
        .distinct()
    )


def phrase_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, th, n_hit, items (ids as sorted strings), one row for each document with an occurrence."""
    items = staged(item_terms(benchmark), "terms")
    index = staged(postings(docs, items), "postings")
    frequencies = index.groupBy("term").agg(F.count("*").alias("n"))
    found = staged(windows(items, frequencies, window), "windows")
    places = staged(alignments(index, found), "places")
    words_hit = staged(matched_runs(index, items, places, window), "hits")
    return words_hit.groupBy(*KEY).agg(
        F.countDistinct("pos").alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items")
    )


def proximity_hits(index: DataFrame, queries: DataFrame, width: int) -> DataFrame:
    """doc_id, th, query and start: spans of ``width`` words that hold every term of a query, in any order.

    ``queries`` has query and term. From each posting of a query's rarest term the spans
    around it are opened; the other terms' postings fill them.
    """
    terms = queries.select("query", "term").filter("term is not null").distinct()
    frequencies = index.groupBy("term").agg(F.count("*").alias("n"))
    known = terms.join(frequencies, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = known.groupBy("query").agg(F.min(F.struct("n", "term"))["term"].alias("rare"), F.count("*").alias("of"))
    anchors = index.join(small(rarest), F.col("term") == F.col("rare")).select(*KEY, "query", "of", F.col("pos").alias("at"))
    spans = anchors.select(
        F.col("doc_id").alias("d"), F.col("th").alias("h"), "query", "of",
        F.explode(F.sequence(F.greatest(F.col("at") - width + 1, F.lit(0)), F.col("at"))).alias("start"),
    ).distinct()
    asked = index.join(small(terms), "term").select(
        *KEY, "term", F.col("query").alias("asked"), F.explode(F.sequence(F.greatest(F.col("pos") - width + 1, F.lit(0)), F.col("pos"))).alias("s")
    )
    filled = spans.join(asked, F.expr("h = th AND query = asked AND start = s") & F.col("d").eqNullSafe(F.col("doc_id")))
    counted = filled.groupBy("doc_id", "th", "query", "start", "of").agg(F.countDistinct("term").alias("n"))
    return counted.filter("n = of").select(*KEY, "query", "start")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, th, n_words, n_hit, items and contaminated, one row for each row of ``docs``."""
    hits = phrase_hits(docs.select("doc_id", "text"), benchmark)
    counted = docs.select("doc_id", F.xxhash64("text").alias("th"), word_count(F.col("text")).alias("n_words"))
    hits = hits.withColumnRenamed("doc_id", "hit_doc").withColumnRenamed("th", "hit_th")
    joined = counted.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_doc")) & (F.col("th") == F.col("hit_th")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id",
        "th",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (PART * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the contaminated ones; their columns may have any names."""
    plain = plainly_named(docs, "doc_id", "text")
    bad = decontaminated(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias("_bad"), F.col("th").alias("_th"))
    bad = staged(bad.distinct(), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col("_bad")) & (F.xxhash64("text") == F.col("_th"))
    return plain.join(small(bad), same, "left_anti").toDF(*docs.columns)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


_SQL_WORDS = (
    f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), "
    "'[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+')"
)
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE len({_SQL_WORDS}) > 0),
bw AS (
    SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS k, array_to_string(w[s:s + least(len(w), {WINDOW}) - 1], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS s FROM b)
), lengths AS (SELECT DISTINCT k FROM bw),
dw AS (
    SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS win
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, lengths WHERE len(w) >= k)
), hits AS (SELECT doc_id, s, k, item_id FROM dw JOIN bw USING (k, win)),
words_hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY 1),
items AS (
    SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND {PART} * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
