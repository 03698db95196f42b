"""Sharding against the published loop, growth by one, slots without gaps and odd cases."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orgloom.llm import shards
from orgloom.session import work_dir


def number(key):
    return int(hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:16], 16)


def by_hand(n, buckets):
    b, j = -1, 0
    while j < buckets:
        b = j
        n = (n * shards.FACTOR + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((n >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 8, 100, 5000])
def test_shards_of_the_published_loop(spark, n):
    docs = spark.range(3000).select((F.col("id") * 7919 - 5000).alias("doc_id"))
    rows = shards.placed(docs, n).collect()
    assert all(r.shard == by_hand(number(r.doc_id), n) for r in rows)
    assert all(r.grown_shard == by_hand(number(r.doc_id), n + 1) for r in rows)
    assert all(r.grown_shard in (r.shard, n) for r in rows)
    if n == 8:
        counts = Counter(r.shard for r in rows)
        assert all(abs(counts[k] - 375) < 4 * 18.2 for k in range(8))  # four standard deviations


def test_slots_have_no_gaps(spark):
    rows = [(k, f"text {k}", "x", "mine", 1.5) for k in range(500)]
    rows += [(None, None, "x", None, None)] * 300 + [(7, "", None, "y", 0.0)] * 200 + [(7, "x" * 200_000, "x", "y", 0.0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, _place string, slot string, `a.b` double").repartition(5)
    path = work_dir(spark, "shards")
    made = shards.write_shards(docs, path, order=["text"])
    assert made.columns == ["doc_id", "text", "_place", "a.b", "shard", "grown_shard", "slot"]
    got = made.collect()
    assert Counter((r.doc_id, r.text, r["a.b"]) for r in got) == Counter((r[0], r[1], r[4]) for r in rows)
    for shard in range(8):
        mine = sorted((r.slot, r.doc_id is not None, r.doc_id or 0, r.text or "") for r in got if r.shard == shard)
        assert [x[0] for x in mine] == list(range(len(mine)))
        assert [x[1:] for x in mine] == sorted(x[1:] for x in mine)
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    # a key of many rows is several files
    hot = {r.shard for r in got if r.doc_id is None}.pop()
    stored = spark.read.parquet(path).filter(f"shard = {hot} and doc_id is null")
    assert stored.select(F.input_file_name()).distinct().count() > 1
    empty = shards.write_shards(docs.limit(0), work_dir(spark, "shards"))
    assert empty.collect() == [] and empty.columns[-1] == "slot"


def test_sizes_and_checksums(spark):
    texts = ["", None, "é日本𝔘", "x" * 300_000, "a\x00b"]
    got = shards.sizes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))


def test_main_path_has_no_python_worker(spark, sf_dir):
    plan = shards.op12_shards(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = shards.placed(shards.sizes(docs))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


def test_the_shards_hold_the_whole_documents(spark, sf_dir):
    made = shards.op12_shards(spark, sf_dir)
    places = {file.split("/shard=")[0] for file in made.inputFiles() if "/shard=" in file}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stored = spark.read.parquet(*places)
    assert set(docs.columns) <= set(stored.columns)
    kept = stored.select(*docs.columns)
    assert kept.exceptAll(docs).isEmpty() and docs.exceptAll(kept).isEmpty()
    assert Counter(r.shard for r in stored.collect()) == Counter(r.shard for r in made.collect())


def test_rows_of_one_key_are_ordered_by_checksum_and_size(spark, tmp_path):
    texts = ["b", "a", None, "", "cc", "b", "x" * 5000] * 3
    rows = [(k % 4 or None, text, k) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size int")  # a column named like an added one stays in the files
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = shards.op12_shards(spark, str(tmp_path)).collect()
    data = [(text or "").encode() for _, text, _ in rows]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((k, len(d) + 1, zlib.crc32(d)) for (k, _, _), d in zip(rows, data))
    for shard in {r.shard for r in got}:
        mine = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        keys = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size) for r in mine]
        assert keys == sorted(keys)
