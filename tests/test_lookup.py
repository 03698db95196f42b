import datetime

from pyspark.sql import functions as F

from orgloom.operators.lookup import hot_keys, latest_capture, lookup, spread_lookup


def captures(spark, rows):
    return spark.createDataFrame(rows, "requested_url string, final_url string, captured_at timestamp_ntz, n int")


def at(day):
    return datetime.datetime(2024, 5, day)


def test_newest_capture_wins(spark):
    df = captures(
        spark, [("a", "x", at(1), 1), ("a", "y", at(3), 2), ("a", "z", at(2), 3), ("b", "b", None, 4), (None, "n", at(9), 5)]
    )
    assert {(r.requested_url, r.n) for r in latest_capture(df).collect()} == {("a", 2), ("b", 4)}


def skewed(spark, n):
    """A third of the targets share one URL, half of those are equal rows."""
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0
    return ids.select(
        F.when(hot & (F.col("id") % 2 == 0), "same").otherwise(F.concat(F.lit("org"), "id")).alias("name"),
        F.when(hot, "https://hot").otherwise(F.concat(F.lit("https://h/"), F.col("id") % 50)).alias("target_url"),
    )


def test_hot_keys_are_few_and_counted(spark):
    found = hot_keys(skewed(spark, 3000), "target_url", rows_per_split=300)
    assert [r["_splits"] for r in found.collect()] == [4]


def test_no_hot_key_is_overlooked(spark):
    # many keys, each with a tiny share of the rows
    many = spark.range(60_000).select((F.col("id") % 3000).cast("string").alias("u"))
    assert hot_keys(many, "u", rows_per_split=10).filter("_splits = 2").count() == 3000


def test_spread_join_equals_the_plain_join(spark):
    targets = skewed(spark, 3000)
    pages = captures(
        spark, [("https://hot", "f", at(1), 0), *((f"https://h/{i}", "f", at(1), i) for i in range(0, 50, 2))]
    )
    plain = targets.join(pages, F.col("target_url") == F.col("requested_url"), "left")
    expected = sorted(plain.collect(), key=str)
    assert expected == sorted(lookup(targets, pages, rows_per_split=100).collect(), key=str)
    assert expected == sorted(lookup(targets, pages, rows_per_split=20).collect(), key=str)
    assert expected == sorted(lookup(targets, pages).collect(), key=str)


def rows_per_split(targets, hot):
    """How many rows of the hot URL each split of the join gets."""
    pages = targets.sparkSession.createDataFrame([("https://hot", 0)], "requested_url string, n int")
    spread = spread_lookup(targets, pages, "target_url", "requested_url", hot)
    parts = spread.filter("n = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
    return [r["count"] for r in parts]


def test_a_hot_url_is_shared_among_splits(spark):
    targets = skewed(spark, 30_000).filter("target_url = 'https://hot'")
    hot = hot_keys(targets, "target_url", 1000)
    assert [r["_splits"] for r in hot.collect()] == [10]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        counts = rows_per_split(targets, hot)
        same = targets.filter("name = 'same'")
        counts_of_equal_rows = rows_per_split(same, hot)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(counts) == 10_000 and len(counts) > 4
    # equal rows leave their input partitions for different splits
    assert sum(counts_of_equal_rows) == 5000 and len(counts_of_equal_rows) > 3


def test_without_a_hot_url_there_is_no_extra_work(spark):
    targets = skewed(spark, 30)
    pages = captures(spark, [("https://hot", "f", at(1), 0)])
    assert "_split" not in lookup(targets, pages)._jdf.queryExecution().analyzed().toString()
