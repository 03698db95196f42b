"""Large groups of the Jaccard join whose members are alike in part: every link is found, few pairs are compared as texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import joined_by_hand

from orgloom.llm import jaccard


def variants(rng, n, words, most):
    """Copies of one text with shares of new words from none to ``most``."""
    base = [f"w{i}" for i in range(words)]
    return [" ".join(w if rng.random() > most * k / n else f"v{rng.randrange(10**6)}" for w in base) for k in range(n)]


def test_a_group_with_a_wide_fringe_compares_few_texts(spark, monkeypatch):
    rng = random.Random(11)
    rows = list(enumerate(variants(rng, 400, 400, 0.08)))
    compared, verified = [], jaccard.verified

    def counted(docs, pairs, *rest):
        compared.append(pairs.count())
        return verified(docs, pairs, *rest)

    monkeypatch.setattr(jaccard, "verified", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in jaccard.near_duplicates(docs, 5, 80).collect()]
    assert sorted(got) == sorted(joined_by_hand(rows, 5, 80))
    assert len({c for _, _, c in got}) > 50  # many stay alone
    assert sum(compared) < len(rows), compared


@pytest.mark.parametrize("block", [8_000, 40])
def test_pairs_across_components_are_those_that_may_link(spark, block):
    rng = np.random.default_rng(5)
    sets, rows = [], []
    for size in (1, 3, 50, 300, 1500, 1620, 2500, 3200, 6500):
        base = rng.integers(0, 2**63, size).astype(np.uint64)
        for share in (0.02, 0.05, 0.1, 0.12, 0.2, 0.5) * 5:
            out = int(share * size)
            sets.append(np.unique(np.concatenate([base[out:], rng.integers(0, 2**63, out // 2).astype(np.uint64)])))
    names = rng.integers(-(2**62), 2**62, len(sets)).tolist()
    buckets = [-(2**40), -3, 0, 5, 2**41, 2**42]
    asked = {s: [b for b in buckets if rng.random() < 0.3] for s in names}
    for k, (sid, x) in enumerate(zip(names, sets, strict=True)):
        outline = (sid, names[k - k % 3], len(x), jaccard.sketch_of(x), jaccard.wide_sketch_of(x), asked[sid])
        rows += [(b, b not in asked[sid], *outline) for b in buckets if b in asked[sid] or rng.random() < 0.7]
    schema = "bucket long, weak boolean, sid long, root long, n int, sketch array<long>, wide array<long>, first array<long>"
    made = spark.createDataFrame(rows, schema)
    counts = made.groupBy("bucket").agg(*jaccard.block_counts(block), F.count("*").alias("k"))
    assert counts.agg(F.max("k")).first()[0] >= jaccard.SHARED_ROWS
    assert (counts.agg(F.max("q_of")).first()[0] > 1) == (block < 100)
    got = [tuple(r) for r in jaccard.across(made.join(counts.drop("k"), "bucket"), 80).collect()]
    x, y = made.alias("x"), made.alias("y")
    both = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.sid") < F.col("y.sid")) & (F.col("x.root") != F.col("y.root"))
    pairs = x.join(y, both & (~F.col("x.weak") | ~F.col("y.weak")) & jaccard.may_link("x", "y", 80))
    want = {tuple(r) for r in pairs.select("x.sid", "y.sid", "x.root", "y.root").collect()}
    assert {r[:4] for r in got} == want and len(want) > 300
    sketch = {r[2]: r[5] for r in rows}
    for a, b, _, _, d in got:
        assert d == sum(((u ^ v) & (2**64 - 1)).bit_count() for u, v in zip(sketch[a], sketch[b], strict=True))
