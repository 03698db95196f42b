"""Hard negatives against all pairs by hand: clusters, ties, copies, odd vectors, huge numbers."""

import math
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orgloom.llm import negatives

LONG = (1 << 63) - 1
MOST = sys.float_info.max


def by_hand(rows, positives=5, keep=3, lowest=50, highest=95, scale=256):
    taken = [r for r in rows if r[0] is not None and r[1] is not None and r[2] and all(x is not None and math.isfinite(x) for x in r[2])]
    lengths = Counter(len(r[2]) for r in taken)
    usual = max(lengths, key=lambda n: (lengths[n], n), default=0)
    taken = [(i, label, [math.floor(max(-MOST, min(MOST, scale * x))) for x in v]) for i, label, v in taken if len(v) == usual]
    out = []
    for a, (anchor, label, q) in enumerate(taken):
        if anchor % 10:
            continue
        score = [max(-LONG - 1, min(LONG, sum(x * y for x, y in zip(q, r[2], strict=True)))) for r in taken]
        mine = sorted((-score[j], r[0], j) for j, r in enumerate(taken) if j != a and r[1] == label)[:positives]
        for minus, positive, _ in mine:
            p = -minus
            fits = sorted((-score[j], r[0], j) for j, r in enumerate(taken) if r[1] != label and lowest * p <= 100 * score[j] <= highest * p)
            out += [(anchor, positive, k, r, p, -s) for k, (s, r, _) in enumerate(fits[:keep], 1)]
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    made = negatives.mine(negatives.usable(df), F.col("vec_id") % 10 == 0, **options)
    return sorted(tuple(r) for r in made.collect())


def clusters(seed, n, d, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    at = rng.integers(0, 6, n)
    return rng, at, centres[at] + spread * rng.normal(size=(n, d))


@pytest.mark.parametrize(("spread", "d", "block"), [(0.1, 8, 512), (0.6, 8, 64), (3.0, 4, 32)])
def test_against_all_pairs(spark, monkeypatch, spread, d, block):
    monkeypatch.setattr(negatives, "LEAST_BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHORS", 16)
    rng, at, x = clusters(3, 900, d, spread)
    rows = [(i, int((a + (i % 11 == 0)) % 4), v.round(2).tolist()) for i, (a, v) in enumerate(zip(at, x, strict=True))]
    rows += rows[40:60] + [(r[0], 1, r[2]) for r in rows[100:120]]  # equal rows, and ids with another label
    rows += [(50, 2, x[3].tolist()), (2000, 1, [0.0] * d), (2010, 1, [1e-4] * d), (2020, 3, [-5.0] * d), (2030, 0, [700.0] * d)]
    odd = [(3000, None, x[0].tolist()), (None, 1, x[0].tolist()), (3010, 1, None), (3020, 1, []), (3030, 1, [None] * d)]
    odd += [(3040, 1, [float("nan")] * d), (3050, 1, [float("inf")] * d), (3060, 1, [1.0])]
    assert found(spark, rows + odd) == sorted(by_hand(rows + odd))


def test_other_numbers_of_rows(spark):
    _, at, x = clusters(5, 200, 6, 0.5)
    rows = [(i, int(a % 3), v.tolist()) for i, (a, v) in enumerate(zip(at, x, strict=True))]
    for options in ({"positives": 1, "negatives": 7}, {"lowest": -100, "highest": 100}, {"scale": 3}):
        hand = {{"negatives": "keep"}.get(k, k): v for k, v in options.items()}
        assert found(spark, rows, **options) == sorted(by_hand(rows, **hand))


def test_huge_components_are_scored_exactly(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 2, (rng.normal(size=3) * 10.0 ** rng.choice([0, 5, 8])).tolist()) for i in range(120)]
    rows += [(200, 0, [1e300, 1.0, 0.0]), (210, 1, [1e300, -1e300, 2.0]), (220, 0, [1.7e308] * 3), (230, 1, [3.0, 4e18, 1.0])]
    assert found(spark, rows) == sorted(by_hand(rows))


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, 1, [1.0, 0.0])]) == []
    assert found(spark, [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.9, 0.0])]) == [(0, 1, 1, 2, 65536, 58880)]
    # a positive of score 0 wants a score of exactly 0, one below 0 none
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.0, 1.0]), (2, 2, [0.0, -1.0]), (3, 1, [-1.0, 0.0]), (4, 2, [-0.5, 0.0])]
    assert found(spark, rows) == [(0, 1, 1, 2, 0, 0)]


def test_bounds_hold_every_score():
    rng = np.random.default_rng(2)
    for d, size in ((2, 1.0), (5, 30.0), (64, 1.0)):
        x = np.concatenate([rng.normal(size=(200, d)), 3 + 0.01 * rng.normal(size=(100, d)), np.zeros((3, d))]) * size
        q = negatives.integers(np.concatenate([x, -x[:20], 2 * x[:20]]), 256)
        of = negatives.directions(negatives.norms_and_units(q)[1], 4)
        norm, theta = negatives.angles(q, of)
        score = q @ q.T
        cell = theta.argmin(axis=1)
        names = np.unique(cell)
        spans = [(theta[cell == c], norm[cell == c]) for c in names]
        cells = negatives.Cells(
            names, np.array([t.min(0) for t, _ in spans]), np.array([t.max(0) for t, _ in spans]), np.array([n.min() for _, n in spans]), np.array([n.max() for _, n in spans])
        )
        low, high = cells.bounds(norm, theta)
        for k, c in enumerate(names):
            mine = score[:, cell == c]
            assert (low[:, k] <= mine.min(1)).all() and (mine.max(1) <= high[:, k]).all()


def test_cells_that_cannot_matter_are_left_out(spark):
    """Tight clusters: anchors go to fewer cells than there are, and the result stays whole."""
    rng = np.random.default_rng(4)
    centres = np.eye(6) * 4
    rows = [(i, i % 3, (centres[i % 6] + 0.05 * rng.normal(size=6)).tolist()) for i in range(600)]
    df = negatives.usable(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
    of = negatives.references(df, 256)
    known = negatives.stored(df, F.col("vec_id") % 10 == 0, of, 256)
    cells = negatives.spans(known, len(of))
    asked = known.filter("is_anchor").drop("is_anchor")
    windows = [F.array(F.lit(x).cast("long")).alias(c) for c, x in (("low", 500_000), ("high", 10**9))]
    sent = negatives.routed(asked.select("*", *windows), cells, elsewhere=False)
    assert asked.count() <= sent.count() <= 2 * asked.count() < len(cells.cell) * asked.count()
    assert found(spark, rows) == sorted(by_hand(rows))
