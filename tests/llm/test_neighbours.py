"""Nearest neighbours against brute force: repeated ids, huge and tiny components, recall through several parts."""

import math

import numpy as np
import pytest

from orgloom.llm import neighbours


def found(spark, rows, every=10, **options):
    df = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    out = {}
    for r in neighbours.nearest(df, df.filter(f"vec_id % {every} = 0"), **options).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def cosine(a, b):
    a, b = ([math.ldexp(x, -math.frexp(max(map(abs, v)))[1]) for x in v] for v in (a, b))
    return math.fsum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(math.fsum(x * x for x in a)) / math.sqrt(math.fsum(y * y for y in b))


def by_hand(rows, every=10, k=5):
    out = {}
    for i, (q, a) in enumerate(rows):
        if q % every == 0:
            scored = sorted((-round(cosine(a, b), 12), v) for j, (v, b) in enumerate(rows) if j != i and (v, b) != (q, a))
            out.setdefault(q, []).extend((r, v, -s) for r, (s, v) in enumerate(scored[:k], 1))
    return {q: sorted(v) for q, v in out.items()}


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [(r, v) for r, v, _ in got[q]] == [(r, v) for r, v, _ in want[q]], q
        assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(got[q], want[q], strict=True))


def test_an_id_that_several_rows_have(spark):
    rows = [(0, [1.0, 0.0, 0.0])] + [(7, [1.0, 0.1 * i, 0.0]) for i in range(1, 6)] + [(9, [-1.0, 0.0, 0.1])]
    got = found(spark, rows)
    assert [v for _, v, _ in got[0]] == [7] * 5 and len({s for _, _, s in got[0]}) == 5
    same(got, by_hand(rows))
    twice = rows + [(0, [0.0, 0.0, 1.0])]  # two queries of one id
    same(found(spark, twice), by_hand(twice))
    copies = [(0, [1.0, 2.0])] * 3 + [(1, [1.0, 2.0])] * 3  # rows like the query are its own
    assert [v for _, v, _ in found(spark, copies)[0][::3]] == [1, 1, 1]


def test_components_beyond_the_range_of_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4))
    rows = [(i, (v * 10.0 ** p).tolist()) for i, (v, p) in enumerate(zip(x, rng.choice([-300, -200, 0, 200, 300], 60), strict=True))]
    rows += [(100, [1.7e308, 1.7e308, 0.0, 0.0]), (101, [5e-324, 0.0, 0.0, 0.0]), (110, [0.0, 0.0, 0.0, 1e-310])]
    got = found(spark, rows)
    assert all(math.isfinite(s) and abs(s) <= 1 + 1e-12 for v in got.values() for _, _, s in v)
    same(got, by_hand(rows))


@pytest.mark.parametrize(("n", "spread", "most"), [(600, 0.2, 0.8), (9000, 0.2, 0.5), (4000, 9.0, 1.0)])
def test_recall_through_parts(spark, n, spread, most):
    """Several parts also in small tables; clustered rows need few of them."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, n)] + spread * rng.normal(size=(n, 16))
    df = neighbours.usable(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"))
    router = neighbours.fit(df, n)
    assert router.probes == max(2, n // neighbours.ROWS_PER_PART)
    members = neighbours.routed(df, router, 1).cache()
    router, share = neighbours.probed(router, members, neighbours.RECALL, 5)
    parts = members.groupBy("part").count().collect()
    assert max(r["count"] for r in parts) < 2.5 * n / len(router.b2)
    assert share >= neighbours.RECALL and router.probes <= most * len(router.b2) + 1
    got = {q: {v for _, v, _ in best} for q, best in found(spark, [(i, v.tolist()) for i, v in enumerate(x)], 50).items()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in got:
        s = unit @ unit[q]
        s[q] = -9
        hits += len(got[q] & set(np.argsort(-s)[:5].tolist()))
    assert hits >= 0.9 * 5 * len(got) and len(got) == n // 50
