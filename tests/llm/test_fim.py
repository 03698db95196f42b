"""The fill-in-middle transformation against a plain loop, round trips and odd cases."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orgloom.llm import fim


def by_hand(doc_id, text, seed=fim.SEED, rate=fim.RATE, suffix_first=fim.SUFFIX_FIRST):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    spm = h[3] % 100 < suffix_first
    output = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, "spm" if spm else "psm", len(p), len(m), output


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    signs = ["a", "bc", " ", "\n", "\t\x0b", "é", "日本", " ", "<", "P>", "<S", "M", "𝔘", "\x00", "\\0", "\x1f"]
    made = [(k, "".join(rng.choices(signs, k=rng.randrange(40)))) for k in range(600)]
    odd = [None, "", " ", "\n \n", "x", "<P>", "a <M> b", "<S", "word " * 40_000, "x" * 300_000, " " * 100_000]
    made += [(1000 + 20 * i + k, t) for i, t in enumerate(odd) for k in range(20)]
    return made + [(None, "one two three"), (None, "one two three"), (None, None), (7, "a b c"), (7, "a b c"), (-5, "a b")]


@pytest.mark.parametrize(("rate", "suffix_first"), [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_against_a_plain_loop(spark, rows, rate, suffix_first):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = fim.transformed(docs, rate=rate, suffix_first=suffix_first)
    again = fim.restored(F.col("output"), F.col("form")).alias("again")
    got = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", again).collect()
    want = [by_hand(*r, rate=rate, suffix_first=suffix_first) for r in rows]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert sorted((str(r.doc_id), r.again) for r in got) == sorted((str(i), t or "") for i, t in rows)


def test_slices_hold_every_text_once():
    text = pa.array([b"a" * n for n in (0, 5, 3, 0, 100, 1, 0, 0, 9)])
    for most in (1, 5, 8, 1000):
        got = list(fim.slices(text, most))
        assert [i for begin, n in got for i in range(begin, begin + n)] == list(range(9))
    assert list(fim.slices(text[:0])) == []


def test_columns_of_any_name_pass(spark):
    docs = spark.createDataFrame([(1, "a b", "mine", 2.5, "x", [1])], "doc_id int, text string, form string, `a.b` double, row string, two array<int>")
    made = fim.transformed(docs, rate=100)
    assert made.columns == ["doc_id", "text", "a.b", "row", "two", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert made.first()["a.b"] == 2.5 and made.first()["row"] == "x" and made.first()["form"] in ("psm", "spm")
    assert fim.transformed(docs.limit(0)).collect() == []


def test_draws_do_not_depend_on_the_layout(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = (sorted(fim.transformed(docs.repartition(k)).select("doc_id", "output").collect(), key=str) for k in (1, 7))
    assert one == many
