"""Language profiles against a plain version: every n-gram by slicing, ranks and distances by loops."""

import random
from collections import Counter

import pytest

from orgloom.llm import language
from orgloom.llm.hashing import mix


def parts(text):
    """n-grams of one to five characters of the words in their blanks."""
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        padded = f" {word} "
        out.update(padded[i : i + k] for k in range(1, 6) for i in range(len(padded) - k + 1))
    del out[" "]
    return out


def number(gram):
    """The number that stands for an n-gram, worked out one character at a time."""
    points = [language.BLANK if c == " " else ord(c) for c in gram]
    short = 0
    for p in points[:3]:
        short = short << language.BITS | p
    if len(points) <= 3:
        return short
    one = lambda x: int(mix(language.np.array([x], language.np.uint64))[0])
    for p in points[3:]:
        short = one(short) ^ p
    return (one(short) | 1 << 63) - (1 << 64)


def hashed(gram):
    return int(mix(language.np.array([number(gram) % (1 << 64)], language.np.uint64))[0])


def profiles_by_hand(rows, size):
    sums = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            sums.setdefault(lang, Counter()).update(parts(text))
    return {
        lang: {g: place for place, g in enumerate(sorted(c, key=lambda g: (-c[g], number(g)))[:size])} for lang, c in sums.items() if c
    }


def predicted_by_hand(text, profiles, size):
    mine = parts(text)
    if not mine or not profiles:
        return "und", 0.0
    kept = sorted(mine, key=lambda g: (-mine[g], hashed(g)))[:size]
    best = None
    for lang in sorted(profiles):
        total = 0
        for g in kept:
            rank = sum(mine[o] > mine[g] for o in kept)  # equal counts share a rank
            total += abs(profiles[lang][g] - rank) if g in profiles[lang] else size
        if best is None or total < best[1]:
            best = lang, total
    return best[0], min(1.0, max(0.0, 1 - best[1] / (size * len(kept))))


@pytest.mark.parametrize("size", [300, 25])
def test_ranks_and_distances(spark, monkeypatch, size):
    monkeypatch.setattr(language, "PIECE", 200)
    rng = random.Random(2)
    words = {"aa": "the and then that this whale other".split(), "bb": "der und dass wälder anderen ß".split(), "cc": "и они леса 日本 другие".split()}
    rows = []
    for k in range(240):
        lang = rng.choice("aa bb cc".split())
        text = " ".join(rng.choices(words[lang] + words["aa"][:2], k=rng.randrange(1, 40)))
        rows.append((k, text, rng.choice([lang, lang, None])))
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 34", "cc"), (903, "x", None), (904, "thé whäle", None), (905, "ab " * 3000, "dd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    learned = language.learn(docs, size)
    want = profiles_by_hand([(t, lang) for _, t, lang in rows], size)
    got = {}
    for r in learned.collect():
        got.setdefault(r.lang, {})[r.gram] = r.place
    assert got == {lang: {number(g): p for g, p in of.items()} for lang, of in want.items()}
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, learned, size).collect()}
    for doc_id, text, _ in rows:
        lang, score = predicted_by_hand(text, want, size)
        assert found[doc_id][0] == lang and abs(found[doc_id][1] - score) < 1e-9, (doc_id, text)


def test_ties_go_to_the_language_that_sorts_first(spark):
    rows = [(1, "same text", "zz"), (2, "same text", "aa"), (3, "same text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language.identify(docs, language.learn(docs)).collect()} == {"aa"}


def test_long_n_grams_by_slicing():
    for text in ("a", "ab", "abc", "abcd", "abcde", "ab abcdef-ghi", "É b²c x_y" * 3, "𝔘nicode wörter", "x" * 50):
        names, n = language.counted(text, 5)
        want = Counter({number(g): c for g, c in parts(text).items()})
        assert dict(zip(names.tolist(), n.tolist(), strict=True)) == want, text
