"""Personal data by weak supervision.

Base spans come from four fixed patterns and always stay. Looser candidates (numbers
that lack a country code, addresses written out in words, digit groups that miss a check)
are judged by labelers: pattern shapes, gazetteers of address ends and number prefixes,
and cue words in the context. Each labeler says yes, no or nothing.

1. One pass over all texts takes base spans and candidates and counts how often each combination of votes and each
   combination of span features occurs. Both are combinations of a few small values, so
   the counts stay small however large the corpus is.
2. Expectation-maximisation over the vote counts estimates every labeler's reliability
   and the probability of each vote combination; no text is needed for it.
3. A logistic span classifier is trained on the feature counts with these probabilities.
4. A second pass returns the base spans and the candidates that the classifier accepts
   and that overlap no base span.

Positions are code points, ends exclusive. Defined results: a null or empty text has no
spans; equal texts have equal spans; without candidates nothing is learned and base
spans alone are returned; ``find`` returns the id and the spans; ``redacted`` passes all
columns on, ``text`` and ``n_chars`` changed where a span was; an empty table gives no rows.

The scanners walk each text once: every alternative is anchored where its run of
characters begins, so that a very long run costs time in proportion to its length.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.llm.common import map_batches, table

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9

Span = tuple[int, int, str]

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]++(?=@)")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def digits_of(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ outwards."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            start = at
            while start > done and (text[start - 1] in _LOCAL_CHARS):
                start -= 1
            if start < at:
                done = domain.end()
                out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def small(part: str) -> bool:
    """Whether a run of digits is at most 255, leading zeros or not."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns, by start and then kind."""
    found: list[Span] = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(map(small, m.groups())):
            found.append((m.start(), m.end(), "ip"))
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 14:
            digits = digits_of(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(digits_of(m.group())) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# Candidates beyond the patterns: fixed shapes, each bounded in length.
_LOOSE = {
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?: ?[\[(] ?at ?[\])] ?| at )[A-Za-z0-9-]{1,63}"
        r"(?:(?: ?[\[(] ?dot ?[\])] ?| dot |\.)[A-Za-z0-9-]{2,63}){1,4}(?![A-Za-z0-9])",
        re.IGNORECASE,
    ),
    "phone": re.compile(r"(?<![0-9A-Za-z+.])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"),
    "card": re.compile(
        r"(?<![0-9A-Za-z])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{2,4}|[0-9]{15,16})(?![0-9A-Za-z])"
    ),
}
#: What must occur in a text for a candidate to be possible at all; spares the scan.
_NEEDED = {"email": re.compile(r"\bat\b[\])]? ?[A-Za-z0-9-]+(?:\.| ?[\[(]? ?dot)", re.IGNORECASE)}

# The gazetteers and the cue words.
TOP_DOMAINS = frozenset(
    "com org net edu gov mil int info biz name pro io co me tv app dev ai xyz online site shop eu us uk ca au nz ie de at ch fr be nl "
    "lu es pt it gr se no dk fi is pl cz sk hu ro bg hr si ee lv lt ua ru tr il za in cn jp kr tw hk sg br mx ar cl".split()
)
#: First and last prefix of the numbers that card networks issue, and the lengths of these numbers.
CARD_ISSUERS = (
    (300, 305, (14,)), (3528, 3589, (16,)), (34, 34, (15,)), (36, 36, (14,)), (37, 38, (14, 15)), (4, 4, (13, 16, 19)), (50, 50, (16, 19)),
    (51, 55, (16,)), (56, 58, (16, 19)), (60, 60, (16,)), (62, 62, (16, 17, 18, 19)), (644, 659, (16,)), (2221, 2720, (16,)),
)
CUES = {
    "email": frozenset(
        "email e-mail emails mail mailto contact contacts write reach address inbox courriel correo kontakt contacto adresse schreiben écrire".split()
    ),
    "phone": frozenset(
        "phone phones tel telephone call calls dial ring mobile fax cell text sms whatsapp hotline number telefon handy anrufen rufen "
        "téléphone portable appelez appeler teléfono móvil llamar llame".split()
    ),
    "ip": frozenset("ip ipv4 address addresses host server gateway router dns ping adresse dirección".split()),
    "card": frozenset(
        "card cards credit debit visa mastercard amex discover payment pay billing charge carte karte kreditkarte tarjeta crédito".split()
    ),
}
DENIALS = frozenset(
    "order orders invoice isbn issn serial version build id ids no nr ref reference page pages item items sku part parts tracking ticket case "
    "account chapter figure table bestellung rechnung commande facture pedido factura".split()
)
_BEFORE = re.compile(r"[^\W\d_][\w-]*")


def votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """What the labelers say: 1 yes, -1 no, 0 nothing.

    Shape, gazetteer, cue before, denial before, surroundings, cue behind, variety of the
    digits, and whether an address or a number with a country code stands near.
    """
    span = text[start:end]
    digits = digits_of(span)
    words = [w.lower() for w in _BEFORE.findall(text[max(0, start - 40) : start])][-3:]
    if kind == "email":
        shape = 1 if "[" in span or "(" in span else -1 if span.count(" ") < 2 else 0
        last = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        listed = 1 if last in TOP_DOMAINS else -1
        if "@" in span:
            shape = 1
    elif kind == "phone":
        shape = 1 if span[0] in "(+" or span.count("-") == 2 else 0
        listed = 1 if dialled(digits[-10:]) else -1
    elif kind == "ip":
        shape = 1
        listed = -1 if digits[0] == "0" else 1
    else:
        shape = 1 if luhn(digits) else -1
        listed = 1 if issued(digits) else -1
    cue = 1 if any(w in CUES[kind] for w in words) else 0
    denial = -1 if any(w in DENIALS for w in words) else 0
    near = text[max(0, start - 2) : start] + text[end : end + 2]
    surroundings = -1 if any(c.isdigit() or c in "$%#=/" for c in near) else 0
    behind = [w.lower() for w in _BEFORE.findall(text[end : end + 30])][:2]
    follows = 1 if any(w in CUES[kind] for w in behind) else 0
    varied = 0 if kind in ("email", "ip") else -1 if len(set(digits)) < 3 else 1 if len(set(digits)) > 4 else 0
    beside = text[max(0, start - 80) : start] + " " + text[end : end + 80]
    company = 1 if _DOMAIN.search(beside) or _PHONE.search(beside) else 0
    return shape, listed, cue, denial, surroundings, follows, varied, company


def dialled(local: str) -> bool:
    """Whether ten digits may be an area code, an exchange and a line of the North American plan."""
    return len(local) == 10 and local[0] > "1" and local[1] < "9" and local[3] > "1" and "11" not in (local[1:3], local[4:6])


def issued(digits: str) -> bool:
    """Whether some card network issues numbers of this beginning and length."""
    return any(len(digits) in sizes and low <= int(digits[: len(str(low))]) <= high for low, high, sizes in CARD_ISSUERS)


def features(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """Small numbers that describe a span and what stands around it."""
    span = text[start:end]
    digits = digits_of(span)
    words = [w.lower() for w in _BEFORE.findall(text[max(0, start - 40) : start])][-3:]
    return (
        KINDS.index(kind),
        min(len(digits), 19),
        min(span.count(" "), 4),
        min(span.count("-"), 3),
        int("(" in span or "[" in span) + 2 * int(span[0] == "+" or "@" in span),
        int(digits[:1] in ("0", "1")),
        int(kind == "card" and luhn(digits)),
        int(any(w in CUES[kind] for w in words)),
        int(any(w in DENIALS for w in words)),
        int(end < len(text) and text[end] in ".,;\n "),
    )


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Loose spans, by start, that overlap no base span and no earlier one."""
    found = []
    for kind, pattern in _LOOSE.items():
        if kind not in _NEEDED or _NEEDED[kind].search(text):
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    if not found:
        return []
    starts, reach = [s[0] for s in base], np.maximum.accumulate([s[1] for s in base]).tolist() if base else []
    out, done = [], 0
    for start, end, kind in sorted(found, key=lambda s: (s[0], -s[1], s[2])):
        before = bisect_left(starts, end)
        if start >= done and not (before and reach[before - 1] > start):
            out.append((start, end, kind))
            done = end
    return out


def pattern_counts(docs: DataFrame) -> DataFrame:
    """kind, votes, features and n: how often each combination occurs in the whole corpus."""

    def make():
        def run(batch: pa.RecordBatch) -> dict | None:
            seen: Counter = Counter()
            for text in batch["text"].to_pylist():
                if text:
                    base = base_spans(text)
                    for start, end, kind in base + candidates(text, base):
                        seen[kind, votes(kind, text, start, end), features(kind, text, start, end)] += 1
            if not seen:
                return None
            return {
                "kind": [k for k, _, _ in seen],
                "votes": [list(v) for _, v, _ in seen],
                "features": [list(f) for _, _, f in seen],
                "n": list(seen.values()),
            }

        return run

    made = map_batches(docs.select("text"), make, "kind string, votes array<int>, features array<int>, n long")
    return made.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n"))


def reliabilities(votes: np.ndarray, n: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Probability of yes for each vote combination, by expectation-maximisation.

    Labelers are taken as independent given the truth, each with a probability of every
    answer for true and for false spans; a weak prior holds them better than chance.
    """
    said = np.stack([votes == -1, votes == 0, votes == 1], axis=2).astype(float)
    start = votes.sum(axis=1)
    p = 1 / (1 + np.exp(-start.astype(float)))
    prior = {True: np.array([0.5, 2.0, 2.5]), False: np.array([2.5, 2.0, 0.5])}
    for _ in range(rounds):
        logs = []
        for truth in (True, False):
            w = n * (p if truth else 1 - p)
            table = np.einsum("i,ijk->jk", w, said) + prior[truth]
            table /= table.sum(axis=1, keepdims=True)
            logs.append(np.log((w.sum() + 1) / (n.sum() + 2)) + np.einsum("ijk,jk->i", said, np.log(table)))
        p = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
    return p


class SpanClassifier:
    """Logistic regression over one-of-many coded features."""

    def __init__(self, weights: dict[tuple[int, int], float], bias: float):
        self.weights, self.bias = weights, bias

    def probability(self, values: tuple[int, ...]) -> float:
        x = self.bias + sum(self.weights.get((i, v), 0.0) for i, v in enumerate(values))
        return float(1 / (1 + np.exp(-np.clip(x, -50, 50))))

    @staticmethod
    def trained(rows: list[tuple[tuple[int, ...], float, float]], rounds: int = 300) -> SpanClassifier:
        """From (features, probability of yes, count)."""
        if not rows:
            return SpanClassifier({}, -50.0)
        places: dict[tuple[int, int], int] = {}
        for values, _, _ in rows:
            for pair in enumerate(values):
                places.setdefault(pair, len(places))
        x = np.zeros((len(rows), len(places) + 1))
        x[:, -1] = 1
        for i, (values, _, _) in enumerate(rows):
            for pair in enumerate(values):
                x[i, places[pair]] = 1
        y, n = np.array([p for _, p, _ in rows]), np.array([float(c) for _, _, c in rows])
        n = n / n.sum()
        w = np.zeros(x.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
            w -= 4.0 * (x.T @ (n * (p - y)) + 1e-4 * w)
        return SpanClassifier({pair: float(w[k]) for pair, k in places.items()}, float(w[-1]))


def fit(docs: DataFrame) -> SpanClassifier:
    """The span classifier learned from all texts of ``docs``."""
    rows = pattern_counts(docs).orderBy("kind", "votes", "features").collect()  # combinations of small values
    posterior: dict[tuple, float] = {}
    for kind in KINDS:
        by_vote: Counter = Counter()
        for r in rows:
            if r.kind == kind:
                by_vote[tuple(r.votes)] += r.n
        combos = sorted(by_vote)
        if not combos:
            continue
        p = reliabilities(np.array(combos), np.array([by_vote[c] for c in combos], float))
        posterior |= {(kind, c): float(x) for c, x in zip(combos, p, strict=True)}
    return SpanClassifier.trained([(tuple(r.features), posterior[r.kind, tuple(r.votes)], r.n) for r in rows])


def spans_of(text: str | None, model: SpanClassifier) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, of one text."""
    if not text:
        return [], []
    base = base_spans(text)
    more = [s for s in candidates(text, base) if model.probability(features(s[2], text, s[0], s[1])) >= ACCEPT]
    return base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]), s[1])) if more else base


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with a mark in place of each span; of spans that overlap, one mark covers all."""
    if not spans:
        return text
    out, done, reach = [], 0, -1
    for start, end, kind in spans:
        if start < reach:
            reach = max(reach, end)
            done = reach
            continue
        out.append(text[done:start])
        out.append(f"[{kind.upper()}]")
        done = reach = end
    out.append(text[done:])
    return "".join(out)


def find(docs: DataFrame, model: SpanClassifier) -> DataFrame:
    """doc_id with ``base`` and ``spans``: arrays of (start, end, kind)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            found = [spans_of(text, shared.value) for text in batch["text"].to_pylist()]
            rows = [[[{"start": s, "end": e, "kind": k} for s, e, k in side] for side in pair] for pair in found]
            return {"doc_id": batch["doc_id"], "base": [a for a, _ in rows], "spans": [b for _, b in rows]}

        return run

    span = "array<struct<start:int,end:int,kind:string>>"
    return map_batches(docs.select("doc_id", "text"), make, f"doc_id long, base {span}, spans {span}")


def redacted(docs: DataFrame, model: SpanClassifier) -> DataFrame:
    """docs with the spans in ``text`` replaced by marks and ``n_chars``, if there, set anew; no row goes."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            old = batch["text"].to_pylist()
            new = [redact(text, spans_of(text, shared.value)[1]) for text in old]
            out = {c: batch[c] for c in names} | {"text": new}
            if "n_chars" in names:
                was = batch["n_chars"].to_pylist()
                out["n_chars"] = [n if a == b else len(b) for a, b, n in zip(old, new, was, strict=True)]
            return out

        return run

    return map_batches(docs, make, docs.schema)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, fit(docs))

    def joined(column: str):
        return F.array_join(
            F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def digest(spans: list[Span]) -> str:
    """What the query returns as base_sha256, for a list of spans."""
    return hashlib.sha256(written(spans).encode()).hexdigest()
