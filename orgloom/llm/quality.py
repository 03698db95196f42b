"""Quality classifier: supervised subword embeddings.

Every token stands for its own vector and those of its character n-grams, every two
adjacent tokens for one of their own, all taken by hash from one table of learned vectors;
a document is the mean of all of these, and a softmax layer over it gives the label.
Vectors and layer are trained by stochastic gradient descent in numpy on at most
``SAMPLE`` labelled rows, those whose id hashes lowest, with their whole texts. Scoring is
linear in the vectors, so each token's share of the outcome is worked out once and kept.

Two adjacent tokens that are the same also have a vector common to all such pairs, so
that runs of a repeated word are seen whatever the word is.

Defined results: a null or empty text has the end mark as its only feature and gets the
score that this alone has; without any labelled row, or with one label only, the vectors
stay untrained and the score is the share of label 1 (one half if there is none);
documents with several labels or a null label teach nothing by the null ones; an empty
table gives no rows. Columns named ``score`` and ``predicted`` are replaced by ``score``
and left alone by ``accepted``; all others pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.llm.common import fold, map_batches, others, table

SAMPLE = 3_000
BUCKETS = 1 << 16
WIDTH = 8
EPOCHS = 12
RATE = 0.5
BATCH = 32
SHORTEST, LONGEST = 3, 4
THRESHOLD = 0.3
SEED = 4
CACHE = 300_000
CACHED_LENGTH = 48

_MASK = BUCKETS - 1
_PAIR = np.uint64(0x9E3779B97F4A7C15)
END = crc32(b"\x00end") & _MASK
AGAIN = crc32(b"\x00again") & _MASK


def buckets(token: bytes) -> list[int]:
    """Places of the token and of its n-grams (of bytes, with < and > around)."""
    marked = b"<" + token + b">"
    n = len(marked)
    return [
        crc32(token) & _MASK,
        *[crc32(marked[i : i + k], k) & _MASK for k in range(SHORTEST, LONGEST + 1) for i in range(n - k + 1)],
    ]


def pairs(hashes: np.ndarray) -> np.ndarray:
    """Places of the pairs of adjacent tokens, from the tokens' hashes."""
    mixed = (hashes[:-1] * _PAIR) ^ hashes[1:]
    return ((mixed * _PAIR) >> np.uint64(24)).astype(np.int64) & _MASK


def document_features(text: str | None, cache: dict[bytes, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places of a document's features and their shares, which add up to 1."""
    tokens = text.encode().split() if text else []
    places = [END]
    for token in tokens:
        found = cache.get(token)
        if found is None:
            found = buckets(token)
            if len(token) <= CACHED_LENGTH and len(cache) < CACHE:
                cache[token] = found
        places += found
    repeats = sum(a == b for a, b in zip(tokens, tokens[1:], strict=False))
    counts = np.bincount(np.array(places, np.int64), minlength=BUCKETS)
    if len(tokens) > 1:
        counts += np.bincount(pairs(np.array([crc32(t) for t in tokens], np.uint64)), minlength=BUCKETS)
    counts[AGAIN] += repeats * 8  # a pair weighs about as much as a token with its n-grams
    ids = counts.nonzero()[0]
    return ids.astype(np.int32), (counts[ids] / counts.sum()).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """What scoring needs: each place's pull towards label 1."""

    pull: np.ndarray
    bias: float

    def scorer(self):
        table, pull, bias, cache = self.pull, self.pull.tolist(), self.bias, {}
        end, again = pull[END], pull[AGAIN]

        def score(text: str | None) -> float:
            tokens = text.encode().split() if text else []
            total, n, hashes = end, 1, []
            for token in tokens:
                found = cache.get(token)
                if found is None:
                    places = buckets(token)
                    found = (sum([pull[i] for i in places]), len(places), crc32(token))
                    if len(token) <= CACHED_LENGTH:
                        if len(cache) >= CACHE:
                            cache.clear()
                        cache[token] = found
                total += found[0]
                n += found[1]
                hashes.append(found[2])
            if len(hashes) > 1:
                total += float(table[pairs(np.array(hashes, np.uint64))].sum(dtype=np.float64))
                n += len(hashes) - 1
            repeats = 8 * sum(a == b for a, b in zip(tokens, tokens[1:], strict=False))
            x = bias + (total + again * repeats) / (n + repeats)
            return 1 / (1 + math.exp(-x)) if x > -700 else 0.0

        return score


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = SEED) -> Model:
    """Vectors and softmax layer from (places, shares, label) of the sample."""
    labels = np.array([y for _, _, y in rows], np.int64)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 0.5
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, 2), np.float32)
    bias = np.zeros(2, np.float32)
    steps = EPOCHS * math.ceil(len(rows) / BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            picked = order[start : start + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            ids = np.concatenate([rows[i][0] for i in picked])
            shares = np.concatenate([rows[i][1] for i in picked])[:, None]
            starts = np.cumsum([0, *[len(rows[i][0]) for i in picked[:-1]]])
            means = np.add.reduceat(vectors[ids] * shares, starts)
            logits = means @ layer + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(picked)), labels[picked]] -= 1  # the gradient at the logits
            pull = p @ layer.T
            sizes = np.diff([*starts, len(ids)])
            layer -= rate * means.T @ p / 4
            bias -= rate * p.sum(axis=0) / 32
            change = np.repeat(pull, sizes, axis=0) * shares
            for k in range(WIDTH):
                vectors[:, k] -= (4 * rate * np.bincount(ids, change[:, k], BUCKETS)).astype(np.float32)
    difference = layer[:, 1] - layer[:, 0]
    return Model((vectors @ difference).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from the labelled rows of ``docs``; at most ``sample`` of them, by hash of the id."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    picked = known.select("doc_id", F.col(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "y").limit(sample)

    def make():
        cache: dict[bytes, list[int]] = {}

        def run(batch: pa.RecordBatch) -> dict:
            found = [document_features(text, cache) for text in batch["text"].to_pylist()]
            return {
                "doc_id": batch["doc_id"],
                "y": batch["y"],
                "places": pa.array([x for x, _ in found], pa.list_(pa.int32())),
                "shares": pa.array([x for _, x in found], pa.list_(pa.float32())),
            }

        return run

    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most ``sample`` rows
    made = map_batches(rows, make, "doc_id long, y int, places array<int>, shares array<float>")
    got = made.orderBy("doc_id", "y").limit(sample).toArrow().combine_chunks()
    y = got["y"].to_pylist()
    pairs = zip(got["places"], got["shares"], y, strict=True)
    return train([(a.values.to_numpy(), b.values.to_numpy(), c) for a, b, c in pairs])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs with ``score`` and ``predicted`` instead of any columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passed = others(docs, ("score", "predicted"))
    kept, names = list(passed), list(passed.values())

    def make():
        of = shared.value.scorer()

        def run(batch: pa.RecordBatch) -> dict:
            found = [of(text) for text in batch["text"].to_pylist()]
            return {c: batch[c] for c in kept} | {"score": found, "predicted": [int(x >= threshold) for x in found]}

        return run

    schema = docs.select(*names, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    return map_batches(docs.select(*names), make, schema)


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        of = shared.value.scorer()

        def run(batch: pa.RecordBatch) -> dict | None:
            kept = batch.filter(pa.array([of(text) >= threshold for text in batch["text"].to_pylist()], pa.bool_()))
            return dict(zip(kept.schema.names, kept.columns, strict=True)) if kept.num_rows else None

        return run

    return map_batches(docs, make, docs.schema)


def op4_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learned(docs, spark, sf_dir)
    scored = score(docs.select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


def learned(docs: DataFrame, spark: SparkSession, sf_dir: str) -> Model:
    """The model from the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0)
    return fit(docs, labels)
