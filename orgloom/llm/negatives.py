"""Hard negatives by angular triangle filtering.

Every row keeps its angles to a few reference directions. By the triangle inequality on the
sphere, the angle of two rows is at least the difference of their angles to any reference,
and at most their sum (or what that leaves of the circle). The cosine so lies in an
interval, and times both norms this bounds the score from both sides; the bounds are widened by
more than rounding can cost. A pair is scored in integers only if its bounds meet the
window in which a score can still count; where most of a tile of pairs does, the tile is
multiplied whole. Products are made in doubles, which hold these integers exactly, and
in Python's integers where a norm is too large for that.

Rows belong to the cell of their nearest reference. What a cell's angles and norms span bounds
the scores of an anchor with all its rows, so anchors are sent only to cells that can
matter: first to their own, where five positives give a lowest score that counts, then
to the others; at last, with the windows below their positives known, to the cells that may hold
negatives. Rows and anchors of a cell meet in blocks: no task holds more than one block of
anchors, and rows stream by. Within a block the windows close as better rows are found.

The references come from a bounded sample (``SAMPLE`` rows by hash of the id); they
decide the cost, never the result. Only they and one line for each cell reach the driver.
On vectors that point everywhere alike in many dimensions the bounds rule out little,
and the search costs as much as scoring all anchors against all rows.

Defined results: rows with a missing id or label, a missing or empty vector, a missing or non-finite
component, or another length than most rows take no part (of two equally common lengths,
the longer counts). Rows are told apart by place: equal rows are all there, a copy of an
anchor is one of its rows, and an id that several rows have gives the results of each.
An anchor without positives, and a positive without negatives, give no row. A score beyond the
range of a long counts as that range's end; a component beyond that of a double, once
scaled, as that one's. An empty table gives none. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgloom.llm.common import arrow_schema, as_batches, map_batches, n_partitions, small, staged, table
from orgloom.llm.neighbours import matrix

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: Hundredths of the positive's score between which a negative's lies.
LOWEST, HIGHEST = 50, 95
SAMPLE, REFERENCES = 2_000, 8
#: Most rows and anchors in a block, fewest rows, rows scored at a time.
BLOCK, ANCHORS, LEAST_BLOCK, TILE = 4_096, 4_096, 512, 512
#: More than angles and cosines can be wrong by.
SLACK = 1e-6
#: Integers up to here are exact as doubles, whatever the order of a sum.
EXACT = float(1 << 52)
LONG = np.iinfo(np.int64)


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, label and v of the rows that take part, all of one length."""
    kind = rows.schema[vector].dataType
    known = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    v = F.col(vector) if known else F.col(vector).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    taken = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), v.alias("v"))
    taken = taken.filter("vec_id is not null and label is not null and size(v) > 0").filter(fine)
    lengths = taken.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return taken.filter(F.size("v") == (usual["length"] if usual else 0))


def integers(v: np.ndarray, scale: int) -> np.ndarray:
    """Whole numbers, as doubles, that stand for components."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(scale * v.astype(np.float64)))


def norms_and_units(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, which may be infinite, and unit vectors; zero vectors stay zero."""
    top = np.abs(q).max(axis=1, keepdims=True)
    scaled = q / np.where(top > 0, top, 1)
    length = np.linalg.norm(scaled, axis=1, keepdims=True)
    with np.errstate(over="ignore"):
        return (length * top)[:, 0], scaled / np.where(length > 0, length, 1)


def directions(units: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` of the unit vectors, each as far as can be from those before it."""
    chosen = [0]
    near = units @ units[0]
    while len(chosen) < min(count, len(units)):
        far = int(near.argmin())
        if near[far] > 1 - 1e-9:
            break
        chosen.append(far)
        near = np.maximum(near, units @ units[far])
    return units[chosen]


def references(rows: DataFrame, scale: int, sample: int = SAMPLE, count: int = REFERENCES) -> np.ndarray:
    """Reference directions, one a row, from at most ``sample`` rows; none for an empty table."""
    got = rows.orderBy(F.xxhash64("vec_id"), "vec_id", F.xxhash64("v")).limit(sample).select("v").toArrow()["v"].combine_chunks()
    if not len(got):
        return np.zeros((0, 0))
    return directions(norms_and_units(integers(matrix(got), scale))[1], count)


def angles(q: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms and angles to the references."""
    norm, unit = norms_and_units(q)
    return norm, np.arccos(np.clip(unit @ of.T, -1, 1))


def stored(rows: DataFrame, is_anchor: Column, of: np.ndarray, scale: int) -> DataFrame:
    """uid, vec_id, label, is_anchor, v, cell, norm and angles of each row, written once."""
    numbered = rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), "v")
    schema = T.StructType([*numbered.schema, *T._parse_datatype_string("cell int, norm double, angles array<double>")])
    names = numbered.columns

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            norm, theta = angles(integers(matrix(batch["v"]), scale), of)
            return {c: batch[c] for c in names} | {
                "cell": theta.argmin(axis=1).astype(np.int32),
                "norm": norm,
                "angles": lists(theta),
            }

        return run

    return staged(map_batches(numbered, make, schema), "vectors")


def lists(x: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as lists."""
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, max(1, x.shape[1]), dtype=np.int32)[: len(x) + 1], pa.array(x.ravel()))


@dataclass(frozen=True)
class Cells:
    """What the rows of each cell span."""

    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def bounds(self, norm: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the scores of rows with all rows of each cell."""
        a = theta[:, None, :]
        apart = np.maximum(0, np.maximum(self.low - a, a - self.high)).max(axis=2)
        # The largest value of least(sum, what the sum leaves of the circle) over the cell's angles.
        high = a + self.high
        turned = 2 * np.pi - (a + self.low)
        widest = np.where(high <= np.pi, high, np.where(turned <= np.pi, turned, np.pi)).min(axis=2)
        return score_bounds(np.cos(widest), np.cos(apart), norm, self.least, self.most)


def score_bounds(low: np.ndarray, high: np.ndarray, norm: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of scores from bounds of cosines; norms of the other side are between ``least`` and ``most``."""
    with np.errstate(over="ignore", invalid="ignore"):
        small_, large = np.multiply.outer(norm, least), np.multiply.outer(norm, most)
        low, high = np.clip(low - SLACK, -1, 1), np.clip(high + SLACK, -1, 1)
        below = np.where(low < 0, large, small_) * low
        above = np.where(high > 0, large, small_) * high
        rounding = 1 + large * 1e-12
        known = np.isfinite(large)
        # a score ends with the range of a long, and so do its bounds
        return np.where(known, np.minimum(below - rounding, LONG.max), -np.inf), np.where(known, np.maximum(above + rounding, LONG.min), np.inf)


def spans(rows: DataFrame, count: int) -> Cells:
    """One line for each cell."""
    theta = [F.col("angles")[i] for i in range(count)]
    made = rows.groupBy("cell").agg(
        F.array(*map(F.min, theta)).alias("low"), F.array(*map(F.max, theta)).alias("high"), F.min("norm").alias("least"), F.max("norm").alias("most")
    )
    lines = sorted(made.collect())  # one for each reference at most
    columns = zip(*lines, strict=True) if lines else ([], np.zeros((0, count)), np.zeros((0, count)), [], [])
    return Cells(*map(np.array, columns))


def routed(asked: DataFrame, cells: Cells, elsewhere: bool) -> DataFrame:
    """Anchors (with windows low, high), once for each cell whose bounds meet a window; ``elsewhere``: but their own."""
    shared = asked.sparkSession.sparkContext.broadcast(cells)
    names = asked.columns

    def make():
        of = shared.value

        def run(batch: pa.RecordBatch) -> dict | None:
            below, above = of.bounds(batch["norm"].to_numpy(), matrix(batch["angles"]))
            low, high = matrix(batch["low"]), matrix(batch["high"])
            meets = ((above[:, :, None] >= low[:, None, :]) & (below[:, :, None] <= high[:, None, :])).any(axis=2)
            if elsewhere:
                meets &= batch["cell"].to_numpy()[:, None] != of.cell[None, :]
            row, cell = np.nonzero(meets)
            taken = pa.array(row)
            return {c: batch[c].take(taken) for c in names} | {"cell": pa.array(of.cell[cell].astype(np.int32))}

        return run

    return map_batches(asked, make, asked.schema)


class Block:
    """The best rows so far of a block of anchors, for each of their windows."""

    def __init__(self, batch: dict[str, np.ndarray], same: bool, keep: int, scale: int):
        self.uid, self.label, self.norm = batch["uid"], batch["label"], batch["norm"]
        self.q = integers(batch["v"], scale)
        self.cos, self.sin = np.cos(batch["angles"]), np.sin(batch["angles"])
        self.low, self.high = batch["low"].astype(np.int64), batch["high"].astype(np.int64)
        self.same, self.keep, self.scale = same, keep, scale
        #: anchor, score, vec_id and uid of the rows kept, by window
        self.best = [tuple(np.zeros(0, np.int64) for _ in range(4)) for _ in range(self.low.shape[1])]
        self.least = self.low.copy()  # the lowest score that still counts

    def add(self, batch: dict[str, np.ndarray]) -> None:
        for start in range(0, len(batch["uid"]), TILE):
            self._tile({c: x[start : start + TILE] for c, x in batch.items()})

    def _tile(self, rows: dict[str, np.ndarray]) -> None:
        cos, sin = np.cos(rows["angles"]), np.sin(rows["angles"])
        shape = len(self.uid), len(rows["uid"])
        low, high = np.full(shape, -1.0), np.full(shape, 1.0)
        for i in range(cos.shape[1]):
            near, far = np.multiply.outer(self.cos[:, i], cos[:, i]), np.multiply.outer(self.sin[:, i], sin[:, i])
            np.minimum(high, near + far, out=high)
            np.maximum(low, near - far, out=low)
        with np.errstate(over="ignore", invalid="ignore"):
            product = np.multiply.outer(self.norm, rows["norm"])
            rounding = 1 + product * 1e-12
            above = np.maximum((high + SLACK) * product + rounding, LONG.min)
            below = np.minimum((low - SLACK) * product - rounding, LONG.max)
        unknown = ~np.isfinite(product)
        likely = (self.label[:, None] == rows["label"][None, :]) == self.same
        likely &= self.uid[:, None] != rows["uid"][None, :]
        meets = np.zeros(shape, bool)
        for w in range(self.low.shape[1]):
            meets |= (above >= self.least[:, w, None]) & (below <= self.high[:, w, None]) & (self.low[:, w] <= self.high[:, w])[:, None]
        likely &= meets | unknown
        if not likely.any():
            return
        anchor, row = np.nonzero(likely)
        score = self._scores(anchor, row, integers(rows["v"], self.scale), rows["norm"])
        for w in range(self.low.shape[1]):
            self._keep(w, anchor, score, rows["vec_id"][row], rows["uid"][row])

    def _scores(self, anchor: np.ndarray, row: np.ndarray, q: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Inner products of integers, within the range of a long."""
        if float(self.norm.max()) * float(norm.max()) < EXACT:
            if 4 * len(anchor) > len(self.q) * len(q):
                return (self.q @ q.T)[anchor, row].astype(np.int64)
            return np.einsum("ij,ij->i", self.q[anchor], q[row]).astype(np.int64)
        mine, theirs = ([list(map(int, x)) for x in y.tolist()] for y in (self.q, q))
        sums = (sum(a * b for a, b in zip(mine[i], theirs[j], strict=True)) for i, j in zip(anchor.tolist(), row.tolist(), strict=True))
        return np.array([min(max(s, LONG.min), LONG.max) for s in sums], np.int64)

    def _keep(self, w: int, anchor: np.ndarray, score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray) -> None:
        fits = (score >= self.least[anchor, w]) & (score <= self.high[anchor, w])
        if not fits.any():
            return
        new = (x[fits] for x in (anchor, score, vec_id, uid))
        anchor, score, vec_id, uid = (np.concatenate(x) for x in zip(self.best[w], new, strict=True))
        order = np.lexsort((uid, vec_id, ~score, anchor))  # ~score falls as the score rises
        first = np.searchsorted(anchor[order], anchor[order])
        order = order[np.arange(len(order)) - first < self.keep]
        self.best[w] = tuple(x[order] for x in (anchor, score, vec_id, uid))
        held = np.bincount(anchor[order], minlength=len(self.uid))
        full = np.flatnonzero(held == self.keep)
        ends = np.cumsum(held)[full] - 1
        self.least[full, w] = np.maximum(self.least[full, w], self.best[w][1][ends])

    def rows(self) -> dict:
        parts = [(self.uid[a], np.full(len(a), w, np.int32), s, v, u) for w, (a, s, v, u) in enumerate(self.best)]
        columns = map(np.concatenate, zip(*parts, strict=True))
        return dict(zip(("anchor", "window", "score", "vec_id", "uid"), map(pa.array, columns), strict=True))


def met(asked: DataFrame, rows: DataFrame, by: list[str], same: bool, keep: int, scale: int, block: int) -> DataFrame:
    """anchor (uid), window, score, vec_id, uid: up to ``keep`` rows for each anchor's windows and block.

    Anchors and rows of equal ``by`` meet, each block of the ones with each of the others.
    """
    counts = rows.groupBy(*by).agg(F.ceil(F.count("*") / block).cast("int").alias("nb")).join(
        asked.groupBy(*by).agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("qb")), by
    )
    counts = small(staged(counts, "blocks"))
    columns = [c for c in ("uid", "vec_id", "label", "norm", "angles", "v", "low", "high") if c not in by]

    def shared_out(df: DataFrame, own: str, other: str, role: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("uid"), F.col(own)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        made = df.join(counts, by).select(*by, mine, every, F.lit(role).alias("role"), *columns)
        return made.select(*by, "nb", "qb", "role", *columns)

    none = [F.lit(None).cast("array<long>").alias(c) for c in ("low", "high")]
    both = shared_out(asked, "qb", "nb", 0).unionByName(shared_out(rows.select("*", *none), "nb", "qb", 1))
    schema = T.StructType.fromDDL("anchor long, window int, score long, vec_id long, uid long")
    arrow = arrow_schema(schema)
    keys = [*by, "nb", "qb"]

    def arrays(piece: pa.RecordBatch, windows: bool) -> dict[str, np.ndarray]:
        out = {c: piece[c].to_numpy() for c in ("uid", "vec_id", "label", "norm")}
        wide = ("angles", "v", "low", "high") if windows else ("angles", "v")
        return out | {c: matrix(piece[c]) for c in wide}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, best = None, [], None
        for batch in batches:
            marks = [batch[c].to_numpy() for c in (*keys, "role")]
            edges = np.flatnonzero(np.any([x[1:] != x[:-1] for x in marks], axis=0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                piece, group = batch.slice(a, b - a), tuple(int(x[a]) for x in marks[:-1])
                if group != at:
                    if best is not None:
                        yield from as_batches(best.rows(), arrow)
                    at, held, best = group, [], None
                if marks[-1][a] == 0:
                    held.append(arrays(piece, True))
                elif held:
                    if best is None:
                        best = Block({c: np.concatenate([x[c] for x in held]) for c in held[0]}, same, keep, scale)
                    best.add(arrays(piece, False))
        if best is not None:
            yield from as_batches(best.rows(), arrow)

    return both.repartition(n_partitions(rows), *keys).sortWithinPartitions(*keys, "role").mapInArrow(run, schema)


def firsts(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` rows of each anchor's windows with their place."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "uid")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` have vec_id, label and v, see ``usable``; ``is_anchor`` is the stated set of anchors.
    """
    of = references(rows, scale)
    if not len(of):
        return rows.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    known = stored(rows, is_anchor, of, scale)
    cells = spans(known, len(of))
    members = known.drop("is_anchor")
    anchors = members.filter(known["is_anchor"])
    block = min(BLOCK, max(LEAST_BLOCK, known.count() // (2 * n_partitions(rows))))

    def windows(low: Column, high: Column) -> list[Column]:
        return [low.cast("array<long>").alias("low"), high.cast("array<long>").alias("high")]

    # Positives: those of an anchor's own cell tell which score the others must reach.
    lowest_long, highest_long = F.lit(LONG.min), F.lit(LONG.max)
    first = anchors.select("*", *windows(F.array(lowest_long), F.array(highest_long)))
    near = staged(met(first, members, ["cell", "label"], True, positives, scale, block), "near")
    reached = firsts(near, positives).filter(F.col("place") == positives).select(F.col("anchor").alias("uid"), F.col("score").alias("reached"))
    second = first.join(reached, "uid", "left").withColumn("low", F.array(F.coalesce("reached", lowest_long)))
    second = second.select(first.columns)
    others = met(staged(routed(second, cells, elsewhere=True), "elsewhere"), members, ["cell", "label"], True, positives, scale, block)
    chosen = staged(firsts(near.unionByName(others), positives), "positives")

    # Negatives: a window of scores below each positive.
    p = F.col("score").cast("decimal(20,0)")
    from_ = F.ceil(p * lowest / 100).cast("long")  # decimals: a long times a hundred may be none
    until = F.floor(p * highest / 100).cast("long")
    each = F.struct("place", from_.alias("low"), until.alias("high"))
    per_anchor = chosen.groupBy(F.col("anchor").alias("uid")).agg(F.sort_array(F.collect_list(each)).alias("w"))  # five at most
    # Lists of one length: a place without a positive has an empty window.
    padded = [
        F.array(*(F.coalesce(F.get("w", F.lit(i))[c], F.lit(e)) for i in range(positives))) for c, e in (("low", 1), ("high", 0))
    ]
    asked = anchors.join(per_anchor, "uid").select(*anchors.columns, *windows(*padded))
    sent = staged(routed(asked, cells, elsewhere=False), "windows")
    found = firsts(met(sent, members, ["cell"], False, negatives, scale, block), negatives)
    pairs = chosen.select("anchor", (F.col("place") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    named = found.select("anchor", "window", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return named.join(pairs, ["anchor", "window"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


#: For ids that one row has.
ORACLE = f"""
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, id, score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}
)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
     AND {LOWEST} * p.score <= 100 * n.score AND 100 * n.score <= {HIGHEST} * p.score
QUALIFY rank <= {NEGATIVES}
"""
