"""Approximate nearest neighbours by learned partitions.

On a bounded sample of vectors a graph of nearest neighbours is built and divided into
parts of about equal size that cut few edges. A small network learns to tell a vector's
part from the vector alone, and its outputs are shifted until the parts it names are of
like size. Every row is then put into its most probable part, every query is sent to its
several most probable parts, and all members of these are ranked by their exact cosine.

How many parts a query needs is measured: for ``CHECKED`` rows, by hash of the id, the
exact neighbours among all rows are found in one pass, and the number is the least with
which ``RECALL`` of these lie in the parts. The sample grows with the number of parts up
to ``MOST_PARTS`` parts; in larger tables the parts grow. Only the sample, the network and
the checked rows' neighbours reach the driver. Rows and queries are dealt out by part and,
within a part, in blocks: a part with very many rows or queries is several groups, and no
group holds more than one block of each.

Vectors are scaled by powers of two where their norms would leave the range of doubles;
that changes no cosine.

Defined results: vectors that are null, zero, of another length than most of the sample,
or hold a null or non-finite component take no part; rows are told apart by place, so an
id that several rows have is found, and asks, as often as it is there; rows equal to the
query in id and vector count as the query's own; ties go to the smaller id; fewer
candidates than asked for are all returned; an empty table gives none; other columns
than id and vector are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orgloom.llm.common import arrow_schema, as_batches, map_batches, n_partitions, staged, table

SAMPLE = 6_000
#: Rows of the sample for each part, if that is more.
FOR_EACH_PART = 50
#: Neighbours in the graph, hidden units of the network, rounds over the sample.
EDGES, HIDDEN, EPOCHS = 10, 96, 40
#: A part for about so many rows, two parts at least unless there are very few rows.
ROWS_PER_PART, MOST_PARTS = 1_500, 256
#: Rows whose neighbours are found exactly to see how many parts a query needs.
CHECKED = 300
#: Rows and queries in one block.
BLOCK, QUERIES = 8_192, 4_096
RECALL = 0.92
SEED = 9


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and v (doubles) of the vectors that take part."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    doubles = rows.select(F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias("v"))
    return doubles.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0))


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a column of equally long lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def in_range(x: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two if their norm could over- or underflow."""
    top = np.frexp(np.abs(x).max(axis=1, initial=0))[1]
    return np.ldexp(x, -np.where(np.abs(top) > 400, top, 0)[:, None])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest rows of each row of unit vectors."""
    out = np.empty((len(x), k), np.int64)
    for start in range(0, len(x), 1024):
        near = x[start : start + 1024] @ x.T
        near[np.arange(len(near)), start + np.arange(len(near))] = -2
        out[start : start + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 30) -> np.ndarray:
    """A part for each row: few neighbours elsewhere, no part much larger than the mean.

    Starts from balanced nearest centres; then rows move, a share at a time, to the part
    where most of their neighbours are, less a price that rises with the part's size.
    """
    rng = np.random.default_rng(SEED)
    n, cap = len(x), 1.1 * len(x) / parts
    centres = x[rng.choice(n, parts, replace=False)]
    part = np.zeros(n, np.int64)
    price = np.zeros(parts)
    for _ in range(rounds):
        part = (x @ centres.T - price).argmax(axis=1)
        sizes = np.bincount(part, minlength=parts)
        price += 0.05 * (sizes - n / parts) / (n / parts)
        price = np.clip(price, -0.5, 0.5)
        for p in np.flatnonzero(sizes):
            centres[p] = x[part == p].mean(axis=0)
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1.0)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1.0)
        sizes = np.bincount(part, minlength=parts)
        votes -= 2.0 * graph.shape[1] * np.maximum(0, sizes - n / parts) / (n / parts)
        best = votes.argmax(axis=1)
        moving = (best != part) & (rng.random(n) < 0.3) & (sizes[best] < cap)
        if not moving.any():
            break
        part[moving] = best[moving]
    return part


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer that gives each part's log probability up to a constant."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    length: int
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(unit(x) @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def balanced(self, x: np.ndarray, rounds: int = 200) -> Router:
        """The network with outputs shifted so that the rows of ``x`` spread evenly over the parts."""
        logits = self.logits(x)
        shift, step = np.zeros(logits.shape[1]), 0.1 * logits.std()
        for k in range(rounds):
            sizes = np.bincount((logits + shift).argmax(axis=1), minlength=len(shift))
            shift -= step / (1 + k / 20) * np.clip(sizes / sizes.mean() - 1, -1, 1)
        return replace(self, b2=self.b2 + shift)

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts of each row, most probable first."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")


def trained(x: np.ndarray, part: np.ndarray, parts: int) -> tuple[np.ndarray, ...]:
    """Layers of the network, by stochastic gradient descent with momentum."""
    rng = np.random.default_rng(SEED + 1)
    layers = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)),
        np.zeros(parts),
    ]
    speed = [np.zeros_like(a) for a in layers]
    for epoch in range(EPOCHS):
        rate = 0.2 * (1 - epoch / EPOCHS)
        order = rng.permutation(len(x))
        for start in range(0, len(x), 128):
            i = order[start : start + 128]
            h = np.maximum(x[i] @ layers[0] + layers[1], 0)
            z = h @ layers[2] + layers[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(i)), part[i]] -= 1
            p /= len(i)
            back = (p @ layers[2].T) * (h > 0)
            for a, v, g in zip(layers, speed, (x[i].T @ back, back.sum(0), h.T @ p, p.sum(0)), strict=True):
                v *= 0.9
                v -= rate * (g + 1e-4 * a)
                a += v
    return tuple(layers)


def fit(rows: DataFrame, total: int, sample: int = SAMPLE, k: int = 5) -> Router | None:
    """The router learned from a bounded sample, by hash of the id; None without rows. It asks all parts yet."""
    parts = min(MOST_PARTS, max(2, total // ROWS_PER_PART))
    sample = max(sample, FOR_EACH_PART * parts)
    got = rows.orderBy(F.xxhash64("vec_id"), "vec_id", F.xxhash64("v")).limit(sample).select("v").toArrow()["v"].combine_chunks()
    lengths = Counter(got.value_lengths().to_pylist())
    if not lengths:
        return None
    length = max(lengths, key=lambda n: (lengths[n], n))
    x = unit(in_range(np.array([v for v in got.to_pylist() if len(v) == length])))
    parts = min(parts, len(x) // 20)
    if parts < 2:
        zeros = np.zeros((length, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)
        return Router(*zeros, length, 1)
    part = balanced_parts(x, neighbour_graph(x, min(max(EDGES, k), len(x) - 1)), parts)
    return Router(*trained(x, part, parts), length, parts).balanced(x)


def probed(router: Router, members: DataFrame, recall: float, k: int, checked: int = CHECKED) -> tuple[Router, float]:
    """The router with the least number of parts that reaches the recall on checked rows, and that recall.

    Their exact neighbours are found among all members in one pass; each task returns
    ``k`` for each checked row at most.
    """
    picked = members.orderBy(F.xxhash64("vec_id", F.lit("checked")), "vec_id", F.xxhash64("v")).limit(checked)
    asked = picked.select("vec_id", "v").toArrow().combine_chunks()
    if router.probes == 1 or not len(asked):
        return router, 1.0
    ids, vectors = asked["vec_id"].to_numpy(), matrix(asked["v"].combine_chunks())
    shared = members.sparkSession.sparkContext.broadcast((ids, vectors, router.order(vectors).argsort(axis=1)))
    schema = StructType.fromDDL("row long, vec_id long, uid long, score double")
    arrow = arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, place = shared.value
        best = Best(np.arange(len(ids)), ids, vectors, k)
        for batch in batches:
            if batch.num_rows:
                part = batch["part"].to_numpy().astype(np.int64)
                best.add(batch["vec_id"].to_numpy(), part, matrix(batch["v"]))  # the part, in the place of the row's number
        row, other, part, score = best.rows()
        yield from as_batches({"row": pa.array(row), "vec_id": pa.array(other), "uid": pa.array(place[row, part]), "score": pa.array(score)}, arrow)

    found = members.select("vec_id", "part", "v").mapInArrow(search, schema)
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    needed = found.withColumn("rank", rank).filter(F.col("rank") <= k).groupBy("uid").agg(F.count("*").alias("n")).collect()
    counts = np.zeros(router.probes, np.int64)  # one row for each place at most
    for r in needed:
        counts[r.uid] += r.n
    shares = np.cumsum(counts) / max(1, counts.sum())
    probes = next((p for p, s in enumerate(shares, 1) if s >= recall), router.probes)
    return replace(router, probes=probes), float(shares[probes - 1])


def routed(rows: DataFrame, router: Router, probes: int) -> DataFrame:
    """uid, vec_id, part and v, one row for each of the ``probes`` most probable parts."""
    shared = rows.sparkSession.sparkContext.broadcast(router)

    def make():
        of = shared.value

        def run(batch: pa.RecordBatch) -> dict:
            x = in_range(matrix(batch["v"]))
            order = of.order(x)[:, :probes]
            taken = np.repeat(np.arange(batch.num_rows), order.shape[1])
            flat = pa.array(x[taken].ravel())
            return {
                "uid": batch["uid"].take(pa.array(taken)),
                "vec_id": batch["vec_id"].take(pa.array(taken)),
                "part": pa.array(order.ravel().astype(np.int32)),
                "v": pa.ListArray.from_arrays(pa.array(np.arange(len(taken) + 1, dtype=np.int32) * x.shape[1]), flat),
            }

        return run

    same = rows.filter(F.size("v") == router.length)
    numbered = same if "uid" in rows.columns else same.withColumn("uid", F.monotonically_increasing_id())
    return map_batches(numbered.select("uid", "vec_id", "v"), make, "uid long, vec_id long, part int, v array<double>")


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, recall: float = RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's ``k`` nearest rows found.

    Both have vec_id and v, see ``usable``; the queries are the stated set to search for.
    """
    rows, queries = rows.select("vec_id", "v"), queries.select("vec_id", "v")
    total = rows.count()
    router = fit(rows, total, k=k)
    if router is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    members = staged(routed(rows, router, 1), "members")
    router, _ = probed(router, members, recall, k)
    asking = staged(queries.filter(F.size("v") == router.length).withColumn("uid", F.monotonically_increasing_id()), "asking")
    asked = staged(routed(asking, router, router.probes), "queries")
    counts = members.groupBy("part").agg(F.count("*").alias("n")).join(
        asked.groupBy("part").agg(F.count("*").alias("q")), "part"
    )  # one row for each part
    blocks = F.broadcast(
        counts.select("part", F.ceil(F.col("n") / BLOCK).cast("int").alias("nb"), F.ceil(F.col("q") / QUERIES).cast("int").alias("qb"))
    )

    def shared_out(df: DataFrame, own: str, other: str, role: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("uid"), F.col(own)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        return df.join(blocks, "part").select("part", mine, every, F.lit(role).alias("role"), "uid", "vec_id", "v").select(
            "part", "nb", "qb", "role", "uid", "vec_id", "v"
        )

    both = shared_out(asked, "qb", "nb", 0).unionByName(shared_out(members, "nb", "qb", 1))
    schema = StructType.fromDDL("query long, query_id long, vec_id long, uid long, score double")
    arrow = arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, uids, ids, vectors, best = None, [], [], [], None

        def sent() -> Iterator[pa.RecordBatch]:
            if best is not None:
                row, other, uid, score = best.rows()
                own = {"query": pa.array(best.uids[row]), "query_id": pa.array(best.ids[row])}
                yield from as_batches(own | {"vec_id": pa.array(other), "uid": pa.array(uid), "score": pa.array(score)}, arrow)

        for batch in batches:
            keys = [batch[c].to_numpy() for c in ("part", "nb", "qb", "role")]
            edges = np.flatnonzero(np.any([x[1:] != x[:-1] for x in keys], axis=0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                piece = batch.slice(a, b - a)
                group = tuple(int(x[a]) for x in keys[:3])
                if group != at:
                    yield from sent()
                    at, uids, ids, vectors, best = group, [], [], [], None
                x = matrix(piece["v"])
                if keys[3][a] == 0:
                    uids.append(piece["uid"].to_numpy())
                    ids.append(piece["vec_id"].to_numpy())
                    vectors.append(x)
                elif ids:
                    if best is None:
                        best = Best(np.concatenate(uids), np.concatenate(ids), np.concatenate(vectors), k)
                    best.add(piece["vec_id"].to_numpy(), piece["uid"].to_numpy(), x)
        yield from sent()

    dealt = both.repartition(n_partitions(rows), "part", "nb", "qb").sortWithinPartitions("part", "nb", "qb", "role", "vec_id")
    found = dealt.mapInArrow(search, schema)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "uid"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class Best:
    """The ``k`` nearest rows so far of each query of a block; a row is told by id and number."""

    def __init__(self, uids: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.uids, self.ids, self.vectors, self.k = uids, ids, vectors, k
        self.norms = np.linalg.norm(vectors, axis=1)
        self.found: list[list[tuple[float, int, int]]] = [[] for _ in ids]

    def add(self, ids: np.ndarray, uids: np.ndarray, rows: np.ndarray) -> None:
        norms = np.linalg.norm(rows, axis=1)
        near = (self.vectors / self.norms[:, None]) @ (rows / norms[:, None]).T
        for i, j in zip(*np.nonzero(self.ids[:, None] == ids[None, :]), strict=True):
            if np.array_equal(self.vectors[i], rows[j]):
                near[i, j] = -3  # the query's own
        # The product rounds by place; what is near enough to count is scored anew, alike for equal vectors.
        k = min(self.k, len(ids))
        least = -np.partition(-near, k - 1, axis=1)[:, k - 1] - 1e-9
        for i, j in enumerate(np.split(*_places(near >= np.maximum(least, -2)[:, None]))):
            if len(self.found[i]) >= self.k:
                j = j[near[i, j] >= self.found[i][-1][0] - 1e-9]
            if len(j):
                score = (self.vectors[i] * rows[j]).sum(axis=1) / (self.norms[i] * norms[j])
                new = self.found[i] + list(zip(score.tolist(), ids[j].tolist(), uids[j].tolist(), strict=True))
                self.found[i] = sorted(new, key=lambda x: (-x[0], x[1], x[2]))[: self.k]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place of the query, id, number and score of each row kept."""
        flat = [(i, v, u, s) for i, best in enumerate(self.found) for s, v, u in best]
        columns = zip(*flat, strict=True) if flat else ((), (), (), ())
        return tuple(np.array(c, kind) for c, kind in zip(columns, (np.int64, np.int64, np.int64, np.float64), strict=True))


def _places(taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the true places, row by row, and where each next row begins."""
    return np.nonzero(taken)[1], np.cumsum(taken.sum(axis=1))[:-1]


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    return nearest(rows, rows.filter(F.col("vec_id") % 50 == 0))
