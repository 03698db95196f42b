"""Connected components of a large graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgloom.llm.common import small, staged


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, from edges (a, b) of numbers.

    In each round every node hooks on to its smallest neighbour if that is smaller. The
    hooks are a spanning forest of what they join; each of its trees is brought to one
    level by following them twice as far with every step, and becomes one node. Edges
    inside a tree are gone with that, parallel ones are one, so a group that is densely
    linked is one node after the first round and takes no part in the next. Every tree
    joins another or is a whole component, so trees at least halve in number with each
    round. Rounds and steps are written to the shared folder, so no lineage grows. Nodes
    without an edge to another node are absent.
    """
    current = staged(_between(edges, "a", "b"), "edges")
    roots = None
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("root"))
        trees = _levelled(staged(hooks, "hooks"))
        found = small(trees)
        ends = [found.select(F.col("node").alias(n), F.col("root").alias(r)) for n, r in (("u", "ru"), ("v", "rv"))]
        current = staged(_between(current.join(ends[0], "u").join(ends[1], "v"), "ru", "rv"), "edges")
        if roots is None:
            roots = trees
        else:
            later = small(trees.select(F.col("node").alias("root"), F.col("root").alias("of")))
            roots = staged(roots.join(later, "root", "left").select("node", F.coalesce("of", "root").alias("root")), "roots")
    return edges.sparkSession.createDataFrame([], "node long, root long") if roots is None else roots


def _between(edges: DataFrame, a: str, b: str) -> DataFrame:
    """The edges between different nodes as u > v, each once."""
    return edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()


def _levelled(hooks: DataFrame) -> DataFrame:
    """node and root of the trees that the hooks (to smaller nodes or itself) make."""
    while True:
        inner = hooks.filter("node != root")  # what hangs on a root is where it belongs
        above = small(staged(inner.select(F.col("node").alias("root"), F.col("root").alias("above")), "above"))
        deep = hooks.join(above, "root", "left")
        if deep.filter("above is not null").isEmpty():
            return hooks
        hooks = staged(deep.select("node", F.coalesce("above", "root").alias("root")), "hooks")
