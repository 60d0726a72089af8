"""Connected components of an edge table, by contraction: no edges, nodes or components are gathered anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import dropped, saved, small


def _ranked(node: Column) -> Column:
    """A node under a fixed random rank, so that no order of names makes a long chain of falling ones."""
    return F.struct(F.xxhash64(node, F.lit(3)).alias("rank"), node.alias("node"))


def components(edges: DataFrame, rounds: list | None = None) -> DataFrame:
    """edges: (a, b), of one type, in any direction, repeated or not; edges with a null end don't count. Returns (node,
    root): each node that has an edge to another, with the smallest node of its component. No edges: no rows.

    Each round names a node after the one of least rank among itself and its neighbours, and maps the edges accordingly;
    edges within a node vanish. On a path about half of the nodes stay names, whatever their order, and a star is one
    name after two rounds, so rounds grow with the logarithm of the longest path. Rounds are written to the shared
    folder and removed at the end. rounds: gets the number of names of each round (tests)."""
    left = saved(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    names: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(_ranked(F.col("b"))).alias("low"))
        name = saved(low.select(F.col("a").alias("node"), F.least("low", _ranked(F.col("a")))["node"].alias("name")), "names")
        at = left.join(small(name.select(F.col("node").alias("a"), F.col("name").alias("x"))), "a").join(small(name.select(F.col("node").alias("b"), F.col("name").alias("y"))), "b")
        new = saved(at.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        dropped(left)
        names.append(name)
        if rounds is not None:
            rounds.append(name.count())
        left = new
    if not names:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = names[0]
    for later in names[1:]:
        out = out.join(small(later.select(F.col("node").alias("name"), F.col("name").alias("top"))), "name", "left").select("node", F.coalesce("top", "name").alias("name"))
    out = saved(out, "named")
    dropped(left, *names)
    lowest = saved(out.groupBy("name").agg(F.min("node").alias("root")), "roots")
    return out.join(small(lowest), "name").select("node", "root")
