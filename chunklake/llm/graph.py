"""Connected components of an undirected graph given as edges, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import kept


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for each node of ``edges`` (``a``, ``b``: long).

    Large star and small star in turn: a node's neighbours are hung on its least neighbour, first the larger ones, then the
    others, until every edge points at a root. A round's edges are no more than the round's before, none is collected,
    and each round is written to the shared folder, so a lost executor costs one round.
    """
    now = kept(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    for _ in range(most_rounds):
        # large star: larger neighbours of u hang on the least of u and its neighbours
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).withColumn("m", F.least("u", "m"))
        large = now.join(least, now.b == F.col("u")).select("a", F.col("m").alias("b")).distinct()
        # small star: smaller neighbours of u, and u, hang on the least of them
        lowest = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        hung = large.join(lowest, large.a == F.col("u"))
        small = hung.select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("u").alias("b"), "m"))).alias("e")).select(
            F.col("e.b").alias("a"), F.col("e.m").alias("b")
        )
        after = kept(small.filter("a <> b").distinct(), "components")
        if _digest(after) == _digest(now):
            break
        now = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
