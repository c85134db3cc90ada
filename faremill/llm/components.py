"""Connected components of an edge table by alternating large-star and small-star steps; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faremill.llm.common import Written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component and a root is its own.

    Each round hangs every node's larger neighbours below its smallest neighbour, then its smaller ones; stars are left when nothing
    changes, after a number of rounds that grows with the logarithm of the graph. Minima combine before the shuffle and the joins on a
    hub's edges can be split, so a node linked with a third of all others is no single task. Each round's edges are written to the
    shared folder, so a lost executor costs a task and no lineage. Self links and repeated links do no harm.
    """
    both = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    now = Written(both, "edges", shuffled=True)
    mark = _mark(now.df)
    for _ in range(rounds):
        if not mark[0]:
            break
        ways = now.df.union(now.df.select("v", "u"))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        step = Written(large, "edges", shuffled=True)
        least = step.df.groupBy("u").agg(F.min("v").alias("m"))
        hung = step.df.join(least, "u")
        small = hung.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        after = Written(small, "edges", shuffled=True)
        step.drop()
        now.drop()
        now = after
        fresh = _mark(now.df)
        if fresh == mark:
            break
        mark = fresh
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # all edges now lead to roots
    return now.df.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.df.select("v", "v").distinct())
