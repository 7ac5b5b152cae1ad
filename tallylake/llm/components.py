"""Connected components of an edge table by alternating star contractions."""

from pyspark.sql import functions as F

from tallylake.llm.storage import discarded, shuffles_removed, stored


def _down(edges):
    """Distinct edges from the larger to the smaller node."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _contract(edges):
    """One large-star and one small-star step over edges (a > b)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = _down(large)
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _down(small.union(least.select("a", F.col("m").alias("b"))))


def connected_components(edges, most_rounds=60):
    """(node, component): each node of edges (a, b) with the least node it is connected to.

    Every round points each node's larger neighbours at its least neighbour, then each node and its smaller neighbours
    at the least one; paths shrink to stars in a number of rounds logarithmic in their length. Each round is one stored
    table made of grouped minima and equi-joins, and one aggregate that tells whether only stars are left.
    """
    now = stored(_down(edges), "components")
    for _ in range(most_rounds):
        # Stars: no node has two centres, and no centre is a leaf.
        roles = now.select(F.col("a").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).union(
            now.select("b", F.lit(0), F.lit(1)).distinct()
        )
        with shuffles_removed(edges.sparkSession):
            if roles.groupBy("node").agg((F.sum("leaf") + F.sum("centre")).alias("n")).where("n > 1").isEmpty():
                break
        before, now = now, stored(_contract(now), "components")
        discarded(before)
    else:
        raise RuntimeError("components did not settle")
    return now.toDF("node", "component").union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
