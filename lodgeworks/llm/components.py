"""Connected components by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeworks.session import staged


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for all nodes of ``links`` (``a``, ``b``).

    Large star: every neighbour larger than a node is tied to the node's smallest neighbour; small star:
    the same for the smaller ones. The number of rounds grows with the logarithm of the nodes. A
    node's minimum is an aggregate with partial results, never a list of neighbours. Each round is
    written to the shared folder, so lineage stays short. Both inputs of the joins are files, which
    lets adaptive execution split a centre with very many links.
    """
    edges = links.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).filter("x <> y").distinct()
    edges = staged(edges, "edges")
    before = None
    while True:
        edges = _star(edges, large=True)
        edges = _star(edges, large=False)
        # Sum and count of the edges settle exactly when the edges do.
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("x").alias("node"), F.col("y").alias("root"))
    return roots.unionAll(edges.select("y", "y").toDF("node", "root").distinct())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges ``x`` > ``y``; the result has the same form."""
    if large:
        both = edges.select(F.col("x").alias("u"), F.col("y").alias("v")).unionAll(edges.select(F.col("y"), F.col("x")))
        both = staged(both, "both")
    else:
        both = edges.select(F.col("x").alias("u"), F.col("y").alias("v"))
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m")), "least")
    joined = both.join(least, F.col("u") == F.col("c"))
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("x"), F.col("m").alias("y"))
    else:
        # Each smaller neighbour and the node itself are tied to the smallest one.
        moved = joined.select(F.col("v").alias("x"), F.col("m").alias("y")).unionAll(
            least.select(F.col("c").alias("x"), F.col("m").alias("y")))
    return staged(moved.filter("x <> y").distinct(), "edges")
