"""Connected components by distributed union-find on an edge table.

Large star and small star take turns: every node's larger neighbours are hung on its
smallest neighbour, then its smaller ones. Each turn keeps the components and makes trees
flatter, until all edges point at the smallest node. Minima are combined in each task
before they are shuffled, and the join that follows has one row per node on one side, so
Spark can split a node with very many neighbours. The driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.session import discard, stored_at


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """``node, root`` with node > root."""
    if larger:
        turned = edges.select(F.col("root").alias("node"), F.col("node").alias("root"))
        pairs = edges.unionByName(turned)
    else:
        pairs = edges
    least = pairs.groupBy(F.col("node").alias("_node")).agg(F.min("root").alias("_least"))
    least = least.withColumn("_least", F.least("_least", "_node"))
    joined = pairs.join(least, F.col("node") == F.col("_node"))
    if larger:
        kept = joined.filter(F.col("root") > F.col("node"))
        made = kept.select(F.col("root").alias("node"), F.col("_least").alias("root"))
    else:
        own = least.select(F.col("_node").alias("node"), F.col("_least").alias("root"))
        made = joined.select(F.col("root").alias("node"), F.col("_least").alias("root"))
        made = made.unionByName(own)
    return made.filter(F.col("node") > F.col("root")).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root`` for every node that is not the smallest of its component.

    ``root`` is the smallest node. NULL ends and loops are ignored, repeated edges count
    once; without edges there are no rows.
    """
    a, b = F.col(left), F.col(right)
    ends = edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
    ends = ends.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root"))
    edges, folder = stored_at(ends.distinct(), "edges")
    before = None
    while True:
        sums = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(node, root))")).first()
        if not sums[0] or sums == before:
            return edges
        before, old = sums, folder
        edges, folder = stored_at(_star(_star(edges, larger=True), larger=False), "edges")
        discard(edges.sparkSession, old)
