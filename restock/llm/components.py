"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour, itself included."""
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    ends = both.select(F.col("high").alias("node"), F.col("low").alias("other"))
    least = ends.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
    larger = ends.filter("other > node").join(least, "node")
    return larger.select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    inner = links.join(least, "high").filter("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return inner.unionByName(least.select("high", F.col("least").alias("low"))).distinct()


def _state(links: DataFrame) -> tuple:
    mixed = F.xxhash64("high", "low").bitwiseAND(F.lit((1 << 40) - 1))
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of a link (a, b); the root is the component's smallest node.

    Alternating large-star and small-star rounds; each halves the depth at least, so their number
    grows with the logarithm of a component's size. No neighbourhood is gathered in one place. Links
    of a node with itself and repeated links change nothing; no links give no rows.
    """
    ends = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    current = written(ends.filter("high > low").distinct())
    state = _state(current)
    while state[0]:
        current = written(_small_star(_large_star(current)))
        before, state = state, _state(current)
        if before == state:
            break
    nodes = current.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return nodes.unionByName(current.select(F.col("low").alias("node"), F.col("low").alias("root"))).distinct()
