"""Connected components of a graph given as links between numbered nodes."""

from pyspark.sql import DataFrame, functions as F

from navlake.llm.common import cut


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """``links`` with each node's least neighbour; a node with very many links can be split.

    The hash beside the node has both sides dealt out for this join instead of reusing the
    grouping, which is what lets adaptive execution split a hot node.
    """
    return links.withColumn("spread", F.xxhash64("node")).join(
        least.withColumn("spread", F.xxhash64("node")), ["node", "spread"]).drop("spread")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    least = both.groupBy("node").agg(F.min("other").alias("least")).select(
        "node", F.least("least", "node").alias("least"))
    return _with_least(both.where("other > node"), least).select(
        F.col("other").alias("node"), F.col("least").alias("other")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("node").agg(F.min("other").alias("least"))
    joined = _with_least(links, least)
    return (
        joined.where("other > least").select(F.col("other").alias("node"), F.col("least").alias("other"))
        .unionByName(least.select("node", F.col("least").alias("other")))
        .distinct()
    )


def components(links: DataFrame, node: str, other: str) -> DataFrame:
    """``node, root`` for each node that is not the least of its component.

    Alternates large-star and small-star steps, which move every node's links to smaller
    nodes, until all links point at the least node of their component. Each pass is written to
    the shared checkpoint folder; only a count and a checksum reach the driver.
    """
    pairs = links.where(F.col(node) != F.col(other)).select(
        F.greatest(node, other).alias("node"), F.least(node, other).alias("other"))
    current, seen = cut(pairs.distinct()), None
    while True:
        state = current.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "other"))).first()
        if state == seen or not state[0]:
            return current.select("node", F.col("other").alias("root"))
        seen = state
        current = cut(_small_star(_large_star(current)))
