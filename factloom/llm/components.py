"""Connected components of a link table, by rounds of contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.store import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): two nodes have one label if a path of links joins them.

    In each round every node takes the least of itself and its neighbours, by the order
    of a hash, and the links move to those. The hash makes long paths shrink by a fixed
    share in each round; the minimum is a partial aggregate, so a node with many links
    is no hot key. Nulls and self-links are ignored. The label is one of the nodes.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    edges = stored(pairs.where("a <> b").distinct(), "links")
    moved: list[DataFrame] = []
    salt = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        ranked = [F.struct(F.xxhash64(F.lit(salt), c).alias("rank"), F.col(c).alias("node")) for c in "ab"]
        least = both.groupBy("a").agg(F.min(F.least(*ranked)).alias("least"))
        to = stored(least.select(F.col("a").alias("node"), F.col("least.node").alias("label")), "moved")
        moved.append(to)
        at_a = to.select(F.col("node").alias("a"), F.col("label").alias("x"))
        at_b = to.select(F.col("node").alias("b"), F.col("label").alias("y"))
        edges = stored(
            edges.join(at_a, "a").join(at_b, "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "links",
        )
        salt += 1
    if not moved:
        return edges.selectExpr("a AS node", "a AS label")
    found = moved[-1]
    for earlier in reversed(moved[:-1]):
        later = found.select(F.col("node").alias("label"), F.col("label").alias("root"))
        found = earlier.join(later, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    return found
