"""Connected components of a graph that is given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.session import cut


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) of edges (x, y): the smallest node of each node's connected component.

    In every round each node's larger neighbours are hung on its smallest one (large star), then a
    node and its smaller neighbours on the smallest of those (small star), until no edge changes; the
    rounds grow with the logarithm of the longest path. Minima are pre-aggregated before each shuffle and
    a node's neighbours are never collected.
    """
    edges = cut(links.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).where("u < v").distinct())
    nodes = edges.select("u").unionAll(edges.select("v")).distinct().withColumnRenamed("u", "node")
    before = None
    for _ in range(most_rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select("m", "v").where("m < v").distinct()
        low = large.groupBy("v").agg(F.min("m").alias("l"))
        small = large.join(low, "v").select(F.col("l").alias("u"), F.explode(F.array("v", "m")).alias("v")).where("u < v").distinct()
        edges = cut(small)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("label"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
