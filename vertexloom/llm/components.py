"""Connected components of links between integers, on Spark.

Alternates large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond"): each node's neighbours are linked to
the smallest of them, until every component is a star around its smallest
node. Links never leave the cluster; each step's rows are written to the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexloom.llm.common import counted_join, written


def _least(links: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, and its number of links, by which the joins split hubs."""
    return written(links.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "links-least")


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours are linked to the smallest neighbour, or to the node itself."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = counted_join(both.filter("v > u"), _least(both), ["u"], "inner", "n")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours and the node itself are linked to the smallest neighbour."""
    least = _least(links)
    others = counted_join(links, least, ["u"], "inner", "n").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node of the links; the root is the smallest node of its component.

    Links may repeat, point either way or join a node to itself; such a
    node alone is a component of one. Links with a null end are left out.
    """
    known = links.select(F.col(u).alias("u"), F.col(v).alias("v")).dropna()
    ends = written(known.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    now = ends.filter("u > v")
    alone = ends.filter("u = v").select("u")
    mark = None
    while True:
        now = written(_small_star(written(_large_star(now), "links-large")), "links-small")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).unionByName(alone.select(F.col("u").alias("node"), F.col("u").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
