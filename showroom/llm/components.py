"""Connected components of a table of links, by alternating large and small stars.

Each round writes its links to the shared folder, so lost executors repeat one round at most. A
node's smallest neighbour is an aggregate and joins back by key; no neighbourhood meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showroom.llm.shared import written


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    near = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of the links (a, b): the smallest node reachable.

    Links without both ends and links of a node to itself are left out, as are nodes without links.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, state = written(links, "links"), None
    while True:
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == now:
            break
        state = now
        links = written(_small(_large(links)), "links")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
