"""Connected components of a graph of links, by alternating large and small stars on DataFrames.

Every round replaces links by links to smaller nodes (Kiveris et al., "Connected Components in MapReduce and Beyond",
2014), so the number of links never grows; a node with very many links costs one partial minimum and a join that Spark
may split, never a task of its own. Links of each round are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiremill.llm.common import checkpointed


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step on links (u, v) with u > v. large: every neighbour above a node is linked to the node's least neighbour; else those below it."""
    if large:
        seen = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = pairs
    least = seen.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        # A node that is smaller than all its neighbours is its own least.
        least = least.select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        moved = pairs.join(least, pairs["v"] == least["c"]).select("u", F.col("m").alias("v"))
    else:
        least = least.select(F.col("u").alias("c"), "m")
        joined = pairs.join(least, pairs["u"] == least["c"])
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def _mark(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link to another: component is the least node reachable. links: (u, v) in any order, repeats and loops allowed, nulls ignored."""
    pairs = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs, before = checkpointed(pairs), None
    now = _mark(pairs)
    while now[0] and now != before:
        before = now
        pairs = checkpointed(_star(_star(pairs, large=True), large=False))
        now = _mark(pairs)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(pairs.select("v", "v").distinct().toDF("node", "component"))
