"""Connected components of a table of links, by repeated contraction.

Each round hooks every node to its smallest neighbour if that is smaller, jumps pointers until the
hooks are stars, and replaces the links by links between the stars' centres. Links at least halve in
nodes each round. Every table of a round is written to the shared folder, nothing is collected, and
all joins are between plain tables, so that skewed ones can be split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _stars(hooks: DataFrame) -> DataFrame:
    """(node, to) with ``to`` the end of each chain of hooks."""
    while True:
        up = hooks.select(F.col("node").alias("to"), F.col("to").alias("far"))
        jumped = written(hooks.join(up, "to", "left").select("node", F.coalesce("far", "to").alias("to"), F.col("far").isNotNull().alias("moved")), "cc-jump")
        hooks = jumped.select("node", "to")
        if jumped.where("moved").isEmpty():
            return hooks


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links(a, b)``; root is one node of its component."""
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "cc-links")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    found = written(nodes.select("node", F.col("node").alias("root")), "cc-nodes")
    while not edges.isEmpty():
        stars = _stars(written(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to")), "cc-hooks"))
        a, b = (stars.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")) for c in "ab")
        ends = written(edges.join(a, "a", "left").select(F.coalesce("a_to", "a").alias("a"), "b"), "cc-half")
        ends = ends.join(b, "b", "left").select("a", F.coalesce("b_to", "b").alias("b"))
        edges = written(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "cc-links")
        found = written(found.join(stars.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "cc-nodes")
    return found
