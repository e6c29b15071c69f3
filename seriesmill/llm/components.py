"""Connected components of an edge table, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import stored


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """(node, root): the smallest node of the component, for every node that has an edge.

    ``edges``: (a, b). Alternates two steps until nothing changes: every node sends its larger neighbours to its
    smallest one, then its smaller ones. Both are groupings with map-side minima; the number of rounds grows with
    the logarithm of the longest path, not with its length. Each round is stored, and so are its minima before they are
    joined: both sides of a join then come straight from an exchange, and adaptive execution can split a node with very
    many neighbours.
    """
    pairs = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stored(pairs, label)
    while True:
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), label)
        # Larger neighbours go to the smallest one around.
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        large = stored(large.where("a <> b").distinct(), label)
        # Smaller neighbours, and the node itself, go to the smallest of them: pairs are (a < b), so b is the node.
        low = stored(large.groupBy("b").agg(F.min("a").alias("m")), label)
        small = large.join(low, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b").distinct()
        after = stored(small, label)
        # Settled: the same pairs as before (both are distinct).
        same = pairs.intersect(after).count()
        if same == after.count() == pairs.count():
            return after.select(F.col("b").alias("node"), F.col("a").alias("root")).union(after.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
        pairs = after
