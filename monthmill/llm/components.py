"""Connected components of a large graph by alternating large and small stars.

A large star links every node's greater neighbours to its smallest one; a small star does so with the node
and its smaller neighbours. Both keep the components, and after a few rounds every node hangs on the smallest
node of its component. No step makes pairs: an edge stays one edge. The minima and the edges of each round are written, so that
lineage stays short and a join on a node with very many edges is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import written


def _state(edges: DataFrame) -> tuple:
    key = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(key), F.sum(F.shiftright(key, 24))).first())


def _star(links: DataFrame) -> DataFrame:
    """(a, b, least): the links with the least of a and all b's of a."""
    least = links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return links.join(written(least, "least"), "a")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node that has an edge to a smaller one in its component's star: the smallest node itself
    is not listed. edges: two columns of longs, in either direction, repeated or not."""
    a, b = edges.columns
    ab = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b")
    now = written(ab.distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = written(now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
        large = _star(both).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        large = written(large, "large")
        starred = _star(large)
        small = starred.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            starred.select("a", F.col("least").alias("b"))
        )
        now = written(small.filter("a <> b").distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
