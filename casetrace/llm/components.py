"""Connected components of an edge table, as Spark joins.

Alternating star contraction: each node points its larger neighbours to the
smallest one it knows, then its smaller ones, until every component is a star
around its least node.  Each step shuffles the edges once or twice and its
result is frozen in the shared folder; the number of steps grows with the
logarithm of the longest path.  The hub of a star keeps its edges where they
are (``join_to_unique``).  Nothing but two counters reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetrace.llm.common import frozen
from casetrace.llm.skew import join_to_unique


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (join_to_unique(both.where("v > u"), least, "u", rows)
            .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a > b").distinct())


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = join_to_unique(edges, least, "a", rows).where("b > m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the least node of
    its component.  ``edges`` has columns ``a`` and ``b``."""
    state = frozen(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a > b").distinct())
    mark = None
    while True:
        now = state.agg(F.count(F.lit(1)), F.coalesce(F.sum(
            F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
        if tuple(now) == mark or not now[0]:
            break
        mark = tuple(now)
        state = frozen(_small_star(frozen(_large_star(state, now[0])), now[0]))
    return (state.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("root")))
            .distinct())
