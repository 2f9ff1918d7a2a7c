"""Joins to a table with a unique key, when few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetrace.session import default_parallelism


def join_to_unique(left: DataFrame, right: DataFrame, key: str, rows: int) -> DataFrame:
    """``left`` (a stored table of ``rows`` rows) joined to ``right``, which
    holds each ``key`` once.

    Keys with more rows than half a partition's share take their row of
    ``right`` by broadcast, so their rows stay where they are.  There are at
    most twice as many such keys as shuffle partitions, whatever the data.
    All others are joined by shuffle.
    """
    limit = max(1_000, rows // (2 * default_parallelism(left.sparkSession)))
    hot = left.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit).select(key)
    few = right.join(F.broadcast(hot), key)
    rest = left.join(F.broadcast(hot), key, "left_anti").join(right, key)
    return left.join(F.broadcast(few), key).unionByName(rest)
