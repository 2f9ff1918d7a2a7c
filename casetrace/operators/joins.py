"""Equi-joins where one key can be hot on both sides (J3 fan-out).

A hot key is a matter of the *rows it makes*, not of the bytes it reads: a name
with 4,000 contacts and 4,000 bearers reads little and makes 16 million rows in
one task.  Splitting by input size, as adaptive execution does, does not see
it.  ``fanout_join`` therefore decides by counted pairs, in every session:

1. count rows per hash of the key on both sides (with map-side combine, numbers
   only); where no hash makes too many rows no key does, and the inputs are
   joined as they are.  Else count rows per key;
2. a key that makes more than ``pairs_per_task`` rows gets a grid of cells, as
   many as its pairs need, cut along both sides in proportion to their rows;
3. a left row of such a key takes one row of the grid by a hash of all its
   columns, and is copied along the grid's columns; a right row the other way
   round.  Every pair meets in exactly one cell, and a task gets a cell.

The counts of hot keys are frozen once; nothing is broadcast by hint, and only
small right sides are at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrace.session import ensure_checkpoint_dir

# A right side of more rows is joined by shuffle, whatever its files' size: packed
# names are many times larger in the memory of a broadcast.
BROADCAST_ROWS = 200_000
_ROW, _COLUMN = "__ct_row", "__ct_column"


def hot_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
             pairs_per_task: int) -> DataFrame:
    """Keys that make more than ``pairs_per_task`` rows, with the numbers of
    ``rows`` and ``columns`` of their grid."""
    ensure_checkpoint_dir(left.sparkSession)
    n_left = left.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("__l"))
    n_right = right.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("__r"))
    cells = F.ceil(F.col("__l") * F.col("__r") / pairs_per_task)
    rows = F.greatest(F.lit(1.0), F.least(
        F.col("__l"), cells, F.ceil(F.sqrt(cells * F.col("__l") / F.col("__r")))))
    return (n_left.join(n_right, list(keys))
            .where(F.col("__l") * F.col("__r") > pairs_per_task)
            .select(*[F.col(k).alias(k) for k in keys], rows.cast("long").alias("rows"),
                    F.ceil(cells / rows).cast("long").alias("columns"))
            .checkpoint(eager=True))


def _may_be_hot(left: DataFrame, right: DataFrame, keys: list[str], pairs_per_task: int) -> bool:
    """Whether some hash of ``keys`` makes more than ``pairs_per_task`` rows; no
    key makes more than its hash."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.xxhash64(*keys).alias("__h")).agg(F.count(F.lit(1)).cast("double").alias(name))

    both = counted(left, "__l").join(counted(right, "__r"), "__h")
    return not both.where(F.col("__l") * F.col("__r") > pairs_per_task).isEmpty()


def _cells(df: DataFrame, hot: DataFrame, keys: list[str], own: str, other: str,
           own_size: str, other_size: str) -> DataFrame:
    """Rows with their place on the grid; keys that are not hot have one cell."""
    sized = df.join(hot, keys, "left")
    one = F.lit(1).cast("long")

    def size(name: str) -> Column:
        return F.coalesce(F.col(name), one)

    return (sized.withColumn(own, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]),
                                         size(own_size)))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), size(other_size) - 1)))
            .drop("rows", "columns"))


def fanout_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                pairs_per_task: int = 1_000_000, repeats: bool = True) -> DataFrame:
    """Inner join on ``keys`` in which no key makes much more than
    ``pairs_per_task`` rows in a task.  Both inputs are read twice, so pass
    stored or frozen tables.  Repeated rows share a cell: distinct inputs split
    best.  A caller that needs no repeated left rows says ``repeats=False``:
    they are taken out where there is a hot key, and only there, so a feed
    without one is not shuffled for it."""
    keys = list(keys)
    if not _may_be_hot(left, right, keys, pairs_per_task):
        return left.join(right.hint("merge") if right.count() > BROADCAST_ROWS else right, keys)
    hot = hot_keys(left, right, keys, pairs_per_task)
    left = left if repeats else left.distinct()
    on_left = _cells(left, hot, keys, _ROW, _COLUMN, "rows", "columns")
    on_right = _cells(right, hot, keys, _COLUMN, _ROW, "columns", "rows")
    return on_left.join(on_right, [*keys, _ROW, _COLUMN]).drop(_ROW, _COLUMN)
