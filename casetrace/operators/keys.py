"""Surrogate keys, insert-if-absent and id lookup (K1-K3).

``assign_ids`` numbers rows 1..n in a total order without a single-partition
exchange:

1. range-partition on the order columns and sort within partitions, so
   partition *i* holds keys that all sort before partition *i+1*; write that
   once, as parquet, so the order is fixed and survives executor loss, and
   later reads take only their columns.  A row's place is the number of its
   file and its index there, which Spark gives with the rows it reads
   (``_metadata``); neither is stored.  The range exchange reads its input twice, to sample boundaries and
   to deal rows; below it stands a shuffle (every caller passes distinct or
   joined rows), whose files serve both readings;
2. count rows per file (one a partition, unless the session limits records per
   file) and turn the counts into running offsets, once - a table with as many
   rows as there are files, which stands in the plan as it is and is the only
   thing that is broadcast, so that reading numbered rows counts nothing again;
3. id = start + offset(file) + index inside the file.

An id is a row's rank in the total order, so it hangs on the data alone and
not on where the sampled boundaries fall.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrace.operators.joins import fanout_join
from casetrace.session import scratch_path

_FILE = "__ct_file"
_POS = "__ct_pos"
_OFF = "__ct_off"


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols]


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` computed once, as parquet in the shared scratch folder."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(file: str) -> tuple[int, int]:
    """Partition and number in it of a file ``part-<partition>-<job>-c<number>...``."""
    return int(re.match(r"part-(\d+)-", file)[1]), int(re.search(r"-c(\d+)\.", file)[1])


def _offsets(tagged: DataFrame) -> DataFrame:
    """For every file the number of rows in the files before it: one row per
    file passes the driver and stays in the plan as a local table."""
    counts = {r[0]: r[1] for r in tagged.groupBy(_FILE).agg(F.count(F.lit(1))).collect()}
    files = sorted(counts, key=_place)
    before = [0]
    for file in files:
        before.append(before[-1] + counts[file])
    return tagged.sparkSession.createDataFrame(pa.table({
        _FILE: pa.array(files, pa.string()), _OFF: pa.array(before[:-1], pa.int64())}))


def assign_ids(df: DataFrame, order_cols: Sequence[str | Column], id_col: str = "id",
               start: int | Column = 0, num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = start + 1 .. start + n following ``order_cols``.

    ``order_cols`` must be a total order on ``df`` (ties get an arbitrary but
    fixed order).  ``start`` may be a scalar-subquery column such as the
    current maximum id of the target table; a number spares every reading of
    the result that query.
    """
    order = _order(order_cols)
    # Without an explicit count the range exchange uses the session's shuffle
    # partitions and AQE merges adjacent small ranges (order is kept), so a
    # 25-row table does not become thousands of empty partitions.
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    tagged = written(ranged, "ordered").select(
        "*", F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.row_index").alias(_POS))
    start_col = start if isinstance(start, Column) else F.lit(start)
    numbered = tagged.join(F.broadcast(_offsets(tagged)), _FILE).withColumn(
        id_col, (start_col + F.col(_OFF) + F.col(_POS) + F.lit(1)).cast("long"))
    return numbered.select(id_col, *[c for c in df.columns])


def max_id(table: DataFrame, id_col: str) -> Column:
    """Current maximum id of ``table`` (0 when empty) as a scalar subquery."""
    return table.select(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()


def last_id(table: DataFrame, id_col: str) -> int:
    """Current maximum id of ``table`` (0 when empty), computed now."""
    return table.agg(F.max(id_col)).first()[0] or 0


def append_new(existing: DataFrame | None, incoming: DataFrame,
               insert_key: Sequence[str], order_cols: Sequence[str],
               id_col: str) -> DataFrame:
    """Insert-if-absent (K2): rows of ``incoming`` whose ``insert_key`` is not
    yet in ``existing`` get new ids continuing after ``max(existing.id)``;
    the result is the whole table (existing rows unchanged).

    ``incoming`` must already be distinct on the rows it carries.  It is not
    de-duplicated on ``insert_key``: two incoming rows that share the key but
    differ elsewhere are both inserted, as a set-based INSERT ... WHERE NOT
    EXISTS against the table before the statement does.
    """
    if existing is None:
        return assign_ids(incoming, order_cols, id_col)
    new_rows = incoming.join(existing.select(*insert_key), list(insert_key), "left_anti")
    numbered = assign_ids(new_rows, order_cols, id_col, start=last_id(existing, id_col))
    return existing.select(numbered.columns).unionByName(numbered)


def lookup_id(df: DataFrame, dim: DataFrame, on: dict[str, str], id_col: str,
              how: str = "inner", split_hot: bool = False, repeats: bool = True) -> DataFrame:
    """Attach ``dim.id_col`` to ``df`` by natural key (K3).

    ``on`` maps a column of ``df`` to a column of ``dim``.  Join keys of the
    dimension are renamed to the ``df`` names, so the result keeps ``df``'s
    columns plus ``id_col``.  With ``split_hot`` a key that makes very many
    rows is spread over tasks by its counted pairs (``repeats`` as in
    ``fanout_join``); callers that pass distinct rows of few per key do not
    need it.
    """
    right = dim.select(F.col(id_col), *[F.col(d).alias(s) for s, d in on.items()])
    if split_hot and how == "inner":
        return fanout_join(df, right, list(on), repeats=repeats)
    return df.join(right, list(on), how)
