"""Sums of equally shaped arrays over all partitions, as a tree.

Every task makes one array; arrays are then added ``FAN`` at a time, in the
order of their partitions, until one is left.  A task holds ``FAN`` arrays at
most and the driver one, however many partitions there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetrace.llm.common import frozen

FAN = 32


def sum_arrays(rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray],
               shape: tuple[int, ...], kind: str = "<f8") -> np.ndarray:
    """Sum of ``partial`` (its batches -> an array of ``shape``) over all
    partitions; zeros for an empty table."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = partial(batches)
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()),
             pa.array([np.ascontiguousarray(total, kind).tobytes()], pa.binary())], names=["part", "body"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(shape, kind)
        for body in pdf.sort_values("part")["body"]:
            total += np.frombuffer(body, kind).reshape(shape)
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // FAN], "body": [total.tobytes()]})

    schema = "part long, body binary"
    sums = frozen(rows.mapInArrow(each, schema))
    top = sums.agg(F.max("part")).first()[0]
    while top:
        sums = frozen(sums.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(add, schema))
        top //= FAN
    last = sums.select("body").collect()  # one row, none for an empty table
    return np.frombuffer(last[0]["body"], kind).reshape(shape).copy() if last else np.zeros(shape, kind)
