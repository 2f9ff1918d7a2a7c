"""Packing by power-of-two decomposition.

Every document's ids (its tokens, then one end id) are cut into pieces whose
lengths are powers of two: as many of the longest length as fit, then the
binary digits of the rest from large to small.  A sequence is one piece, so no
sequence ever crosses documents and none needs padding; sequences of equal
length lie next to each other (longest first), which is how a trainer batches
them.

Result for odd input: a null or empty text packs to its end id alone; a null
``doc_id`` is kept; repeated rows and ids pack once per row; a very long text
gives many full pieces; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrace.llm.common import frozen, require, struct
from casetrace.llm.tokens import id_bytes, word_encoder
from casetrace.operators.keys import assign_ids

PIECE_SCHEMA = struct(("doc_id", T.LongType()), ("start", T.LongType()),
                      ("length", T.LongType()), ("ids", T.BinaryType()),
                      ("doc_tokens", T.LongType()))
_OUT_ROWS = 20_000


def piece_lengths(n: int, longest: int) -> list[int]:
    """``n`` as full pieces followed by its binary digits, large to small."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1)
                                         if rest >> b & 1]


def cut_documents(docs: DataFrame, tokenizer: str, longest: int = 1024,
                  end_id: int = 0) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens``.

    ``tokenizer`` is the path of a ``tokenizers`` file on the workers, ``ids``
    little-endian unsigned 32-bit.  No shuffle; a task holds one Arrow batch.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    require(docs, ["doc_id", "text"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        end = id_bytes([end_id])
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()),
                            ("length", pa.int64()), ("ids", pa.binary()),
                            ("doc_tokens", pa.int64())])
        for batch in batches:
            rows: list[tuple] = []
            for doc, raw in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                raw += end
                n, at = len(raw) // 4, 0
                for length in piece_lengths(n, longest):
                    rows.append((doc, at, length, raw[4 * at:4 * (at + length)], n))
                    at += length
                if len(rows) >= _OUT_ROWS:
                    yield _batch(rows, schema)
                    rows = []
            if rows:
                yield _batch(rows, schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, PIECE_SCHEMA)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, f.type) for col, f in zip(zip(*rows), schema)], schema=schema)


def bucket_sequences(pieces: DataFrame) -> DataFrame:
    """Give every piece its sequence: ``sequence_id`` runs from 0 without gaps,
    longest pieces first, then by document and place; ``offset`` is 0 because
    a sequence holds one piece.  Columns beside the keys travel along, so drop
    wide ones the caller does not need before.  The pieces are frozen first:
    the numbering reads its input twice, and tokens are made once."""
    numbered = assign_ids(frozen(pieces.withColumn("__longest", -F.col("length"))),
                          ["__longest", "doc_id", "start"], "sequence_id", start=-1)
    return numbered.drop("__longest").withColumn("offset", F.lit(0).cast("long"))


def unpack(raw: bytes) -> np.ndarray:
    """Ids of one ``ids`` value."""
    return np.frombuffer(raw, "<u4")
