"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrace.session import ensure_checkpoint_dir

# Words and white space as every operator here understands them.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def frozen(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, under
    fresh column identities so that it joins back to its own source."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.select(*[F.col(f"`{c}`").alias(c) for c in df.columns]).checkpoint(eager=True)


def words_of(text: Column) -> Column:
    """Words of a text as an array; a null or blank text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != F.lit(""))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % modulus
                      == F.lit(remainder), F.lit(False))


def packed(df: DataFrame, used: Sequence[str]) -> DataFrame:
    """``df`` with its ``used`` columns in the open and all others in one
    struct, so that no column an operator adds can clash with them."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in used]
    return df.select(*used, F.struct(*others or [F.lit(0).alias("none")]).alias("__others"))


def unpacked(df: DataFrame, columns: Sequence[str], used: Sequence[str]) -> DataFrame:
    """The columns that ``packed`` was given, in their order."""
    return df.select(*[F.col(c) if c in used else F.col(f"__others.`{c}`").alias(c) for c in columns])


def require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])
