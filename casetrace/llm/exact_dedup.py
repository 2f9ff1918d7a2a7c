"""Exact duplicates by progressive refinement, on DataFrame functions only.

Texts are equal when they are identical after deleting every character of
``[\\x20\\x09-\\x0D]``.  What may be equal is narrowed step by step:

1. length: rows are counted by the bytes of their normalised text (with the
   next step's hash beside, so the first scan makes both); lengths that occur
   once go;
2. prefix hash: of the rest, rows are counted by length and the hash of the
   first ``PREFIX`` characters; pairs that occur once go;
3. full hash: the second scan takes the SHA-256 of whole texts of the groups
   that are left, and equal hashes make a group.

Scan and groups meet through a bit array with one bit per surviving group's
hash, at most ``FILTER_BITS`` bits: a row outside has no equal, a row inside
is hashed, and one that came in by a shared bit is alone with its hash.  So no
text is shuffled, and the array's size is bounded; where it is full, rows are
hashed in vain and nothing else changes.

Of equal texts, the row with the most code points in its original text stays,
then the least ``doc_id``.  A group of very many rows is counted with map-side
combining and split over tasks where its rows meet its keeper.

Result for odd input: a null text is empty, and all empty or blank texts are
one group; a null ``doc_id`` counts as the greatest; of rows that are the same
in id and text exactly one stays; a very long text is read whole; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrace.llm.common import SPACE, frozen, require
from casetrace.operators.joins import fanout_join
from casetrace.session import default_parallelism, scratch_path

PREFIX = 64
FILTER_BITS = 1 << 27
MAP_BITS = 1 << 15  # bits of one bitmap of Spark's bitmap functions


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, "")


def _mark(size: Column, head: Column) -> Column:
    return F.xxhash64(size, head)


def crowded(docs: DataFrame) -> DataFrame:
    """(size, head) of the groups that length and prefix hash leave; frozen."""
    sized = docs.select(normal(F.col("text")).alias("__normal")).select(
        F.octet_length("__normal").alias("size"),
        F.xxhash64(F.substring("__normal", 1, PREFIX)).alias("head"))
    counted = frozen(sized.groupBy("size", "head").agg(F.count(F.lit(1)).alias("n")))
    lengths = counted.groupBy("size").agg(F.sum("n").alias("of_size")).where("of_size > 1")
    return frozen(counted.join(lengths.select("size"), "size").where("n > 1").select("size", "head"))


def _bitmaps(groups: DataFrame) -> tuple[DataFrame, int]:
    """The bit array of the groups' hashes, a row per 4 KB that has a bit set,
    and its number of bits: 16 per group, a power of two, bounded."""
    bits = min(FILTER_BITS, max(MAP_BITS, 1 << max(16 * groups.count() - 1, 1).bit_length()))
    place = F.pmod(_mark(F.col("size"), F.col("head")), F.lit(bits)) + 1
    maps = (groups.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
            .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("map")))
    return frozen(maps), bits


def _bit(bitmap: Column, place: Column) -> Column:
    byte = F.substring(bitmap, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1


def hashed(docs: DataFrame, hash_all: bool = False) -> DataFrame:
    """``doc_id, points, may_repeat, full_hash`` of every row, frozen.
    ``full_hash`` is null where the refinement rules out an equal text, unless
    the caller wants the hash of every row as well."""
    maps, bits = _bitmaps(crowded(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("points"),
                       normal(F.col("text")).alias("__normal"))
    rows = rows.withColumn("__place", F.pmod(_mark(F.octet_length("__normal"), F.xxhash64(
        F.substring("__normal", 1, PREFIX))), F.lit(bits)) + 1).withColumn(
        "part", F.bitmap_bucket_number("__place"))
    # at most FILTER_BITS / 8 bytes, whatever the corpus
    rows = rows.join(F.broadcast(maps), "part", "left").withColumn("may_repeat", F.coalesce(
        _bit(F.col("map"), F.bitmap_bit_position("__place")), F.lit(False)))
    full = F.sha2("__normal", 256)
    rows = rows.select("doc_id", "points", "may_repeat",
                       (full if hash_all else F.when(F.col("may_repeat"), full)).alias("full_hash"),
                       F.monotonically_increasing_id().alias("__row"))
    path = scratch_path(docs.sparkSession, "hashed")
    rows.write.parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def duplicates(docs: DataFrame, hash_all: bool = False) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, full_hash`` of every row."""
    require(docs, ["doc_id", "text"])
    rows = hashed(docs, hash_all)
    compared = rows.where("may_repeat")
    order = F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"),
                     "doc_id", "__row")
    groups = frozen(compared.groupBy("full_hash").agg(
        F.min(order).alias("lead"), F.count(F.lit(1)).alias("group_size")))
    several = groups.where("group_size > 1").select(
        "full_hash", F.col("lead.doc_id").alias("keep_id"), F.col("lead.__row").alias("__keep_row"), "group_size")
    per_task = max(1_000, 2 * rows.count() // default_parallelism(docs.sparkSession))
    grouped = fanout_join(compared.select("full_hash", "doc_id", "__row"), several, ["full_hash"], per_task)
    # a group of one is its leading row
    alone = rows.where(~F.col("may_repeat")).select("doc_id", "full_hash").unionByName(
        groups.where("group_size = 1").select(F.col("lead.doc_id").alias("doc_id"), "full_hash"))
    return grouped.select("doc_id", "keep_id", "group_size",
                          (F.col("__row") == F.col("__keep_row")).alias("kept"), "full_hash").unionByName(
        alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                     F.lit(True).alias("kept"), "full_hash"))
