"""Sharding by sampled splitters, on DataFrame functions only.

Records are ordered by a key (a hash of the group, then the record id), so
equal groups lie together and no source or length clusters.  Then:

1. draw a size-weighted sample of keys: a record is drawn with a probability
   in proportion to its size, judged by a hash of its key, so the draw is
   repeatable;
2. choose quantile boundaries of the sample as splitters, many per shard;
3. measure the exact bytes of every range; ranges well above the mean are
   subdivided by splitters drawn inside them, until none is left (a hot
   group's copies differ in record id, so its range can be divided);
4. cut exactly: in the (at most ``shards`` - 1) ranges that a shard boundary
   falls into, running sums find the first key beyond it;
5. number the rows of each range, and add the range's offset in its shard.

Sizes of shards therefore differ by about one record, whatever the sample.
Only splitters and per-range sums (a fixed number of rows) reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casetrace.llm.common import frozen, require

RANGES_PER_SHARD = 24
SAMPLE_PER_RANGE = 16
OVERFULL = 2.0
ROUNDS = 6
_KEY = "__key"


def range_of(key: Column, splitters: list) -> Column:
    """Number of splitters at or below ``key``: a binary search over sorted
    constant arrays, a handful of comparisons a row."""
    if not splitters:
        return F.lit(0)
    steps = [1 << b for b in range(len(splitters).bit_length() - 1, -1, -1)]
    # one array per part of the key: a single array of structs would be built
    # anew for every comparison
    h, r, s = (F.lit(np.array(part, dtype=np.int64)) for part in zip(*splitters))

    def reached(i: Column) -> Column:
        ties = ((F.get(r, i) < key["r"]) | ((F.get(r, i) == key["r"]) & (F.get(s, i) <= key["s"])))
        return (F.get(h, i) < key["h"]) | ((F.get(h, i) == key["h"]) & ties)

    return F.aggregate(
        F.array(*[F.lit(n) for n in steps]), F.lit(0),
        lambda at, step: F.when(reached(at + step - 1), at + step).otherwise(at))


def _draw(rows: DataFrame, rate: Column, salt: int) -> DataFrame:
    """Records drawn with probability ``size * rate`` (at most 1), each with
    the weight it stands for."""
    chance = F.least(F.col("size") * rate, F.lit(1.0))
    point = F.pmod(F.xxhash64(F.lit(salt), _KEY), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(point < chance).withColumn("w", F.col("size") / chance)


def _quantiles(sample: DataFrame, by: list[str], pieces: Column) -> list:
    """Keys where the running weight of the sample passes a multiple of
    1/``pieces`` of its total, per group ``by``."""
    order = Window.partitionBy(*by).orderBy(_KEY)
    part = Window.partitionBy(*by)
    run = F.sum("w").over(order)
    step = F.sum("w").over(part) / pieces
    cut = sample.select(*by, _KEY, F.floor((run - F.col("w")) / step).alias("a"),
                        F.floor(run / step).alias("b"))
    found = cut.where(F.col("b") > F.col("a")).select(f"{_KEY}.*").distinct().collect()
    return [tuple(r) for r in found]


def shard_records(records: DataFrame, group: Column, record_id: Column, size: Column,
                  shards: int) -> DataFrame:
    """``records`` with ``shard`` (0 to ``shards`` - 1, sizes near equal) and
    ``slot`` (0, 1, ... in each shard).

    Columns of ``records`` travel through one sort, so keep wide payloads out
    and join them back by id, or write them with ``write_shards``.  Records
    are never dropped: a null group or id is a key like any other, repeated
    rows are told apart by a running salt, a record larger than a shard fills
    one alone, and an empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    rows = frozen(records.select(
        F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("__row"),
        F.struct(F.xxhash64(group).alias("h"),
                 F.coalesce(record_id.cast("long"), F.lit(-(1 << 62))).alias("r"),
                 F.monotonically_increasing_id().alias("s")).alias(_KEY),
        F.greatest(F.coalesce(size.cast("long"), F.lit(1)), F.lit(1)).alias("size")))

    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = shards * RANGES_PER_SHARD
    splitters: list = []
    if total:
        rate = F.lit(ranges * SAMPLE_PER_RANGE / total)
        sample = _draw(rows, rate, 0).withColumn("g", F.lit(0))
        splitters = sorted(_quantiles(sample, ["g"], F.lit(float(ranges))))
    limit = OVERFULL * total / ranges if total else 0
    for step in range(1, ROUNDS + 1):
        per_range = _per_range(rows, splitters)
        overfull = {r: b for r, b, many in per_range if b > limit and many}
        if not overfull or step == ROUNDS:
            break
        inside = (rows.withColumn("g", range_of(F.col(_KEY), splitters))
                  .where(F.col("g").isin(list(overfull))))
        drawn = _draw(inside, F.lit(4 * SAMPLE_PER_RANGE / (total / ranges)), step)
        more = _quantiles(drawn, ["g"], F.greatest(F.ceil(F.sum("w").over(
            Window.partitionBy("g")) / (total / ranges)), F.lit(2)).cast("double"))
        if not set(more) - set(splitters):
            break
        splitters = sorted({*splitters, *more})

    cuts = _exact_cuts(rows, splitters, per_range, total, shards) if total else []
    placed = rows.select("__row", _KEY, range_of(F.col(_KEY), splitters).alias("__range"),
                         range_of(F.col(_KEY), cuts).cast("int").alias("shard"))
    # offsets of the ranges of each shard: a row per range and shard
    before = Window.partitionBy("shard").orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("shard", "__range").agg(F.count(F.lit(1)).alias("n"))
               .select("shard", "__range", F.coalesce(F.sum("n").over(before), F.lit(0))
                       .alias("__before")))
    place = F.row_number().over(Window.partitionBy("shard", "__range").orderBy(_KEY))
    return (placed.withColumn("__place", place)
            .join(F.broadcast(offsets), ["shard", "__range"])
            .select("__row.*", "shard", (F.col("__before") + F.col("__place") - 1)
                    .cast("long").alias("slot")))


def _per_range(rows: DataFrame, splitters: list) -> list[tuple[int, int, bool]]:
    """(range, bytes, whether it can be divided) - a row per range."""
    parts = ["h", "r", "s"]
    same = [F.min(f"{_KEY}.{c}") == F.max(f"{_KEY}.{c}") for c in parts]
    got = (rows.groupBy(range_of(F.col(_KEY), splitters).alias("g"))
           .agg(F.sum("size").alias("b"), (~(same[0] & same[1] & same[2])).alias("many"))
           .collect())
    return sorted(tuple(r) for r in got)


def _exact_cuts(rows: DataFrame, splitters: list, per_range: list, total: int,
                shards: int) -> list:
    """First key of every shard but the first: the first record whose middle
    byte lies at or beyond the shard's share of all bytes.  Shards that one
    large record spans get equal cuts, so they stay empty."""
    crossed, starts, at = [], [], 0
    for g, b, _ in per_range:
        starts.append((g, at))
        if at * shards // total != (at + b) * shards // total:
            crossed.append((g, at))
        at += b
    found: dict[int, tuple] = {}
    if crossed:
        near = rows.withColumn("g", range_of(F.col(_KEY), splitters)).where(
            F.col("g").isin([g for g, _ in crossed]))
        start = F.coalesce(*[F.when(F.col("g") == g, F.lit(b).cast("long")) for g, b in crossed])
        run = F.sum("size").over(Window.partitionBy("g").orderBy(_KEY).rowsBetween(
            Window.unboundedPreceding, 0))
        shard = near.withColumn("m", (2 * (start + run) - F.col("size")) * shards).withColumn(
            "t", F.expr(f"least(m div {2 * total}L, {shards - 1}L)"))
        found = {r["t"]: (r["h"], r["r"], r["s"]) for r in
                 shard.groupBy("t").agg(F.min(_KEY).alias("k")).select("t", "k.*").collect()}
    cuts = []
    for t in range(1, shards):
        # a range that starts at or beyond the share belongs to it from its first key on
        later = next((splitters[g - 1] for g, b in starts if g and b * shards >= t * total), None)
        options = [k for u, k in found.items() if u >= t] + ([later] if later else [])
        if options:
            cuts.append(min(options))
    return cuts


def write_shards(placed: DataFrame, path: str) -> None:
    """Write whole records, one folder a shard, rows in slot order."""
    require(placed, ["shard", "slot"])
    (placed.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot")
     .write.mode("errorifexists").partitionBy("shard").parquet(path))
