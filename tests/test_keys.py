from pyspark.sql import functions as F

from casetrace.operators.keys import append_new, assign_ids, lookup_id


def _ids(df, id_col="id"):
    return sorted((r[id_col], r.k) for r in df.collect())


def test_ids_are_dense_and_follow_the_order(spark):
    src = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    out = assign_ids(src, ["k"], "id", num_partitions=5)
    got = _ids(out)
    assert [i for i, _ in got] == list(range(1, 1001))
    assert all(k == i - 1 for i, k in got)


def test_ids_do_not_depend_on_partitioning(spark):
    src = spark.range(0, 500).select((F.col("id") * 31 % 500).alias("k"))
    runs = [_ids(assign_ids(src.repartition(p), ["k"], "id", num_partitions=n))
            for p, n in [(1, 1), (3, 4), (7, 9), (2, 16)]]
    assert all(r == runs[0] for r in runs)


def test_start_offsets_ids(spark):
    src = spark.createDataFrame([("b",), ("a",)], "k string")
    assert _ids(assign_ids(src, ["k"], "id", start=10)) == [(11, "a"), (12, "b")]


def test_empty_input(spark):
    src = spark.createDataFrame([], "k string")
    assert assign_ids(src, ["k"], "id").count() == 0


def test_append_new_only_adds_absent_keys(spark):
    first = append_new(None, spark.createDataFrame([("a", 1), ("c", 1)], "k string, v int"),
                       ["k"], ["k", "v"], "id")
    incoming = spark.createDataFrame([("a", 2), ("b", 1), ("b", 2), ("c", 1)], "k string, v int")
    out = append_new(first, incoming, ["k"], ["k", "v"], "id")
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, "a", 1), (2, "c", 1), (3, "b", 1), (4, "b", 2)]


def test_append_plans_an_anti_join(spark):
    first = spark.createDataFrame([(1, "a")], "id long, k string")
    incoming = spark.createDataFrame([("a",), ("b",)], "k string")
    out = append_new(first, incoming, ["k"], ["k"], "id")
    assert out.count() == 2
    new_rows = incoming.join(first.select("k"), ["k"], "left_anti")
    assert "LeftAnti" in new_rows._jdf.queryExecution().executedPlan().toString()


def test_numbering_plan_has_no_single_partition_exchange_of_rows(spark):
    src = spark.range(0, 100).select(F.col("id").alias("k"))
    out = assign_ids(src, ["k"], "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the only single-partition exchange is the window over the per-partition
    # counts, which sits under the broadcast
    assert plan.count("SinglePartition") <= 1
    assert "BroadcastExchange" in plan or "BroadcastHashJoin" in plan


def test_lookup_id(spark):
    dim = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "pid long, g string, f string")
    df = spark.createDataFrame([("a", "x", 10), ("b", "z", 20)], "gg string, ff string, v int")
    out = lookup_id(df, dim, {"gg": "g", "ff": "f"}, "pid")
    assert [(r.pid, r.v) for r in out.collect()] == [(1, 10)]


def test_numbered_copy_joins_back_to_its_source(spark):
    src = spark.range(0, 50).select((F.col("id") % 7).cast("string").alias("k"),
                                    F.col("id").alias("v"))
    kinds = assign_ids(src.select("k").distinct(), ["k"], "rank")
    best = src.join(kinds, "k").groupBy(F.col("v") % 2).agg(F.max("rank").alias("rank"))
    back = best.join(kinds, "rank").select("rank", "k")
    assert sorted(r.k for r in back.collect()) == ["6", "6"]


def test_ids_need_no_stored_position(spark):
    """A place is the file and the index in it; several files a partition count on."""
    src = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        out = assign_ids(src, ["k"], "id", num_partitions=4)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(out.inputFiles()) > 40
    assert _ids(out) == [(k + 1, k) for k in range(5000)]
    assert spark.read.parquet(*out.inputFiles()).columns == ["k"]
