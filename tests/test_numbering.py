"""Numbered tables are read without counting their rows again."""

from pyspark.sql import functions as F

from casetrace.operators.keys import append_new, assign_ids


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_offsets_are_counted_once(spark):
    src = spark.range(0, 3000).select(((F.col("id") * 7919) % 3000).alias("k"))
    out = assign_ids(src, ["k"], "id", num_partitions=12)
    plan = _plan(out)
    assert "BroadcastExchange" in plan
    for again in ("HashAggregate", "Window", "hashpartitioning", "SinglePartition"):
        assert again not in plan, again
    assert sorted(tuple(r) for r in out.collect()) == [(k + 1, k) for k in range(3000)]


def test_second_load_holds_no_query_for_the_last_id(spark):
    first = append_new(None, spark.createDataFrame([("a",), ("c",)], "k string"), ["k"], ["k"], "id")
    both = append_new(first, spark.createDataFrame([("b",), ("c",)], "k string"), ["k"], ["k"], "id")
    assert "ubquery" not in _plan(both)
    none = append_new(first.where("false"), spark.createDataFrame([("b",)], "k string"), ["k"], ["k"], "id")
    assert sorted(tuple(r) for r in both.collect()) == [(1, "a"), (2, "c"), (3, "b")]
    assert [tuple(r) for r in none.collect()] == [(1, "b")]
