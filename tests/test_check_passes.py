"""Unique checks group large tables in passes."""

from pyspark.sql import functions as F

from casetrace.operators import quality


def _table(spark):
    """3,000 ids on 3 tasks: 1 to 2,970 once, but 7 is there 4 times, 8 twice, and 26 NULLs."""
    ids = F.when(F.col("id") >= 2974, F.lit(None)).when(F.col("id") >= 2971, F.lit(7)).when(
        F.col("id") == 0, F.lit(8)).otherwise(F.col("id"))
    return spark.range(0, 3000, numPartitions=3).select(
        ids.cast("long").alias("person_id"), F.concat(F.lit("n" * 130), ids.cast("string")).alias("given"))


def _broken(df, cols):
    return quality.unique_check("person", df, cols, "primary_key").first()["n"]


def test_passes_follow_the_largest_task(spark):
    df = _table(spark)
    assert quality.passes(df, 1000) == 1 and quality.passes(df, 999) == 2 and quality.passes(df, 100) == 10
    assert quality.passes(df.where("false"), 100) == 1


def test_keys_are_counted_the_same_in_passes(spark, monkeypatch):
    df = _table(spark)
    for cols in (["person_id"], ["given"], ["given", "person_id"]):
        assert _broken(df, cols) == 3      # 7, 8 and NULL
    monkeypatch.setattr(quality, "ROWS_PER_TASK", 200)
    for cols in (["person_id"], ["given"], ["given", "person_id"]):
        assert _broken(df, cols) == 3
    plan = quality.unique_check("person", df, ["person_id"], "primary_key")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("pmod") >= 5
