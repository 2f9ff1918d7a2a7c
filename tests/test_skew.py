"""A name held by very many persons: the contact fan-out is cut by counted pairs,
under the session's stock settings."""

from pyspark.sql import functions as F

from casetrace.operators.joins import fanout_join, hot_keys
from casetrace.plans.model import build_associate, build_model, build_person, contact_rows

from feed_rows import d, records


def test_hot_name_is_whole(spark):
    hot = [{"person_given": "Hot", "person_family": "Name", "person_address": f"A{i}",
            "contact_from": d("2020-01-01"), "contact_to": d("2020-01-01"),
            "contact_kind": f"k{i % 7}", "associate_given": f"S{i % 5}"}
           for i in range(300)]
    cold = [{"person_given": f"P{i}", "person_address": f"B{i}"} for i in range(60)]
    feed = records(spark, *hot, *cold).repartition(8)
    rows = contact_rows(feed, build_person(feed), build_associate(feed))
    # every hot person gets every distinct hot contact (7 kinds x 5 associates
    # seen together: i % 7 and i % 5 give 35 pairs); every cold person its own
    assert rows.count() == 300 * 35 + 60


def _sides(spark, n_left, n_right):
    left = spark.range(n_left).select(F.lit("hot").alias("name"), F.col("id").alias("contact"))
    right = spark.range(n_right).select(F.lit("hot").alias("name"), F.col("id").alias("person"))
    cold = spark.range(50).select(F.concat(F.lit("c"), "id").alias("name"),
                                  F.col("id").alias("x"))
    return (left.unionByName(cold.withColumnRenamed("x", "contact")),
            right.unionByName(cold.withColumnRenamed("x", "person")))


def test_split_join_equals_plain_join(spark):
    left, right = _sides(spark, 40, 25)
    left = left.unionByName(spark.createDataFrame([(None, 7), ("lone", 8)], "name string, contact long"))
    right = right.unionByName(spark.createDataFrame([(None, 9)], "name string, person long"))
    plain = sorted(map(tuple, left.join(right, "name").collect()))
    split = sorted(map(tuple, fanout_join(left, right, ["name"], pairs_per_task=90).collect()))
    assert split == plain and len(plain) == 40 * 25 + 50


def test_repeated_left_rows_go_where_a_key_is_hot(spark):
    left, right = _sides(spark, 40, 25)
    left = left.unionByName(left)
    plain = sorted(set(map(tuple, left.join(right, "name").collect())))
    hot = fanout_join(left, right, ["name"], pairs_per_task=90, repeats=False)
    assert sorted(map(tuple, hot.collect())) == plain and len(plain) == 40 * 25 + 50
    cold = fanout_join(left, right, ["name"], repeats=False)
    assert sorted(set(map(tuple, cold.collect()))) == plain


def test_repeated_records_change_no_table(spark):
    rows = [{"person_given": f"P{i}", "person_address": f"B{i}", "facility_name": "F",
             "facility_address": "Z", "treatment": "T", "treatment_score": i,
             "treated_from": d("2020-01-01"), "treated_to": d("2020-02-01"),
             "associate_given": f"S{i}", "met_on": d("2020-01-03")} for i in range(3)]
    once, twice = (build_model(records(spark, *feed)).tables() for feed in (rows, rows + rows[:2]))
    for name, df in once.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, twice[name].collect())), name


def test_lopsided_hot_key_is_whole(spark):
    left, right = _sides(spark, 1, 3000)
    assert fanout_join(left, right, ["name"], pairs_per_task=100).count() == 3050


def test_hot_pairs_are_spread_under_stock_settings(spark):
    """The largest task holds a small share of one hot name's pairs."""
    left, right = _sides(spark, 1000, 1000)
    saved = {k: spark.conf.get(k, None) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        grid = hot_keys(left, right, ["name"], 10_000).first()
        per_task = [r["count"] for r in fanout_join(left, right, ["name"], pairs_per_task=10_000)
                    .groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert grid["rows"] * grid["columns"] == 100
    assert sum(per_task) == 1_000_000 + 50
    assert max(per_task) < 200_000


def test_without_a_hot_key_only_numbers_are_counted(spark, monkeypatch):
    from casetrace.operators import joins
    left, right = _sides(spark, 40, 25)
    monkeypatch.setattr(joins, "hot_keys", lambda *a: 1 / 0)
    plain = fanout_join(left, right, ["name"])
    assert plain.count() == 40 * 25 + 50
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    merged = fanout_join(left, right, ["name"])
    assert "BroadcastHashJoin" not in merged._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, plain.collect()))
