import os

from casetrace.plans.model import build_model
from casetrace.sources.case_feed import write_case_feed
from casetrace.streaming import read_appended_model, start_ingest

from feed_rows import records


def _without_ids(df, id_col):
    return sorted(map(repr, df.drop(id_col).collect()))


def test_stream_appends_only_new_rows(spark, scratch):
    src = f"{scratch}/incoming"
    os.makedirs(src)
    first = records(spark, {}, {"person_given": "Eva"})
    second = records(spark, {}, {"person_given": "Ivo", "facility_name": "South"})
    write_case_feed(first.coalesce(1), f"{scratch}/f1", original_header=False)
    write_case_feed(second.coalesce(1), f"{scratch}/f2", original_header=False)
    for i, folder in enumerate(["f1", "f2"]):
        part = [f for f in os.listdir(f"{scratch}/{folder}") if f.endswith(".csv")][0]
        os.rename(f"{scratch}/{folder}/{part}", f"{src}/feed-{i}.csv")
        q = start_ingest(spark, src, f"{scratch}/model",
                         checkpoint_location=f"{scratch}/stream-ckpt")
        q.awaitTermination(120)
    got = read_appended_model(spark, f"{scratch}/model")
    want = build_model(first.unionByName(second))
    assert got.person.count() == 3
    for name, df in want.tables().items():
        id_col = df.columns[0]
        ids = sorted(r[0] for r in got.tables()[name].select(id_col).collect())
        assert ids == list(range(1, len(ids) + 1)), name
        if name in ("person", "associate", "facility", "treatment", "person_stay",
                    "contact"):
            assert _without_ids(got.tables()[name], id_col) == _without_ids(df, id_col), name
    assert {r.batch for r in spark.read.parquet(f"{scratch}/model/person")
            .select("batch").distinct().collect()} == {0, 1}


def test_empty_batch_then_data(spark, scratch):
    from casetrace.streaming import FEED_TEXT_SCHEMA, append_batch
    from casetrace.sources.case_feed import to_feed_text
    empty = spark.createDataFrame([], FEED_TEXT_SCHEMA)
    assert append_batch(empty, f"{scratch}/model", 0) == {}
    assert read_appended_model(spark, f"{scratch}/model") is None
    text = to_feed_text(records(spark, {}, {"person_given": "Eva"}), original_header=False)
    counts = append_batch(text, f"{scratch}/model", 1)
    assert counts["person"] == 2
    again = append_batch(text, f"{scratch}/model", 2)     # a replayed batch adds nothing
    assert all(n == 0 for n in again.values())
    got = read_appended_model(spark, f"{scratch}/model")
    assert sorted(r.person_id for r in got.person.collect()) == [1, 2]


def test_batch_without_contacts_then_with(spark, scratch):
    from casetrace.sources.case_feed import to_feed_text
    from casetrace.streaming import append_batch
    plain = to_feed_text(records(spark, {"contact_kind": None}), original_header=False)
    assert append_batch(plain, f"{scratch}/model", 0)["contact"] == 0
    full = to_feed_text(records(spark, {"person_given": "Eva"}), original_header=False)
    assert append_batch(full, f"{scratch}/model", 1)["contact"] == 1
    assert read_appended_model(spark, f"{scratch}/model").contact.count() == 1


def test_swapped_columns_and_rejected_values(spark, scratch):
    import os
    os.makedirs(f"{scratch}/in")
    for name, text in (("a", "person_given,person_family,met_on\nAna,Ruiz,01/02/2020 00:00\n"),
                       ("b", "person_family,person_given,met_on\nLee,Bo,2020\n")):
        with open(f"{scratch}/in/{name}.csv", "w") as f:
            f.write(text)
    start_ingest(spark, f"{scratch}/in", f"{scratch}/model",
                 checkpoint_location=f"{scratch}/ck").awaitTermination()
    rejected = spark.read.parquet(f"{scratch}/model/_rejected").collect()
    assert [(r.column_name, r.raw_value) for r in rejected] == [("met_on", "2020")]
    assert '"person_given":"Bo"' in rejected[0].record


def test_a_batch_keeps_parquet_only(spark, scratch):
    """The parsed records, the rejected values and the new rows of a batch come
    from parquet: no uncompressed copy of the feed is checkpointed."""
    from unittest import mock

    from casetrace.sources.case_feed import to_feed_text
    from casetrace.streaming import append_batch
    from pyspark.sql.classic.dataframe import DataFrame
    text = to_feed_text(records(spark, {}, {"person_given": "Eva"}), original_header=False)
    rows, plain = [], DataFrame.checkpoint

    def seen(self, *args, **kw):
        rows.append(self.columns)
        return plain(self, *args, **kw)
    with mock.patch.object(DataFrame, "checkpoint", seen):
        assert append_batch(text, f"{scratch}/model", 0)["person"] == 2
    # the grid sizes of hot keys, of which there are none
    assert all({"rows", "columns"} <= set(c) for c in rows)
