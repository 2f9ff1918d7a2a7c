"""New rows go to the model without a copy beside it, and what only the builders
read is removed after them."""

import os

import pytest

from casetrace.operators.quality import ModelError
from casetrace.plans.model import build_model
from casetrace.session import ensure_checkpoint_dir
from casetrace.sources.case_feed import clean_case_records, clean_once, to_feed_text
from casetrace.sources.tables import append_model, read_model, write_model
from casetrace.streaming import append_batch, read_appended_model

from feed_rows import records


def _scratch_tables(spark):
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(root) if n.startswith("casetrace-")}


def _versions(path):
    return {name: sorted(os.listdir(f"{path}/{name}")) for name in os.listdir(path) if name != "manifest"}


def test_build_keeps_only_numbered_tables(spark):
    before = _scratch_tables(spark)
    model = build_model(records(spark, {}, {"person_given": "Eva"}))
    left = {n.split("-")[1] for n in _scratch_tables(spark) - before}
    assert left == {"ordered"}
    assert [df.count() for df in model.tables().values()] == [2, 1, 1, 1, 2, 2, 2, 2, 2]


def test_append_copies_nothing_beside_the_model(spark, scratch):
    write_model(build_model(records(spark, {})), f"{scratch}/model")
    stored = read_model(spark, f"{scratch}/model")
    model = build_model(records(spark, {}, {"person_given": "Eva"}), existing=stored)
    before, held = _scratch_tables(spark), _versions(f"{scratch}/model")
    counts = append_model(model, stored, f"{scratch}/model", validate=True)
    assert _scratch_tables(spark) == before
    assert counts["person"] == 1 and counts["associate"] == 0
    now = _versions(f"{scratch}/model")
    assert now["associate"] == held["associate"] and len(now["person"]) == 2
    got = read_model(spark, f"{scratch}/model")
    assert sorted((r.person_id, r.given) for r in got.person.collect()) == [(1, "Ana"), (2, "Eva")]


def test_refused_append_leaves_no_folder(spark, scratch):
    write_model(build_model(records(spark, {})), f"{scratch}/model")
    stored, held = read_model(spark, f"{scratch}/model"), _versions(f"{scratch}/model")
    broken = build_model(records(spark, {"person_given": "Eva", "met_on": None}), existing=stored)
    with pytest.raises(ModelError):
        append_model(broken, stored, f"{scratch}/model", validate=True)
    assert _versions(f"{scratch}/model") == held


def test_stream_batch_copies_nothing_beside_the_model(spark, scratch):
    feed = [to_feed_text(records(spark, *rows), original_header=False)
            for rows in ([{}], [{}, {"person_given": "Eva"}])]
    before = _scratch_tables(spark)
    assert append_batch(feed[0], f"{scratch}/model", 0)["person"] == 1
    counts = append_batch(feed[1], f"{scratch}/model", 1)
    assert counts["person"] == 1 and counts["associate"] == 0
    assert {n.split("-")[1] for n in _scratch_tables(spark) - before} <= {"ordered", "judged"}
    got = read_appended_model(spark, f"{scratch}/model")
    assert sorted((r.person_id, r.given) for r in got.person.collect()) == [(1, "Ana"), (2, "Eva")]


def test_records_are_rejected_the_same_in_one_pass(spark):
    text = to_feed_text(records(spark, {}, {"person_given": "Eva"}), original_header=False)
    bad = text.withColumn("met_on", text.person_given).withColumn("person_score", text.person_family)
    for feed, n in ((text, 0), (bad, 4)):
        once, lazily = clean_once(feed), clean_case_records(feed)
        rows = sorted(map(tuple, once.rejected.collect()))
        assert rows == sorted(map(tuple, lazily.rejected.collect())) and len(rows) == n
        assert sorted(map(str, once.clean.collect())) == sorted(map(str, lazily.clean.collect()))
    assert {r[2] for r in rows} == {"date_form", "bad_number"} and '"met_on":"Ana"' in rows[0][3]
