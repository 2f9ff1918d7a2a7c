import pytest

from casetrace.plans.model import build_model
from casetrace.operators.quality import append_violations, violations
from casetrace.sources import tables
from casetrace.sources.case_feed import stage
from casetrace.sources.tables import (append_model, drop_model, drop_model_folder,
                                      drop_old_versions, drop_staged_folder, drop_staging,
                                      load_model, published, read_model, register_staging,
                                      save_model, write_model)
from casetrace.operators.quality import ModelError

from feed_rows import records


def _feed(spark):
    return records(spark, {}, {"person_given": "Eva", "facility_name": "South"},
                   {"person_given": "Ivo", "treatment": "Rest"})


def test_parquet_round_trip(spark, scratch):
    m = build_model(_feed(spark))
    write_model(m, f"{scratch}/model", validate=True)
    back = read_model(spark, f"{scratch}/model")
    for name, df in m.tables().items():
        got = back.tables()[name]
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in df.schema], name
        assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect())), name


def test_validate_refuses_to_write_a_broken_model(spark, scratch):
    m = build_model(records(spark, {"treated_from": None}))
    with pytest.raises(ModelError):
        write_model(m, f"{scratch}/model", validate=True)


def test_catalog_tables_bucketed_by_person(spark):
    m = build_model(_feed(spark))
    save_model(m, "ct_test", buckets=4)
    back = load_model(spark, "ct_test")
    assert back.person.count() == 3
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        joined = back.person_treatment.join(back.person, "person_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "Exchange hashpartitioning(person_id" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old_aqe)
    drop_model(spark, "ct_test")
    assert not spark.catalog.tableExists("ct_test.person")
    drop_model(spark, "ct_test")  # dropping again is fine


def test_drop_staging_view(spark):
    register_staging(_feed(spark), "case_records_t")
    assert spark.catalog.tableExists("case_records_t")
    drop_staging(spark, "case_records_t")
    assert not spark.catalog.tableExists("case_records_t")
    drop_staging(spark, "case_records_t")


def test_on_null_modes(spark):
    feed = records(spark, {"treated_to": None}, {"person_given": "Eva"})
    assert build_model(feed, on_null="report").person_treatment.count() == 2
    assert build_model(feed, on_null="drop").person_treatment.count() == 1
    with pytest.raises(ModelError):
        build_model(feed, on_null="fail")


def test_append_in_place_and_refused_overwrite(spark, scratch):
    import pytest
    from casetrace.plans.model import build_model
    from casetrace.sources.tables import append_model, read_model, write_model
    from feed_rows import records
    write_model(build_model(records(spark, {}, {"person_given": "Bea"})), f"{scratch}/m")
    stored = read_model(spark, f"{scratch}/m")
    model = build_model(records(spark, {}, {"person_given": "Eva"}), existing=stored)
    with pytest.raises(ValueError):
        write_model(model, f"{scratch}/m")
    assert append_model(model, stored, f"{scratch}/m")["person"] == 1
    got = read_model(spark, f"{scratch}/m").person.collect()
    assert sorted((r.person_id, r.given) for r in got) == [(1, "Ana"), (2, "Bea"), (3, "Eva")]


def _rows(model):
    return {name: sorted(map(repr, df.collect())) for name, df in model.tables().items()}


def _stop_after(monkeypatch, spark, n):
    """Table writes into a model folder fail after the ``n``-th."""
    real, left = tables._write_tables, [n]

    def some(held, path, parallel):
        for name in list(held)[:left[0]]:
            real({name: held[name]}, path, 1)
        raise OSError("executor lost")
    monkeypatch.setattr(tables, "_write_tables", some)


@pytest.mark.parametrize("written", [0, 4, 9])
def test_a_write_that_stops_between_tables_leaves_the_old_model(spark, scratch, monkeypatch, written):
    path = f"{scratch}/m"
    write_model(build_model(_feed(spark)), path)
    before, old = _rows(read_model(spark, path)), read_model(spark, path)
    more = build_model(records(spark, {"person_given": "Zoe", "facility_name": "East"}), existing=old)
    _stop_after(monkeypatch, spark, written)
    with pytest.raises(OSError):
        append_model(more, old, path)
    with pytest.raises(OSError):
        write_model(build_model(records(spark, {"person_given": "Other"})), path)
    assert _rows(read_model(spark, path)) == before and published(spark, path)[0] == 1
    monkeypatch.undo()
    # what the stopped writes left goes, the model stays; then the append goes through
    assert len(drop_old_versions(spark, path)) == (0 if written == 0 else written + _new_tables(written))
    assert _rows(read_model(spark, path)) == before
    assert append_model(more, old, path)["person"] == 1
    assert published(spark, path)[0] == 2
    assert read_model(spark, path).person.count() == 4


def _new_tables(written):
    """Tables among the first ``written`` to which the append has rows to add."""
    return min(written, 7)


def test_overwrite_publishes_and_old_versions_go(spark, scratch):
    path = f"{scratch}/m"
    write_model(build_model(_feed(spark)), path)
    write_model(build_model(records(spark, {"person_given": "Solo"})), path)
    assert [r.given for r in read_model(spark, path).person.collect()] == ["Solo"]
    assert len(drop_old_versions(spark, path)) == 9 and drop_old_versions(spark, path) == []
    assert read_model(spark, path).person.count() == 1
    with pytest.raises(ValueError):
        write_model(build_model(_feed(spark)), path, mode="error")


def test_folder_model_and_staged_folder_are_dropped_and_foreign_folders_refused(spark, scratch):
    path = f"{scratch}/m"
    write_model(build_model(_feed(spark)), path)
    spark.range(3).write.parquet(f"{path}/notes")
    assert drop_model_folder(spark, path)
    assert not drop_model_folder(spark, path)
    assert spark.read.parquet(f"{path}/notes").count() == 3
    import os
    assert os.listdir(path) == ["notes"]
    assert not drop_model_folder(spark, f"{scratch}/absent")
    stage(_feed(spark), f"{scratch}/staged")
    assert drop_staged_folder(spark, f"{scratch}/staged")
    assert not drop_staged_folder(spark, f"{scratch}/staged")
    with pytest.raises(ValueError):
        drop_staged_folder(spark, f"{path}/notes")


def test_model_without_manifest_is_read_and_appended(spark, scratch):
    path = f"{scratch}/m"
    for name, df in build_model(_feed(spark)).tables().items():
        df.write.parquet(f"{path}/{name}")
    old = read_model(spark, path)
    more = build_model(records(spark, {"person_given": "Zoe"}), existing=old)
    assert append_model(more, old, path, validate=True)["person"] == 1
    assert read_model(spark, path).person.count() == 4
    assert drop_old_versions(spark, path) == []


def test_checks_of_an_append_equal_those_of_the_union(spark):
    from pyspark.sql import functions as F
    from casetrace.plans.model import Model
    old = build_model(_feed(spark))
    new = build_model(records(spark, {"person_given": "Zoe", "facility_name": "East"}, {"treatment": "Rest"},
                              {"person_given": "Eva", "person_status": "well"}), existing=old)
    added = {n: df.join(old.tables()[n].select(df.columns[0]), df.columns[0], "left_anti")
             for n, df in new.tables().items()}

    def broken(name, **columns):
        return {**added, name: added[name].unionByName(
            (added[name] if added[name].count() else old.tables()[name]).limit(1).withColumns(
                {c: v for c, v in columns.items()}).select(*added[name].columns))}

    every = {**added, **{name: broken(name, **columns)[name] for name, columns in {
        "person": {"person_id": F.lit(1).cast("long")}, "associate": {},
        "contact": {"id": F.lit(99).cast("long"), "person_id": F.lit(10 ** 9).cast("long")},
        "person_stay": {"id": F.lit(99).cast("long"), "stay_from": F.lit(None).cast("date")},
        "facility": {"facility_id": F.lit(98).cast("long"), "address": F.lit("y" * 300)}}.items()}}
    cases = [added, every]
    for fresh in cases:
        union = Model(**{n: old.tables()[n].unionByName(df) for n, df in fresh.items()})
        assert (sorted(map(tuple, append_violations(fresh, old.tables()).collect()))
                == sorted(map(tuple, violations(union).collect())))


def test_rows_and_count_in_one_run(spark, scratch):
    from casetrace.plans.reports import facility_share, rows_with_count, write_with_count
    report = facility_share(build_model(_feed(spark)))
    shown = []
    assert rows_with_count(report, shown.append) == len(shown) == 2
    assert write_with_count(report, f"{scratch}/out") == 2
    assert spark.read.parquet(f"{scratch}/out").count() == 2
