"""The physical plans have the shape the design relies on."""

from casetrace.plans import reports as R
from casetrace.plans.model import build_model
from casetrace.sources.fixtures import fixture_report
from casetrace.sources.tables import read_model, write_model

from feed_rows import records


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _model_on_disk(spark, scratch):
    m = build_model(records(spark, {}, {"person_given": "Eva", "facility_name": "South"}))
    write_model(m, f"{scratch}/model")
    return read_model(spark, f"{scratch}/model")


def test_top_k_without_full_sort(spark, scratch):
    m = _model_on_disk(spark, scratch)
    assert "TakeOrderedAndProject" in _plan(R.top_persons_by_treatment(m, "Oxygen", 5))


def test_filters_and_columns_reach_the_scan(spark, scratch):
    m = _model_on_disk(spark, scratch)
    plan = _plan(R.persons_by_treatment_score(m, "Oxygen", 5))
    assert "EqualTo(description,Oxygen)" in plan
    assert "GreaterThan(person_score,5)" in plan
    # the person scan reads only the three columns the report needs
    assert "ReadSchema: struct<person_id:bigint,given:string,family:string>" in plan


def test_no_cartesian_products(spark, scratch):
    m = _model_on_disk(spark, scratch)
    for name in R.REPORTS:
        plan = _plan(fixture_report(m, name))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_top_per_group_uses_window_group_limit(spark, scratch):
    m = _model_on_disk(spark, scratch)
    plan = R.common_contact_by_facility(m)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_semi_joins_for_in_and_distinct_products(spark, scratch):
    m = _model_on_disk(spark, scratch)
    assert "LeftSemi" in _plan(R.persons_with_n_treatments(m, 2))
    assert "LeftAnti" in _plan(R.persons_with_n_treatments_few_associates(m, 2, 2))
    assert "LeftSemi" in _plan(R.persons_by_location_and_treatment(m, "Camp 1", "Oxygen"))
