import pytest

from casetrace.operators.quality import ModelError, assert_valid, violations
from casetrace.plans.model import build_model

from feed_rows import d, records


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def check(model, rule, table):
    return {(r.column_name): r.n for r in violations(model).collect()
            if r.rule == rule and r.table_name == table}


def test_person_variant_gives_two_persons_and_doubles_bridges(spark):
    m = build_model(records(spark, {"person_status": "ill"}, {"person_status": "dead"}))
    assert m.person.count() == 2
    assert m.person_facility.count() == 2
    assert m.person_stay.count() == 2
    assert check(m, "natural_key", "person") == {"given,family,address": 1}
    assert_valid(m)  # natural-key duplicates are informational


def test_facility_two_addresses_then_append_skips_new_address(spark):
    first = records(spark, {"facility_address": "A"}, {"facility_address": "B"})
    m = build_model(first)
    assert rows(m.facility, "facility_id", "name", "address") == [
        (1, "North", "A"), (2, "North", "B")]
    m2 = build_model(records(spark, {"facility_address": "C"}), existing=m)
    assert rows(m2.facility, "facility_id", "address") == [(1, "A"), (2, "B")]


def test_treatment_two_scores_doubles_person_treatment(spark):
    m = build_model(records(spark, {"treatment_score": 1}, {"treatment_score": 2}))
    assert m.treatment.count() == 2
    assert rows(m.person_treatment, "treatment_id", "person_score") == [(1, 6), (2, 6)]


def test_homonyms_each_get_the_contact(spark):
    m = build_model(records(spark, {"person_address": "X"},
                            {"person_address": "Y", "contact_kind": None}))
    assert m.person.count() == 2
    assert m.contact.count() == 2
    assert rows(m.contact, "person_id") == [(1,), (2,)]


def test_met_on_is_latest_over_all_rows_of_the_person(spark):
    m = build_model(records(
        spark,
        {"associate_given": "X", "met_on": d("2020-01-01")},
        {"associate_given": "Y", "met_on": d("2020-02-01")},
        {"associate_given": None, "met_on": d("2020-03-01")}))
    assert rows(m.acquaintance, "associate_id", "met_on") == [
        (1, d("2020-03-01")), (2, d("2020-03-01"))]


def test_null_treatment_date_is_a_not_null_violation(spark):
    m = build_model(records(spark, {"treated_to": None}))
    assert check(m, "not_null", "person_treatment")["treated_to"] == 1
    with pytest.raises(ModelError):
        assert_valid(m)


def test_rerun_adds_nothing_and_keeps_ids(spark):
    feed = records(spark, {}, {"person_given": "Eva", "associate_given": "Cy"},
                   {"person_address": "2 Side St", "treatment": "Rest"})
    m1 = build_model(feed)
    m2 = build_model(feed, existing=m1)
    for name, df in m1.tables().items():
        assert (sorted(map(repr, df.collect()))
                == sorted(map(repr, m2.tables()[name].collect()))), name


def test_append_continues_ids(spark):
    m1 = build_model(records(spark, {"person_given": "B"}))
    m2 = build_model(records(spark, {"person_given": "A"}), existing=m1)
    assert rows(m2.person, "person_id", "given") == [(1, "B"), (2, "A")]
    assert rows(m2.person_facility, "id", "person_id") == [(1, 1), (2, 2)]


def test_all_constraints_hold_on_a_clean_feed(spark):
    m = build_model(records(spark, {}, {"person_given": "Eva"}))
    bad = [r for r in violations(m).collect() if r.n > 0]
    assert bad == []
    assert_valid(m)


def test_long_facility_name_is_reported(spark):
    m = build_model(records(spark, {"facility_name": "N" * 60}))
    assert check(m, "max_length", "facility")["name"] == 1


def test_long_keys_are_compared_whole_but_grouped_short(spark):
    from pyspark.sql import functions as F
    from casetrace.operators.quality import KEY_BYTES, foreign_key_check, short_key, unique_check
    long = "x" * 3000
    keys = [(long, "a"), (long, "a"), (long + "y", "a"), (long, None), (long, None), (long, ""),
            ("é" * 100, "b"), ("é" * 100, "b"), (None, long), (None, long), (None, None), (None, None),
            ("12:a", "1:b"), ("s", "t"), ("s", "t"), (long + "1:", "a"), (long, "1:a")]
    df = spark.createDataFrame(keys, "given string, family string")
    plain = df.groupBy("given", "family").count().where("count > 1").count()
    assert unique_check("associate", df, ["given", "family"], "natural_key").first()["n"] == plain == 6
    held = df.select(*short_key(df, ["given", "family"]))
    assert held.select(F.max(sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in held.columns))).first()[0] <= KEY_BYTES
    # orphans are counted per key before the join, and by rows
    child = spark.createDataFrame([(1,), (2,), (2,), (9,), (None,)], "person_id long")
    assert foreign_key_check("contact", child, "person_id", spark.range(2), "id").first()["n"] == 3
    assert foreign_key_check("contact", child, "person_id", spark.range(10), "id").first()["n"] == 0
