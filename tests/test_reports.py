from casetrace.plans import reports as R
from casetrace.plans.model import build_model

from feed_rows import d, records


def test_r1_keeps_facility_without_deaths(spark):
    m = build_model(records(
        spark,
        {"facility_name": "A", "person_status": "dead"},
        {"facility_name": "B", "person_given": "Eva"},
        {"facility_name": "B", "person_given": "Ivo", "died_on": d("2020-05-01")}))
    got = [(r.name, r.deaths) for r in R.deaths_by_facility(m, "dead").collect()]
    assert got == [("A", 1), ("B", 1)]
    m2 = build_model(records(spark, {"facility_name": "C"}))
    assert [(r.name, r.deaths) for r in R.deaths_by_facility(m2, "dead").collect()] == [("C", 0)]


def test_r7b_includes_person_without_acquaintances(spark):
    m = build_model(records(
        spark,
        {"associate_given": None, "treatment": "T1"},
        {"associate_given": None, "treatment": "T2"}))
    assert [tuple(r) for r in R.persons_with_n_treatments(m, 2).collect()] == [
        ("Ana", "Ruiz", "1 Main St")]
    assert [tuple(r) for r in R.persons_with_n_treatments_few_associates(m, 2, 2).collect()] == [
        ("Ana", "Ruiz", "1 Main St")]


def test_r8_merges_homonyms_and_years_in_one_month(spark):
    m = build_model(records(
        spark,
        {"person_address": "X", "suspected_on": d("2020-03-01")},
        {"person_address": "Y", "suspected_on": d("2021-03-15")}))
    got = [tuple(r) for r in R.extremes_by_month(m, 10).collect()]
    assert got == [(3, "Ana", "Ruiz", 2), (3, "Ana", "Ruiz", 2)]


def test_r9_percent_is_exact(spark):
    feed = records(spark, *[{"person_given": f"P{i:03d}",
                             "facility_name": "A" if i < 23 else "B"} for i in range(160)])
    m = build_model(feed)
    got = {r.name: (r.n, r.pct) for r in R.facility_share(m).collect()}
    assert got == {"A": (23, 14.38), "B": (137, 85.63)}


def test_r10_base_is_all_visits_and_kind_ties_break_by_name(spark):
    m = build_model(records(
        spark,
        {"person_given": "P1", "facility_name": "A", "contact_kind": "x"},
        {"person_given": "P2", "facility_name": "A", "contact_kind": "y"},
        {"person_given": "P3", "facility_name": "A", "contact_kind": None},
        {"person_given": "P1", "facility_name": "B", "contact_kind": "x"}))
    got = [tuple(r) for r in R.common_contact_by_facility(m).collect()]
    # facility ids: A=1, B=2; P1's last facility is B.  A: P2 'y' (1 of 3
    # visits); B: P1 'x' (1 of 1 visit)
    assert got == [("B", "5 Hill Rd", "x", 100.0), ("A", "5 Hill Rd", "y", 33.33)]


def test_r5_top_k_orders_by_count_then_name(spark):
    feed = records(spark,
                   {"person_given": "Zed", "treatment": "Oxygen", "treated_to": d("2020-03-05")},
                   {"person_given": "Zed", "treatment": "Oxygen", "treated_to": d("2020-03-06")},
                   {"person_given": "Amy", "treatment": "Oxygen"},
                   {"person_given": "Bob", "treatment": "Oxygen"})
    m = build_model(feed)
    got = [(r.given, r.n) for r in R.top_persons_by_treatment(m, "Oxygen", 2).collect()]
    assert got == [("Zed", 2), ("Amy", 1)]


def test_r2_r3_r4_r6(spark):
    feed = records(
        spark,
        {"person_given": "A", "person_status": "dead", "associate_given": "a1",
         "contact_kind": "kiss", "person_score": 9, "stay_address": "Here"},
        {"person_given": "A", "person_status": "dead", "associate_given": "a2",
         "contact_kind": "kiss"},
        {"person_given": "A", "person_status": "dead", "associate_given": "a3",
         "contact_kind": "kiss"},
        {"person_given": "A", "person_status": "dead", "associate_given": "a4"},
        {"person_given": "B", "person_score": 2, "stay_address": "There"})
    m = build_model(feed)
    assert [tuple(r) for r in R.persons_by_treatment_score(m, "Oxygen", 5).collect()] == [
        ("A", "Ruiz")]
    assert [r.given for r in R.deceased_with_many_associates(m, "dead", 3).collect()] == ["A"]
    assert [r.given for r in R.contacts_by_kind(m, "dead", "kiss", 2).collect()] == ["A"]
    assert [r.given for r in R.persons_by_location_and_treatment(m, "Here", "Oxygen")
            .collect()] == ["A"]


def test_original_literals(spark):
    feed = records(
        spark,
        {"person_given": "A", "person_status": "Muerte", "contact_kind": "Beso",
         "treatment": "Oxigeno", "stay_address": "1987 Delphine Well"},
        {"person_given": "B", "person_status": "Suspendida", "contact_kind": "Beso",
         "treatment": "Manejo de la presion arterial", "stay_address": "1987 Delphine Well"})
    m = build_model(feed)
    r1 = [(r.name, r.deaths) for r in R.original_report(m, "r1").collect()]
    assert r1 == [("North", 1)]
    assert [r.given for r in R.original_report(m, "r5").collect()] == ["A"]
    assert [r.given for r in R.original_report(m, "r6").collect()] == ["B"]
    for name in R.REPORTS:
        R.original_report(m, name).collect()
