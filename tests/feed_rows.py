"""Hand-made case records for the tests."""

from __future__ import annotations

import datetime as dt

from casetrace.schema import CASE_RECORDS_SCHEMA


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


BASE = {
    "person_given": "Ana", "person_family": "Ruiz", "person_address": "1 Main St",
    "suspected_on": d("2020-03-01"), "confirmed_on": d("2020-03-04"), "died_on": None,
    "person_status": "ill",
    "associate_given": "Bo", "associate_family": "Lee", "met_on": d("2020-01-01"),
    "contact_kind": "hug", "contact_from": d("2020-02-01"), "contact_to": d("2020-02-02"),
    "facility_name": "North", "facility_address": "5 Hill Rd",
    "stay_address": "Camp 1", "stay_from": d("2020-03-02"), "stay_to": d("2020-03-09"),
    "treatment": "Oxygen", "treatment_score": 7,
    "treated_from": d("2020-03-02"), "treated_to": d("2020-03-05"),
    "person_score": 6,
}


def records(spark, *rows: dict):
    """Case records: each row is BASE with the given overrides."""
    data = [tuple({**BASE, **r}[f.name] for f in CASE_RECORDS_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, CASE_RECORDS_SCHEMA)
