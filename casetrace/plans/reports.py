"""Parameterised reports over the model.

Literals of the original reports are required parameters (the original's own
literals are in ``ORIGINAL_PARAMETERS``); thresholds default to its numbers.
Every report returns a lazy DataFrame.

Shapes used throughout: aggregate the big bridge table on its key *before*
joining the dimension (the join then sees one row per group); use semi/anti
joins where the original used IN / NOT EXISTS / DISTINCT over a product; skip
joins that are pure foreign-key lookups whose columns are not used (the
model's FK checks guarantee they are lossless); give every sort a total order
so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, Row, Window
from pyspark.sql import functions as F

from casetrace.functions.numbers import exact_percent
from casetrace.functions.predicates import is_deceased
from casetrace.plans.model import Model

# The literals of the original reports.
ORIGINAL_PARAMETERS = {
    "deceased_status": "Muerte",
    "suspended_status": "Suspendida",
    "contact_kind": "Beso",
    "score_treatment": "Transfusiones de sangre",
    "top_treatment": "Oxigeno",
    "stay_address": "1987 Delphine Well",
    "stay_treatment": "Manejo de la presion arterial",
}


def _treatment_ids(m: Model, description: str) -> DataFrame:
    return m.treatment.where(F.col("description") == description).select("treatment_id")


def deaths_by_facility(m: Model, status: str) -> DataFrame:
    """Per facility, persons who died (by status or date).  Facilities
    with visits but no deaths show 0; a person counts once per facility."""
    dead = m.person.select("person_id", is_deceased(status).alias("dead"))
    per_facility = (m.person_facility.join(dead, "person_id")
                    .groupBy("facility_id")
                    .agg(F.count(F.when(F.col("dead"), 1)).alias("deaths")))
    return (per_facility.join(m.facility, "facility_id")
            .select("name", "address", "deaths")
            .orderBy("name", "address"))


def persons_by_treatment_score(m: Model, description: str,
                               min_score: int = 5) -> DataFrame:
    """R2: distinct (given, family) of persons whose own score for the
    treatment is above ``min_score``."""
    treated = (m.person_treatment.where(F.col("person_score") > min_score)
               .join(_treatment_ids(m, description), "treatment_id", "left_semi")
               .select("person_id").distinct())
    return (m.person.join(treated, "person_id", "left_semi")
            .select("given", "family").distinct()
            .orderBy("given", "family"))


def deceased_with_many_associates(m: Model, status: str,
                                  min_associates: int = 3) -> DataFrame:
    """Deceased persons known to more than ``min_associates`` associates;
    distinct (given, family, address)."""
    many = (m.acquaintance.groupBy("person_id")
            .agg(F.count("associate_id").alias("n"))
            .where(F.col("n") > min_associates))
    return (m.person.where(is_deceased(status))
            .join(many, "person_id", "left_semi")
            .select("given", "family", "address").distinct()
            .orderBy("given", "family", "address"))


def contacts_by_kind(m: Model, status: str,
                     kind: str,
                     min_associates: int = 2) -> DataFrame:
    """Persons with ``status`` who had a ``kind`` contact with more than
    ``min_associates`` distinct associates; distinct (given, family)."""
    busy = (m.contact.where(F.col("kind") == kind)
            .groupBy("person_id")
            .agg(F.countDistinct("associate_id").alias("n"))
            .where(F.col("n") > min_associates))
    return (m.person.where(F.col("status") == status)
            .join(busy, "person_id", "left_semi")
            .select("given", "family").distinct())


def top_persons_by_treatment(m: Model, description: str,
                             k: int = 5) -> DataFrame:
    """The ``k`` persons with most rows of one treatment (top-k: each
    task keeps its best ``k``, the driver merges ``k`` per task)."""
    counts = (m.person_treatment.join(_treatment_ids(m, description), "treatment_id", "left_semi")
              .groupBy("person_id").agg(F.count(F.lit(1)).alias("n")))
    return (counts.join(m.person, "person_id")
            .select("given", "family", "address", "n")
            .orderBy(F.desc("n"), "given", "family", "address")
            .limit(k))


def persons_by_location_and_treatment(
        m: Model, address: str,
        description: str) -> DataFrame:
    """Persons who stayed at ``address`` and received ``description``;
    distinct (given, family, died_on).  Two semi joins instead of the
    stay x treatment product per person; their right sides are distinct
    person ids (map-side combine), so a person with very many rows does not
    make one task hold them all."""
    stayed = m.person_stay.where(F.col("address") == address).select("person_id").distinct()
    treated = (m.person_treatment.join(_treatment_ids(m, description), "treatment_id", "left_semi")
               .select("person_id").distinct())
    return (m.person.join(stayed, "person_id", "left_semi")
            .join(treated, "person_id", "left_semi")
            .select("given", "family", "died_on").distinct()
            .orderBy("given", "family", F.col("died_on").asc_nulls_last()))


def _with_n_treatment_rows(m: Model, n: int) -> DataFrame:
    return (m.person_treatment.groupBy("person_id")
            .agg(F.count("treatment_id").alias("n"))
            .where(F.col("n") == n)
            .select("person_id"))


def persons_with_n_treatments(m: Model, n: int = 2) -> DataFrame:
    """Persons with exactly ``n`` treatment rows (rows, not distinct
    treatments); one output row per person, no order."""
    return (m.person.join(_with_n_treatment_rows(m, n), "person_id", "left_semi")
            .select("given", "family", "address"))


def persons_with_n_treatments_few_associates(m: Model, n: int = 2,
                                             max_associates: int = 2) -> DataFrame:
    """R7a and fewer than ``max_associates`` acquaintances (persons with
    none included)."""
    crowded = (m.acquaintance.groupBy("person_id")
               .agg(F.count("associate_id").alias("k"))
               .where(F.col("k") >= max_associates)
               .select("person_id"))
    return (m.person.join(_with_n_treatment_rows(m, n), "person_id", "left_semi")
            .join(crowded, "person_id", "left_anti")
            .select("given", "family", "address")
            .orderBy("given", "family", "address"))


def extremes_by_month(m: Model, k: int = 10) -> DataFrame:
    """Treatment rows per (month of suspicion, given, family) - persons
    sharing a name and month merge, years are ignored - the ``k`` largest
    followed by the ``k`` smallest groups (a group can be in both).

    Rows are counted per person first, so the join to ``person`` sees one
    row per treated person instead of one per treatment row.
    """
    per_person = m.person_treatment.groupBy("person_id").agg(F.count(F.lit(1)).alias("rows"))
    groups = (per_person
              .join(m.person.select("person_id", "given", "family",
                                    F.month("suspected_on").alias("month")), "person_id")
              .groupBy("month", "given", "family")
              .agg(F.sum("rows").cast("long").alias("n")))
    cols = ["month", "given", "family", "n"]
    top = groups.orderBy(F.desc("n"), "month", "given", "family").limit(k).select(*cols)
    bottom = groups.orderBy(F.asc("n"), "month", "given", "family").limit(k).select(*cols)
    return top.unionAll(bottom)


def facility_share(m: Model) -> DataFrame:
    """Visits per facility and their share of all visits, in percent
    rounded half-up to 2 decimals."""
    per_facility = (m.person_facility.groupBy("facility_id")
                    .agg(F.count("person_id").alias("n")))
    total = per_facility.agg(F.sum("n")).scalar()
    return (per_facility.join(m.facility, "facility_id")
            .select("name", "address", "n", exact_percent(F.col("n"), total).alias("pct"))
            .orderBy(F.desc("pct"), "name", "address"))


def last_facility(m: Model) -> DataFrame:
    """Each person's facility with the largest id."""
    return m.person_facility.groupBy("person_id").agg(F.max("facility_id").alias("facility_id"))


def top_contact_kind(m: Model) -> DataFrame:
    """Each person's contact kind that sorts last (binary order).

    The distinct (person, kind) pairs are a hash aggregate that combines on
    the map side, so the string maximum sorts only those few."""
    return (m.contact.select("person_id", "kind").distinct()
            .groupBy("person_id").agg(F.max("kind").alias("kind")))


def common_contact_by_facility(m: Model) -> DataFrame:
    """Per facility, the most common contact kind among the persons for
    whom it is the last facility, as a share of *all* the facility's visits.

    All inputs are per-person aggregates joined on ``person_id`` (co-
    partitioned), then per-(facility, kind) counts: small.  The denominator is
    a second aggregate joined on the facility, not a correlated subquery.
    """
    per_kind = (last_facility(m).join(top_contact_kind(m), "person_id")
                .groupBy("facility_id", "kind").agg(F.count(F.lit(1)).alias("n")))
    visits = m.person_facility.groupBy("facility_id").agg(F.count(F.lit(1)).alias("visits"))
    best = Window.partitionBy("facility_id").orderBy(F.desc("n"), F.asc("kind"))
    winners = (per_kind.withColumn("rn", F.row_number().over(best))
               .where(F.col("rn") == 1))
    return (winners.join(visits, "facility_id").join(m.facility, "facility_id")
            .select("name", "address", "kind",
                    exact_percent(F.col("n"), F.col("visits")).alias("pct"))
            .orderBy(F.desc("pct"), "name", "address"))


def write_with_count(df: DataFrame, path: str) -> int:
    """Result rows written to ``path`` and their number, in one run: rows
    are counted as they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"]


def rows_with_count(df: DataFrame, show: Callable[[Row], None]) -> int:
    """Every result row given to ``show``, a partition at a time, and their
    number, in one run."""
    n = 0
    for row in df.toLocalIterator():
        show(row)
        n += 1
    return n


def original_report(m: Model, name: str) -> DataFrame:
    """Report ``name`` ("r1" ... "r10", "r7a", "r7b") with the original
    program's own literals and thresholds."""
    p = ORIGINAL_PARAMETERS
    calls = {
        "r1": lambda: deaths_by_facility(m, p["deceased_status"]),
        "r2": lambda: persons_by_treatment_score(m, p["score_treatment"], 5),
        "r3": lambda: deceased_with_many_associates(m, p["deceased_status"], 3),
        "r4": lambda: contacts_by_kind(m, p["suspended_status"], p["contact_kind"], 2),
        "r5": lambda: top_persons_by_treatment(m, p["top_treatment"], 5),
        "r6": lambda: persons_by_location_and_treatment(m, p["stay_address"],
                                                        p["stay_treatment"]),
        "r7a": lambda: persons_with_n_treatments(m, 2),
        "r7b": lambda: persons_with_n_treatments_few_associates(m, 2, 2),
        "r8": lambda: extremes_by_month(m, 10),
        "r9": lambda: facility_share(m),
        "r10": lambda: common_contact_by_facility(m),
    }
    return calls[name]()


REPORTS = {
    "r1": deaths_by_facility,
    "r2": persons_by_treatment_score,
    "r3": deceased_with_many_associates,
    "r4": contacts_by_kind,
    "r5": top_persons_by_treatment,
    "r6": persons_by_location_and_treatment,
    "r7a": persons_with_n_treatments,
    "r7b": persons_with_n_treatments_few_associates,
    "r8": extremes_by_month,
    "r9": facility_share,
    "r10": common_contact_by_facility,
}
