"""Normalising the case feed into the keyed model.

Each builder takes the staged feed (and the dimensions it needs), returns the
whole table (``existing`` rows first, unchanged) and is re-runnable: rows whose
insert key is already present are not added again (K2), new rows get ids after
the current maximum (K1).

How the work is laid out on the cluster:

* every builder de-duplicates its projection of the feed *before* any join
  (partial aggregation on the map side, so a key that holds a third of all
  rows still ships at most one row per map task);
* the person id is attached to the feed once (``write_keyed``: one join,
  written to the shared scratch folder) and that keyed table feeds B5, B6, B7
  and B9; only B8 looks persons up by (given, family);
* B9's "latest met-on date of the person" is a ``groupBy(person_id).max``
  joined to the distinct (associate, person) pairs, not a self-join of the
  feed;
* B7 and B8 de-duplicate before their fan-out joins (a treatment stored with
  several scores, persons sharing a name).  The remaining fan-out is what the
  model defines; a name shared by very many persons is split by counted pairs
  (``fanout_join``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casetrace.operators.joins import fanout_join
from casetrace.operators.keys import append_new, lookup_id, written
from casetrace.operators.quality import assert_valid
from casetrace.schema import ID_COLUMN, ID_ORDER, INSERT_KEY, MODEL_SCHEMAS
from casetrace.session import drop_scratch, scratch_path

PERSON_KEY = {"person_given": "given", "person_family": "family",
              "person_address": "address"}
PERSON_NAME = {"person_given": "given", "person_family": "family"}
ASSOCIATE_KEY = {"associate_given": "given", "associate_family": "family"}
FACILITY_KEY = {"facility_name": "name", "facility_address": "address"}


@dataclass
class Model:
    person: DataFrame
    associate: DataFrame
    facility: DataFrame
    treatment: DataFrame
    person_facility: DataFrame
    person_stay: DataFrame
    person_treatment: DataFrame
    contact: DataFrame
    acquaintance: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def _finish(table: str, existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """K2 + K1 for one table, columns in model order."""
    out = append_new(existing, incoming, INSERT_KEY[table], ID_ORDER[table], ID_COLUMN[table])
    return out.select(*[F.col(f.name).cast(f.dataType) for f in MODEL_SCHEMAS[table].fields])


def _not_null(*cols: str):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


# -- dimensions ---------------------------------------------------------------

def build_associate(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """B1: distinct (given, family), both present."""
    incoming = (staging.where(_not_null("associate_given", "associate_family"))
                .select(F.col("associate_given").alias("given"),
                        F.col("associate_family").alias("family"))
                .distinct())
    return _finish("associate", existing, incoming)


def build_person(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """B2: distinct persons over all seven attributes (date of death may be
    missing).  Variants of one (given, family, address) are all inserted on a
    first load; on later loads any variant of a present address is skipped."""
    incoming = (staging.where(_not_null("person_given", "person_family", "person_address",
                                        "person_status", "suspected_on", "confirmed_on"))
                .select(F.col("person_given").alias("given"),
                        F.col("person_family").alias("family"),
                        F.col("person_address").alias("address"),
                        F.col("person_status").alias("status"),
                        "suspected_on", "confirmed_on", "died_on")
                .distinct())
    return _finish("person", existing, incoming)


def build_facility(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct (name, address); on later loads a known *name* blocks any
    new address for it."""
    incoming = (staging.where(_not_null("facility_name", "facility_address"))
                .select(F.col("facility_name").alias("name"),
                        F.col("facility_address").alias("address"))
                .distinct())
    return _finish("facility", existing, incoming)


def build_treatment(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct (description, score)."""
    incoming = (staging.where(_not_null("treatment", "treatment_score"))
                .select(F.col("treatment").alias("description"),
                        F.col("treatment_score").alias("score"))
                .distinct())
    return _finish("treatment", existing, incoming)


# -- the feed keyed by person ---------------------------------------------------

KEYED_COLUMNS = [
    "facility_name", "facility_address", "stay_address", "stay_from", "stay_to",
    "treatment", "person_score", "treated_from", "treated_to",
    "associate_given", "associate_family", "met_on",
]


def attach_person(staging: DataFrame, person: DataFrame) -> DataFrame:
    """K3 once for all person-keyed builders: the feed columns they read plus
    ``person_id``.  A (given, family, address) stored as several person
    variants matches each of them, as the model defines.  Every builder takes
    a distinct projection or a maximum of the result, so repeated records may
    stay or go."""
    feed = staging.select(*PERSON_KEY, *KEYED_COLUMNS)
    keyed = lookup_id(feed, person, PERSON_KEY, "person_id", split_hot=True, repeats=False)
    return keyed.drop(*PERSON_KEY)


def write_keyed(staging: DataFrame, person: DataFrame, path: str | None = None) -> DataFrame:
    """``attach_person`` written once as parquet in the shared scratch folder
    and read back: four builders scan it, each reading only its columns, and a
    lost executor costs nothing to recompute."""
    spark = staging.sparkSession
    path = path or scratch_path(spark, "keyed")
    attach_person(staging, person).write.mode("overwrite").option(
        "compression", "zstd").parquet(path)
    return spark.read.parquet(path)


# -- bridges ------------------------------------------------------------------

def build_person_facility(keyed: DataFrame, facility: DataFrame,
                          existing: DataFrame | None = None) -> DataFrame:
    """One row per (facility, person) seen in the feed."""
    visits = keyed.select("person_id", *FACILITY_KEY).distinct()
    incoming = (lookup_id(visits, facility, FACILITY_KEY, "facility_id")
                .select("facility_id", "person_id"))
    return _finish("person_facility", existing, incoming)


def build_person_stay(keyed: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct (address, from, to, person), all present."""
    incoming = (keyed.where(_not_null("stay_address", "stay_from", "stay_to"))
                .select(F.col("stay_address").alias("address"), "stay_from", "stay_to",
                        "person_id")
                .distinct())
    return _finish("person_stay", existing, incoming)


def build_person_treatment(keyed: DataFrame, treatment: DataFrame,
                           existing: DataFrame | None = None, screen=None) -> DataFrame:
    """Treatment matched on its description only, so a description stored
    with k scores gives k rows.  De-duplicated first, then fanned out; the
    fan-out cannot create duplicates because the treatment ids differ."""
    given = (keyed.select("person_id", "treatment", "person_score", "treated_from",
                          "treated_to")
             .where(F.col("treatment").isNotNull())
             .distinct())
    incoming = (lookup_id(given, treatment, {"treatment": "description"}, "treatment_id")
                .select("person_id", "treatment_id", "person_score", "treated_from",
                        "treated_to"))
    if screen is not None:
        incoming = screen("person_treatment", incoming)
    return _finish("person_treatment", existing, incoming)


def contact_rows(staging: DataFrame, person: DataFrame, associate: DataFrame,
                 path: str | None = None) -> DataFrame:
    """B8 before numbering: distinct (kind, from, to, associate) per recorded
    name, then fanned out to every person with that (given, family).  The rows
    before that are kept in ``path``, a scratch folder of their own otherwise."""
    seen = (staging.where(_not_null("contact_kind", "contact_from", "contact_to"))
            .select(*PERSON_NAME, *ASSOCIATE_KEY,
                    F.col("contact_kind").alias("kind"), "contact_from", "contact_to")
            .distinct())
    # read by the count of its names and by the join
    by_associate = written(lookup_id(seen, associate, ASSOCIATE_KEY, "associate_id")
                           .drop(*ASSOCIATE_KEY), "contacts", path)
    persons = person.select("person_id", *[F.col(d).alias(s) for s, d in PERSON_NAME.items()])
    return (fanout_join(by_associate, persons, list(PERSON_NAME))
            .select("kind", "contact_from", "contact_to", "associate_id", "person_id"))


def build_contact(staging: DataFrame, person: DataFrame, associate: DataFrame,
                  existing: DataFrame | None = None) -> DataFrame:
    """A contact is attributed to every person sharing the recorded
    (given, family) - not only the one at the recorded address.  A name held
    by very many persons makes both join sides hot; ``fanout_join`` cuts its
    pairs into cells whatever the session's settings (tests/test_skew.py)."""
    spark = staging.sparkSession
    path = scratch_path(spark, "contacts")
    contact = _finish("contact", existing, contact_rows(staging, person, associate, path))
    drop_scratch(spark, path)  # the numbered rows are stored
    return contact


def acquaintance_rows(keyed: DataFrame, associate: DataFrame) -> DataFrame:
    """B9 before numbering: distinct (associate, person) pairs joined to the
    person's latest met-on date over all of its feed rows."""
    pairs = (lookup_id(keyed.select("person_id", *ASSOCIATE_KEY).distinct(),
                       associate, ASSOCIATE_KEY, "associate_id")
             .select("associate_id", "person_id"))
    latest = keyed.groupBy("person_id").agg(F.max("met_on").alias("met_on"))
    return pairs.join(latest, "person_id").select("met_on", "associate_id", "person_id")


def build_acquaintance(keyed: DataFrame, associate: DataFrame,
                       existing: DataFrame | None = None, screen=None) -> DataFrame:
    """One row per (associate, person); its date is the latest met-on
    date over *all* feed rows of the person, not only that associate's."""
    incoming = acquaintance_rows(keyed, associate)
    if screen is not None:
        incoming = screen("acquaintance", incoming)
    return _finish("acquaintance", existing, incoming)


# -- the whole model ----------------------------------------------------------

NULL_MODES = ("report", "drop", "fail")


def drop_null_rows(table: str, df: DataFrame) -> DataFrame:
    """Rows of ``table`` with a NULL in a NOT NULL column left out."""
    required = [f.name for f in MODEL_SCHEMAS[table].fields
                if not f.nullable and f.name != ID_COLUMN[table]]
    return df.where(_not_null(*required))


def build_model(staging: DataFrame, existing: Model | None = None,
                on_null: str = "report", parallel: int = 4) -> Model:
    """Route ``/build``: B1-B9 in dependency order.

    Dimensions are numbered (and checkpointed inside K1) before anything joins
    to them.  The person-keyed feed is written once to the shared scratch
    folder for the four builders that read it.  Builders that do not depend
    on each other are submitted concurrently (``parallel`` threads): B1-B4,
    then B5-B9 as soon as their inputs exist - Spark runs jobs from several
    threads side by side.

    ``on_null`` decides what happens to bridge rows that would break a NOT
    NULL rule (a treatment row without dates, a person without any met-on
    date): keep them and let ``violations`` report them (``"report"``), leave
    them out before they are numbered (``"drop"``), or raise ``ModelError``
    before anything is written (``"fail"``, the original all-or-nothing
    statement).
    """
    if on_null not in NULL_MODES:
        raise ValueError(f"on_null must be one of {NULL_MODES}, not {on_null!r}")
    old = existing.tables() if existing is not None else {}
    screen = (lambda t, df: drop_null_rows(t, df)) if on_null == "drop" else (lambda t, df: df)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        person_f = pool.submit(build_person, staging, old.get("person"))
        associate_f = pool.submit(build_associate, staging, old.get("associate"))
        facility_f = pool.submit(build_facility, staging, old.get("facility"))
        treatment_f = pool.submit(build_treatment, staging, old.get("treatment"))
        person = person_f.result()
        associate = associate_f.result()
        contact_f = pool.submit(build_contact, staging, person, associate, old.get("contact"))
        keyed_path = scratch_path(staging.sparkSession, "keyed")
        keyed = write_keyed(staging, person, keyed_path)
        acquaintance_f = pool.submit(build_acquaintance, keyed, associate,
                                     old.get("acquaintance"), screen)
        stay_f = pool.submit(build_person_stay, keyed, old.get("person_stay"))
        facility = facility_f.result()
        visits_f = pool.submit(build_person_facility, keyed, facility,
                               old.get("person_facility"))
        treatment = treatment_f.result()
        treated_f = pool.submit(build_person_treatment, keyed, treatment,
                                old.get("person_treatment"), screen)
        model = Model(
            person=person,
            associate=associate,
            facility=facility,
            treatment=treatment,
            person_facility=visits_f.result(),
            person_stay=stay_f.result(),
            person_treatment=treated_f.result(),
            contact=contact_f.result(),
            acquaintance=acquaintance_f.result(),
        )
    # all tables are numbered, and with that stored
    drop_scratch(staging.sparkSession, keyed_path)
    if on_null == "fail":
        assert_valid(model)
    return model
