"""Schemas of the case-record feed and of the normalised model.

Everything here is declarative: column names, Spark types, the DDL length
limits and which natural key each table is de-duplicated and looked up by.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Staging feed (one row per observation).  Our English column names, in the
# order of the original staging table.
# ---------------------------------------------------------------------------

CASE_RECORD_COLUMNS: list[tuple[str, T.DataType]] = [
    ("person_given", T.StringType()),
    ("person_family", T.StringType()),
    ("person_address", T.StringType()),
    ("suspected_on", T.DateType()),
    ("confirmed_on", T.DateType()),
    ("died_on", T.DateType()),
    ("person_status", T.StringType()),
    ("associate_given", T.StringType()),
    ("associate_family", T.StringType()),
    ("met_on", T.DateType()),
    ("contact_kind", T.StringType()),
    ("contact_from", T.DateType()),
    ("contact_to", T.DateType()),
    ("facility_name", T.StringType()),
    ("facility_address", T.StringType()),
    ("stay_address", T.StringType()),
    ("stay_from", T.DateType()),
    ("stay_to", T.DateType()),
    ("treatment", T.StringType()),
    ("treatment_score", T.IntegerType()),
    ("treated_from", T.DateType()),
    ("treated_to", T.DateType()),
    ("person_score", T.IntegerType()),
]

CASE_RECORDS_SCHEMA = T.StructType(
    [T.StructField(name, dtype, True) for name, dtype in CASE_RECORD_COLUMNS]
)

DATE_COLUMNS = [n for n, t in CASE_RECORD_COLUMNS if isinstance(t, T.DateType)]
SCORE_COLUMNS = [n for n, t in CASE_RECORD_COLUMNS if isinstance(t, T.IntegerType)]

# The header names of the original CSV feed, in staging-column
# order (they must match a feed written for the original loader).  Matching is
# case-insensitive.
ORIGINAL_HEADER = [
    "nombre_victima",
    "apellido_victima",
    "direccion_victima",
    "fecha_primera_sospecha",
    "fecha_confirmacion",
    "fecha_muerte",
    "estado_victima",
    "nombre_asociado",
    "apellido_asociado",
    "fecha_conocio",
    "contacto_fisico",
    "fecha_inicio_contacto",
    "fecha_fin_contacto",
    "nombre_hospital",
    "direccion_hospital",
    "ubicacion_victima",
    "fecha_llegada",
    "fecha_retiro",
    "tratamiento",
    "efectividad",
    "fecha_inicio_tratamiento",
    "fecha_fin_tratamiento",
    "efectividad_en_victima",
]

HEADER_ALIASES: dict[str, str] = {
    **{ref: ours for ref, (ours, _) in zip(ORIGINAL_HEADER, CASE_RECORD_COLUMNS)},
    **{ours: ours for ours, _ in CASE_RECORD_COLUMNS},
}

# Staging NUMBER(2) range.
SCORE_MIN, SCORE_MAX = -99, 99

# VARCHAR2 limits (bytes) of the staging text columns.
STAGING_LENGTH_LIMITS = {
    "person_given": 50,
    "person_family": 50,
    "person_address": 100,
    "person_status": 50,
    "associate_given": 50,
    "associate_family": 50,
    "contact_kind": 50,
    "facility_name": 100,
    "facility_address": 100,
    "stay_address": 100,
    "treatment": 50,
}

# ---------------------------------------------------------------------------
# Model tables.  Every column is NOT NULL except person.died_on.
# ---------------------------------------------------------------------------

MODEL_SCHEMAS: dict[str, T.StructType] = {
    "associate": T.StructType([
        T.StructField("associate_id", T.LongType(), False),
        T.StructField("given", T.StringType(), False),
        T.StructField("family", T.StringType(), False),
    ]),
    "person": T.StructType([
        T.StructField("person_id", T.LongType(), False),
        T.StructField("given", T.StringType(), False),
        T.StructField("family", T.StringType(), False),
        T.StructField("address", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("suspected_on", T.DateType(), False),
        T.StructField("confirmed_on", T.DateType(), False),
        T.StructField("died_on", T.DateType(), True),
    ]),
    "facility": T.StructType([
        T.StructField("facility_id", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("address", T.StringType(), False),
    ]),
    "treatment": T.StructType([
        T.StructField("treatment_id", T.LongType(), False),
        T.StructField("description", T.StringType(), False),
        T.StructField("score", T.IntegerType(), False),
    ]),
    "person_facility": T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("person_id", T.LongType(), False),
        T.StructField("facility_id", T.LongType(), False),
    ]),
    "person_stay": T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("address", T.StringType(), False),
        T.StructField("stay_from", T.DateType(), False),
        T.StructField("stay_to", T.DateType(), False),
        T.StructField("person_id", T.LongType(), False),
    ]),
    "person_treatment": T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("person_score", T.IntegerType(), False),
        T.StructField("treated_from", T.DateType(), False),
        T.StructField("treated_to", T.DateType(), False),
        T.StructField("treatment_id", T.LongType(), False),
        T.StructField("person_id", T.LongType(), False),
    ]),
    "contact": T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("contact_from", T.DateType(), False),
        T.StructField("contact_to", T.DateType(), False),
        T.StructField("associate_id", T.LongType(), False),
        T.StructField("person_id", T.LongType(), False),
    ]),
    "acquaintance": T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("met_on", T.DateType(), False),
        T.StructField("associate_id", T.LongType(), False),
        T.StructField("person_id", T.LongType(), False),
    ]),
}

MODEL_TABLES = list(MODEL_SCHEMAS)

# Primary keys of the four dimensions and the surrogate id of each bridge.
ID_COLUMN = {
    "associate": "associate_id",
    "person": "person_id",
    "facility": "facility_id",
    "treatment": "treatment_id",
    "person_facility": "id",
    "person_stay": "id",
    "person_treatment": "id",
    "contact": "id",
    "acquaintance": "id",
}

# Natural key that decides "already present" on an incremental load (K2).
# Two of these are narrower than the key the rows are de-duplicated on when
# built: a person is present when (given, family, address) is, a facility when
# its name is.
INSERT_KEY = {
    "associate": ["given", "family"],
    "person": ["given", "family", "address"],
    "facility": ["name"],
    "treatment": ["description", "score"],
    "person_facility": ["facility_id", "person_id"],
    "person_stay": ["address", "stay_from", "stay_to", "person_id"],
    "person_treatment": ["person_id", "treatment_id"],
    "contact": ["kind", "contact_from", "contact_to", "person_id", "associate_id"],
    "acquaintance": ["associate_id", "person_id"],
}

# Order in which new rows receive their dense ids (K1).  A total order on the
# de-duplicated rows so ids are reproducible on any cluster.
ID_ORDER = {
    "associate": ["given", "family"],
    "person": ["given", "family", "address", "status", "suspected_on",
               "confirmed_on", "died_on"],
    "facility": ["name", "address"],
    "treatment": ["description", "score"],
    "person_facility": ["facility_id", "person_id"],
    "person_stay": ["person_id", "address", "stay_from", "stay_to"],
    "person_treatment": ["person_id", "treatment_id", "person_score",
                         "treated_from", "treated_to"],
    "contact": ["person_id", "associate_id", "kind", "contact_from", "contact_to"],
    "acquaintance": ["associate_id", "person_id"],
}

# Foreign keys: (child table, child column, parent table, parent column).
FOREIGN_KEYS = [
    ("person_facility", "person_id", "person", "person_id"),
    ("person_facility", "facility_id", "facility", "facility_id"),
    ("person_stay", "person_id", "person", "person_id"),
    ("person_treatment", "treatment_id", "treatment", "treatment_id"),
    ("person_treatment", "person_id", "person", "person_id"),
    ("contact", "associate_id", "associate", "associate_id"),
    ("contact", "person_id", "person", "person_id"),
    ("acquaintance", "associate_id", "associate", "associate_id"),
    ("acquaintance", "person_id", "person", "person_id"),
]

# Children before the tables they refer to.
_PARENTS = {parent for _, _, parent, _ in FOREIGN_KEYS}
DROP_ORDER = sorted(MODEL_SCHEMAS, key=lambda table: (table in _PARENTS, table))

# VARCHAR2 limits (bytes) of the model DDL.
LENGTH_LIMITS = {
    ("associate", "given"): 50,
    ("associate", "family"): 50,
    ("person", "given"): 50,
    ("person", "family"): 50,
    ("person", "address"): 150,
    ("person", "status"): 100,
    ("facility", "name"): 50,
    ("facility", "address"): 150,
    ("treatment", "description"): 150,
    ("person_stay", "address"): 150,
    ("contact", "kind"): 50,
}
