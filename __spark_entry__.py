"""

Every query builds the case feed from the given tables (one record per
``lineitem``, FIXTURES.md section 3), normalises it with ``casetrace`` and
returns one model table, one report or one operator's output over the *whole*
feed.  The oracle SQL twins are queries of their own design for the same
definitions, so that a slip in one does not recur in the other.  Reports that
state an order carry each row's place in it.

Ids: the model numbers rows in natural-key order; the twins do the same with
``row_number() OVER (ORDER BY ...)`` (NULLS FIRST, binary string order).
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from casetrace.functions.dates import parse_date  # noqa: E402
from casetrace.functions.numbers import parse_score  # noqa: E402
from casetrace.operators.keys import assign_ids, written  # noqa: E402
from casetrace.operators.quality import violations  # noqa: E402
from casetrace.plans import reports as R  # noqa: E402
from casetrace.plans.model import (Model, attach_person, build_facility, build_model,  # noqa: E402
                                   build_person, build_person_treatment, build_treatment)
from casetrace.schema import (CASE_RECORD_COLUMNS, DATE_COLUMNS, FOREIGN_KEYS,  # noqa: E402
                              ID_COLUMN, INSERT_KEY, LENGTH_LIMITS, MODEL_SCHEMAS)
from casetrace.session import scratch_path  # noqa: E402
from casetrace.sources.case_feed import (clean_case_records, load_and_stage,  # noqa: E402
                                         load_case_records, read_case_records, to_feed_text,
                                         write_case_feed)
from casetrace.sources.fixtures import (FIXTURE_PARAMETERS, case_records_from_tables,  # noqa: E402
                                        fixture_report)
from casetrace.sources.tables import append_model, read_model, write_model  # noqa: E402
from casetrace.streaming.ingest import read_appended_model, start_ingest  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
# First of two loads in the insert-if-absent checks: the test feed's orders run
# from 1995-01-01 to 2001-08-01, so this splits it roughly in half.
SPLIT_DATE = "1998-01-01"
# Added to a foreign key it points beyond every parent.
ORPHAN = 10**12

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

_MEMO: dict = {}


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ("staging", spark.sparkContext.applicationId, sf_dir)
    if key not in _MEMO:
        _MEMO[key] = written(case_records_from_tables(spark, sf_dir), "staging")
    return _MEMO[key]


def _model(spark: SparkSession, sf_dir: str) -> Model:
    key = ("model", spark.sparkContext.applicationId, sf_dir)
    if key not in _MEMO:
        _MEMO[key] = build_model(_staging(spark, sf_dir))
    return _MEMO[key]


# Order of the reports that state one
REPORT_ORDER = {
    "r1": "name, address", "r2": "given, family", "r3": "given, family, address",
    "r5": "n DESC, given, family, address", "r6": "given, family, died_on NULLS LAST",
    "r7b": "given, family, address", "r9": "pct DESC, name, address", "r10": "pct DESC, name, address",
}


def _positioned(df: DataFrame) -> DataFrame:
    """``df`` with the place of each row in the order it comes out in."""
    placed = df.withColumn("__at", F.monotonically_increasing_id())
    return placed.withColumn("position", F.row_number().over(Window.orderBy("__at"))).drop("__at")


def _report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A report; with the place of each row where the report states an order
    (reports are small, so one task numbers their rows)."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = fixture_report(_model(spark, sf_dir), name)
        return _positioned(found) if name in REPORT_ORDER else found
    return query


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _model(spark, sf_dir).tables()[name]


def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as a headered CSV with text dates, read back as
    text columns."""
    path = scratch_path(spark, "feed")
    write_case_feed(_staging(spark, sf_dir), path, compression="gzip")
    return read_case_records(spark, path)


def q_staging_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + C1-C4: the CSV feed parsed, cleaned and staged as parquet."""
    feed_path = scratch_path(spark, "feed")
    write_case_feed(_staging(spark, sf_dir), feed_path, compression="gzip")
    return load_and_stage(spark, feed_path, scratch_path(spark, "staged"), on_bad="fail").clean


def q_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date of the feed formatted as feed text and parsed again."""
    st = _staging(spark, sf_dir)
    return st.select(*[parse_date(F.date_format(c, "dd/MM/yyyy HH:mm")).alias(c)
                       for c in DATE_COLUMNS])


def q_empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as text with every missing value written as '' (a
    non-CSV source), cleaned back to typed records."""
    text = to_feed_text(_staging(spark, sf_dir), original_header=False)
    blanked = text.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in text.columns])
    return clean_case_records(blanked, on_bad="null").clean


def q_numeric_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: signed decimal texts derived from every line item, cast to
    NUMBER(2): half away from zero, NULL beyond -99..99."""
    line = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    text = F.concat((F.col("l_quantity").cast("int") * 4 - 100).cast("string"), F.lit("."),
                    F.col("l_linenumber").cast("string"))
    return line.select("l_orderkey", "l_linenumber", text.alias("score_text"),
                       parse_score(text).alias("score"))


def q_reject_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written with unpadded day/month, and met-on dates of the
    first days of a month written with no slash, with one, and as the 31st of
    February; rejected values counted per column and reason."""
    path = scratch_path(spark, "feed-unpadded")
    staging = _staging(spark, sf_dir)
    day = F.dayofmonth("met_on")
    text = (to_feed_text(staging.select("*", day.alias("day")), original_header=False, date_pattern="d/M/yyyy",
                         further=["day"])
            .withColumn("met_on", F.when(F.col("day") == 1, F.lit("2020")).when(F.col("day") == 2, F.lit("2/2020"))
                        .when(F.col("day") == 3, F.lit("31/02/2020")).otherwise(F.col("met_on"))).drop("day"))
    text.write.option("header", True).option("compression", "gzip").csv(path)
    loaded = load_case_records(spark, path, on_bad="null")
    return (loaded.rejected.groupBy("column_name", "reason")
            .agg(F.count(F.lit(1)).alias("n")))


RAGGED_HEADER = "person_given,person_family,person_address"


def q_ragged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as feed lines of three fields, of which every seventh lacks
    one and every eleventh has two too many; what was staged, and the rejected
    lines."""
    path = scratch_path(spark, "feed-ragged")
    key = F.col("c_custkey")
    line = F.concat(F.col("c_name"), F.lit(","), F.col("c_mktsegment"),
                    F.when(key % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(","), key.cast("string"))),
                    F.when((key % 11 == 0) & (key % 7 != 0), F.lit(",x,y")).otherwise(F.lit("")))
    # a column named like the header, written without quoting, makes the lines
    (spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet").select(line.alias(RAGGED_HEADER))
     .write.option("header", True).option("sep", "\x01").option("quote", "").csv(path))
    feed = load_and_stage(spark, path, scratch_path(spark, "staged"), on_bad="drop")
    staged = feed.clean.select(F.lit("staged").alias("kind"), "person_given", "person_family", "person_address",
                               F.lit(None).cast("string").alias("line"))
    none = [F.lit(None).cast("string").alias(c) for c in ("person_given", "person_family", "person_address")]
    return staged.unionByName(feed.rejected.select(F.col("reason").alias("kind"), *none,
                                                   F.col("raw_value").alias("line")))


def q_dense_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: dense ids over every record of the feed, in full-row order."""
    st = _staging(spark, sf_dir)
    return assign_ids(st, [n for n, _ in CASE_RECORD_COLUMNS], "record_id")


def q_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: persons after two loads - the records suspected before SPLIT_DATE,
    then the whole feed; ids of the second load continue after the first."""
    st = _staging(spark, sf_dir)
    first = build_person(st.where(F.col("suspected_on") < F.lit(SPLIT_DATE).cast("date")))
    return build_person(st, existing=first)


def q_contact_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 across the model: contacts after a first load (records suspected
    before SPLIT_DATE) and a second load of the whole feed.  New persons and
    associates continue their ids, contacts already present are skipped, new
    contacts continue after the first load's maximum."""
    st = _staging(spark, sf_dir)
    first = build_model(st.where(F.col("suspected_on") < F.lit(SPLIT_DATE).cast("date")))
    return build_model(st, existing=first).contact


def q_append_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 after K2: the first load's model stored, the second load appended to
    it in place, and the contacts read back."""
    st = _staging(spark, sf_dir)
    path = scratch_path(spark, "model")
    write_model(build_model(st.where(F.col("suspected_on") < F.lit(SPLIT_DATE).cast("date"))),
                path)
    stored = read_model(spark, path)
    append_model(build_model(st, existing=stored), stored, path)
    return read_model(spark, path).contact


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming ingest: the records suspected before SPLIT_DATE arrive as one
    folder of feed files, the whole feed as a second; each is loaded by an
    available-now stream into the same model folder.  Persons must come out as
    after two batch loads (insert-if-absent, ids continuing)."""
    st = _staging(spark, sf_dir)
    root = scratch_path(spark, "stream")
    write_case_feed(st.where(F.col("suspected_on") < F.lit(SPLIT_DATE).cast("date")),
                    f"{root}/in1", original_header=False, compression="gzip")
    write_case_feed(st, f"{root}/in2", original_header=False, compression="gzip")
    for i in (1, 2):
        start_ingest(spark, f"{root}/in{i}", f"{root}/model",
                     checkpoint_location=f"{root}/ckpt{i}").awaitTermination()
    return read_appended_model(spark, f"{root}/model").person


def q_lookup_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the feed keyed by person id (person variants multiply rows)."""
    m = _model(spark, sf_dir)
    return attach_person(_staging(spark, sf_dir), m.person)


def q_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4-K7: every constraint check of the model with its count."""
    return violations(_model(spark, sf_dir))


def _broken(m: Model) -> Model:
    """The model with violations planted by row id: NULLs in every required
    column, over-long texts, keys without a parent, rows twice."""
    out = {}
    for name, df in m.tables().items():
        key = F.col(ID_COLUMN[name])
        cols = []
        for i, f in enumerate(MODEL_SCHEMAS[name].fields):
            c = F.col(f.name)
            if (name, f.name) in LENGTH_LIMITS:
                c = F.when(key % 5 == 1, F.repeat(c, F.lit(200))).otherwise(c)
            if any(fk[:2] == (name, f.name) for fk in FOREIGN_KEYS):
                c = F.when(key % 4 == 3, c + ORPHAN).otherwise(c)
            if not f.nullable:
                c = F.when(key % (i + 5) != 0, c)
            cols.append(c.alias(f.name))
        out[name] = df.select(*cols).unionByName(df.where(key % 6 == 2).select(*cols))
    return Model(**out)


def q_broken_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4-K7 on a model that breaks every kind of rule."""
    return violations(_broken(_model(spark, sf_dir)))


def _variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with persons told apart by customer and place only, so that a
    person has a variant per order, and with a facility address per year: the
    split of two loads cuts through persons and facilities."""
    return (_staging(spark, sf_dir).withColumn("person_address", F.col("stay_address"))
            .withColumn("facility_address", F.concat(
                F.col("facility_address"), F.lit("-"), F.year("suspected_on").cast("string"))))


def _early(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("suspected_on") < F.lit(SPLIT_DATE).cast("date"))


def q_variant_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: later variants of a present (given, family, address) stay out."""
    st = _variants(spark, sf_dir)
    return build_person(st, existing=build_person(_early(st)))


def q_variant_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: later addresses of a present facility name stay out."""
    st = _variants(spark, sf_dir)
    return build_facility(st, existing=build_facility(_early(st)))


def q_variant_treatments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: later rows of a present (person, treatment) stay out."""
    st = _variants(spark, sf_dir)
    person = treatment = given = None
    for feed in (_early(st), st):
        person = build_person(feed, person)
        treatment = build_treatment(feed, treatment)
        given = build_person_treatment(attach_person(feed, person), treatment, given)
    return given


def q_last_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.last_facility(_model(spark, sf_dir))


def q_top_contact_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_contact_kind(_model(spark, sf_dir))


def q_result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row count of every report."""
    m = _model(spark, sf_dir)
    parts = [fixture_report(m, name).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(name).alias("report"), "n") for name in R.REPORTS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: R10 (the deepest chain) on the sf0.001 feed."""
    return R.common_contact_by_facility(_model(spark, SMOKE_DIR))


def _llm_parts() -> tuple | None:
    """The text operators and their pipeline, where they are installed."""
    for name in ("casetrace.llm", "corpus_pipeline"):
        spec = importlib.util.find_spec(name)
        if spec is None or spec.origin is None:
            return None
    import corpus_pipeline
    from casetrace.llm import queries as text_queries
    return text_queries, corpus_pipeline


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {
        "s1_csv_scan": q_csv_scan,
        "s2_staging_load": q_staging_load,
        "c1_parse_date": q_parse_date,
        "c3_empty_to_null": q_empty_to_null,
        "c4_numeric_cast": q_numeric_cast,
        "c5_reject_malformed": q_reject_malformed,
        "s1_ragged_rows": q_ragged_rows,
        "k1_dense_id": q_dense_id,
        "k2_insert_if_absent": q_insert_if_absent,
        "k2_contact_two_loads": q_contact_two_loads,
        "st_stream_ingest": q_stream_ingest,
        "s5_append_model": q_append_model,
        "k3_lookup_id": q_lookup_id,
        "k4_k7_violations": q_violations,
        "k4_k7_broken_model": q_broken_model,
        "k2_variant_persons": q_variant_persons,
        "k2_variant_facilities": q_variant_facilities,
        "k2_variant_treatments": q_variant_treatments,
        "b1_associate": _table("associate"),
        "b2_person": _table("person"),
        "b3_facility": _table("facility"),
        "b4_treatment": _table("treatment"),
        "b5_person_facility": _table("person_facility"),
        "b6_person_stay": _table("person_stay"),
        "b7_person_treatment": _table("person_treatment"),
        "b8_contact": _table("contact"),
        "b9_acquaintance": _table("acquaintance"),
        "r1_deaths_by_facility": _report("r1"),
        "r2_persons_by_treatment_score": _report("r2"),
        "r3_deceased_with_many_associates": _report("r3"),
        "r4_contacts_by_kind": _report("r4"),
        "r5_top_persons_by_treatment": _report("r5"),
        "r6_persons_by_location_and_treatment": _report("r6"),
        "r7a_persons_with_n_treatments": _report("r7a"),
        "r7b_persons_with_n_treatments_few_associates": _report("r7b"),
        "r8_extremes_by_month": _report("r8"),
        "r9_facility_share": _report("r9"),
        "r10_common_contact_by_facility": _report("r10"),
        "w10_last_facility": q_last_facility,
        "a6_top_contact_kind": q_top_contact_kind,
        "s8_result_rows": q_result_rows,
    }
    if llm := _llm_parts():
        q |= llm[0].queries() | {"pipeline": llm[1].run}
    return q


# ---------------------------------------------------------------------------
# Oracle side (DuckDB)
# ---------------------------------------------------------------------------

STAGING_SQL = """
staging AS (
  SELECT
    c_name AS person_given,
    c_mktsegment AS person_family,
    concat('ORD-', CAST(o_orderkey AS VARCHAR)) AS person_address,
    CAST(o_orderdate AS DATE) AS suspected_on,
    CAST(o_orderdate + INTERVAL 3 DAY AS DATE) AS confirmed_on,
    CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_orderdate + INTERVAL 30 DAY AS DATE) END AS died_on,
    CASE o_orderstatus WHEN 'F' THEN 'deceased' WHEN 'O' THEN 'suspended' ELSE 'treated' END
      AS person_status,
    CASE WHEN l_suppkey % 17 <> 0 THEN s_name END AS associate_given,
    CASE WHEN l_suppkey % 17 <> 0 THEN concat('N', CAST(s_nationkey AS VARCHAR)) END
      AS associate_family,
    CAST(l_shipdate AS DATE) AS met_on,
    CASE WHEN l_linenumber <= 2 THEN l_returnflag END AS contact_kind,
    CAST(o_orderdate AS DATE) AS contact_from,
    CAST(l_shipdate AS DATE) AS contact_to,
    CASE WHEN l_suppkey % 13 <> 0 THEN n_name END AS facility_name,
    r_name AS facility_address,
    concat('LOC-', CAST(c_nationkey AS VARCHAR)) AS stay_address,
    CAST(o_orderdate AS DATE) AS stay_from,
    CAST(l_shipdate AS DATE) AS stay_to,
    CASE WHEN l_partkey % 19 <> 0 THEN p_type END AS treatment,
    CAST(CASE WHEN p_type = 'ECONOMY' THEN p_size % 2 ELSE 5 END AS INTEGER) AS treatment_score,
    CAST(o_orderdate AS DATE) AS treated_from,
    CAST(l_shipdate AS DATE) AS treated_to,
    CAST(CAST(l_quantity AS INTEGER) % 10 AS INTEGER) AS person_score
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

# The twins follow the definitions of the model, in forms of their own: ids are
# dense ranks, a natural key that stands for several rows is a list of ids that
# is unnested, and one keyed feed serves every person-keyed table.


def _ranked(table: str, id_col: str, columns: dict[str, str], optional: str = "") -> str:
    """A dimension: distinct rows whose columns (but ``optional``) are present."""
    order = ", ".join(f"{c} NULLS FIRST" for c in columns.values())
    shown = ", ".join(f"{c} AS {name}" for name, c in columns.items())
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns.values() if c != optional)
    return f"""{table} AS (
  SELECT DISTINCT dense_rank() OVER (ORDER BY {order}) AS {id_col}, {shown}
  FROM staging WHERE {present}
)"""


def _bridge(table: str, columns: str, order: str, rows: str) -> str:
    """A bridge: ``rows`` once each, numbered in ``order``."""
    return f"""{table} AS (
  SELECT row_number() OVER (ORDER BY {order}) AS id, {columns}
  FROM (SELECT DISTINCT {columns} FROM {rows})
)"""


PERSON_COLUMNS = {
    "given": "person_given", "family": "person_family", "address": "person_address",
    "status": "person_status", "suspected_on": "suspected_on", "confirmed_on": "confirmed_on",
    "died_on": "died_on"}

MODEL_SQL = {
    "associate": _ranked("associate", "associate_id", {
        "given": "associate_given", "family": "associate_family"}) + """,
associate_names AS (
  SELECT associate_id, given AS associate_given, family AS associate_family FROM associate
)""",
    "person": _ranked("person", "person_id", PERSON_COLUMNS, optional="died_on") + """,
person_homes AS (
  SELECT given AS person_given, family AS person_family, address AS person_address,
         list(person_id) AS ids
  FROM person GROUP BY ALL
),
keyed AS (
  SELECT staging.*, unnest(ids) AS person_id
  FROM staging JOIN person_homes USING (person_given, person_family, person_address)
)""",
    "facility": _ranked("facility", "facility_id", {
        "name": "facility_name", "address": "facility_address"}),
    "treatment": _ranked("treatment", "treatment_id", {
        "description": "treatment", "score": "treatment_score"}),
    "person_facility": _bridge(
        "person_facility", "person_id, facility_id", "facility_id, person_id",
        """keyed JOIN (SELECT facility_id, name AS facility_name, address AS facility_address
                       FROM facility) USING (facility_name, facility_address)"""),
    "person_stay": _bridge(
        "person_stay", "address, stay_from, stay_to, person_id",
        "person_id, address, stay_from, stay_to",
        """(SELECT stay_address AS address, * FROM keyed)
           WHERE address IS NOT NULL AND stay_from IS NOT NULL AND stay_to IS NOT NULL"""),
    "person_treatment": _bridge(
        "person_treatment", "person_score, treated_from, treated_to, treatment_id, person_id",
        "person_id, treatment_id, person_score NULLS FIRST, treated_from NULLS FIRST, "
        "treated_to NULLS FIRST",
        """(SELECT k.*, unnest(scored) AS treatment_id FROM keyed k JOIN (
             SELECT description AS treatment, list(treatment_id) AS scored FROM treatment
             GROUP BY ALL) USING (treatment))"""),
    "contact": _bridge(
        "contact", "kind, contact_from, contact_to, associate_id, person_id",
        "person_id, associate_id, kind, contact_from, contact_to",
        """(SELECT contact_kind AS kind, contact_from, contact_to, associate_id,
                   unnest(bearers) AS person_id
            FROM staging JOIN associate_names USING (associate_given, associate_family)
            JOIN (SELECT given AS person_given, family AS person_family,
                         list(person_id) AS bearers FROM person GROUP BY ALL)
              USING (person_given, person_family)
            WHERE contact_kind IS NOT NULL AND contact_from IS NOT NULL
              AND contact_to IS NOT NULL)"""),
    "acquaintance": _bridge(
        "acquaintance", "met_on, associate_id, person_id", "associate_id, person_id",
        """(SELECT person_id, associate_given, associate_family,
                   max(met_on) OVER (PARTITION BY person_id) AS met_on FROM keyed)
           JOIN associate_names USING (associate_given, associate_family)"""),
}

MODEL_ORDER = ["associate", "person", "facility", "treatment", "person_facility",
               "person_stay", "person_treatment", "contact", "acquaintance"]


def _with(body: str, tables: tuple[str, ...] = tuple(MODEL_ORDER)) -> str:
    ctes = [STAGING_SQL] + [MODEL_SQL[t] for t in MODEL_ORDER if t in tables]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _pct(part: str, whole: str) -> str:
    return (f"CAST(((20000 * ({part}) + ({whole})) // (2 * ({whole}))) AS DOUBLE) / 100.0")


def _treated(description: str, extra: str = "") -> str:
    return f"""SELECT person_id FROM person_treatment WHERE treatment_id IN (
      SELECT treatment_id FROM treatment WHERE description = '{description}'){extra}"""


P = FIXTURE_PARAMETERS
DEAD = f"(status = '{P['r1']['status']}' OR died_on IS NOT NULL)"
TWICE_TREATED = """SELECT person_id FROM (
    SELECT person_id, count(*) AS n FROM person_treatment GROUP BY person_id)
  WHERE n = 2"""

REPORT_SQL = {
    "r1_deaths_by_facility": f"""
SELECT name, facility.address, count(*) FILTER (WHERE gone) AS deaths
FROM facility JOIN person_facility USING (facility_id)
JOIN (SELECT person_id, coalesce({DEAD}, FALSE) AS gone FROM person) USING (person_id)
GROUP BY facility_id, name, facility.address""",
    "r2_persons_by_treatment_score": f"""
SELECT given, family FROM person
SEMI JOIN ({_treated(P["r2"]["description"], " AND person_score > 5")}) USING (person_id)
GROUP BY given, family""",
    "r3_deceased_with_many_associates": f"""
SELECT given, family, address FROM person
SEMI JOIN (SELECT person_id FROM acquaintance
           QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY id) = 4) USING (person_id)
WHERE {DEAD} GROUP BY given, family, address""",
    "r4_contacts_by_kind": f"""
SELECT given, family FROM person
SEMI JOIN (SELECT person_id FROM contact WHERE kind = '{P["r4"]["kind"]}'
           QUALIFY dense_rank() OVER (PARTITION BY person_id ORDER BY associate_id) = 3)
  USING (person_id)
WHERE status = '{P["r4"]["status"]}' GROUP BY given, family""",
    "r5_top_persons_by_treatment": f"""
SELECT given, family, address, n FROM person
JOIN (SELECT person_id, count(*) AS n FROM ({_treated(P["r5"]["description"])}) GROUP BY person_id)
  USING (person_id)
ORDER BY n DESC, given, family, address LIMIT 5""",
    "r6_persons_by_location_and_treatment": f"""
SELECT given, family, died_on FROM person
SEMI JOIN (SELECT person_id FROM person_stay WHERE address = '{P["r6"]["address"]}'
           INTERSECT {_treated(P["r6"]["description"])}) USING (person_id)
GROUP BY given, family, died_on""",
    "r7a_persons_with_n_treatments": f"""
SELECT given, family, address FROM person SEMI JOIN ({TWICE_TREATED}) USING (person_id)""",
    "r7b_persons_with_n_treatments_few_associates": f"""
SELECT given, family, address FROM person SEMI JOIN ({TWICE_TREATED}) USING (person_id)
ANTI JOIN (SELECT person_id FROM acquaintance
           QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY id) = 2)
  USING (person_id)""",
    "r8_extremes_by_month": """
SELECT month, given, family, n FROM (
  SELECT *, row_number() OVER (ORDER BY n DESC, month, given, family) AS from_top,
         row_number() OVER (ORDER BY n, month, given, family) AS from_bottom
  FROM (SELECT CAST(month(suspected_on) AS INTEGER) AS month, given, family, count(*) AS n
        FROM person JOIN person_treatment USING (person_id) GROUP BY ALL)),
  (VALUES ('top'), ('bottom')) ends(which)
WHERE CASE which WHEN 'top' THEN from_top ELSE from_bottom END <= 10""",
    "r9_facility_share": f"""
SELECT name, address, n, {_pct("n", "CAST(whole AS BIGINT)")} AS pct
FROM (SELECT facility_id, count(*) AS n, sum(count(*)) OVER () AS whole
      FROM person_facility GROUP BY facility_id)
JOIN facility USING (facility_id)""",
    "r10_common_contact_by_facility": f"""
SELECT name, address, arg_min(kind, (-votes, kind)) AS kind,
       {_pct("max(votes)", "any_value(visits)")} AS pct
FROM (SELECT facility_id, kind, count(*) AS votes
      FROM (SELECT person_id, max(facility_id) AS facility_id FROM person_facility GROUP BY ALL)
      JOIN (SELECT person_id, max(kind) AS kind FROM contact GROUP BY ALL) USING (person_id)
      GROUP BY ALL)
JOIN (SELECT facility_id, count(*) AS visits FROM person_facility GROUP BY ALL)
  USING (facility_id)
JOIN facility USING (facility_id)
GROUP BY facility_id, name, address""",
}

_TEXT_DATE = "strftime({c}, '%d/%m/%Y %H:%M')"


def _csv_scan_sql() -> str:
    cols = []
    for name, dtype in CASE_RECORD_COLUMNS:
        if name in DATE_COLUMNS:
            cols.append(f"{_TEXT_DATE.format(c=name)} AS {name}")
        else:
            cols.append(f"CAST({name} AS VARCHAR) AS {name}")
    return _with("SELECT " + ", ".join(cols) + " FROM staging", ())


def _reject_sql() -> str:
    cases = [f"SELECT '{c}' AS column_name, 'bad_date' AS reason FROM staging "
             f"WHERE day({c}) < 10 OR month({c}) < 10" for c in DATE_COLUMNS if c != "met_on"]
    cases.append("""SELECT 'met_on', CASE WHEN day(met_on) <= 2 THEN 'date_form' ELSE 'bad_date' END FROM staging
  WHERE day(met_on) < 10 OR month(met_on) < 10""")
    union = "\nUNION ALL\n".join(cases)
    return _with(f"SELECT column_name, reason, count(*) AS n FROM ({union}) GROUP BY ALL", ())


RAGGED_SQL = """
WITH fields AS (
  SELECT c_custkey AS k, c_name, c_mktsegment, CAST(c_custkey AS VARCHAR) AS address FROM customer
)
SELECT 'staged' AS kind, c_name AS person_given, c_mktsegment AS person_family, address AS person_address,
       CAST(NULL AS VARCHAR) AS line FROM fields WHERE k % 7 <> 0 AND k % 11 <> 0
UNION ALL
SELECT 'token_count', NULL, NULL, NULL, concat_ws(',', c_name, c_mktsegment) FROM fields WHERE k % 7 = 0
UNION ALL
SELECT 'token_count', NULL, NULL, NULL, concat_ws(',', c_name, c_mktsegment, address, 'x', 'y') FROM fields
WHERE k % 7 <> 0 AND k % 11 = 0"""


def _dense_id_sql() -> str:
    cols = [n for n, _ in CASE_RECORD_COLUMNS]
    order = ", ".join(f"{c} NULLS FIRST" for c in cols)
    return _with(f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS record_id, "
                 + ", ".join(cols) + " FROM staging", ())


def _two_loads(table: str, id_col: str, columns: dict[str, str], key: list[str],
               optional: str = "") -> str:
    """A dimension after two loads.  A row is early when the first load holds
    it; a late row stays out when an early one bears its key; ids number the
    early rows first."""
    shown = ", ".join(f"{c} AS {name}" for name, c in columns.items())
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns.values() if c != optional)
    order = ", ".join(f"{name} NULLS FIRST" for name in columns)
    return f"""{table}2 AS (
  SELECT row_number() OVER (ORDER BY early DESC, {order}) AS {id_col}, * FROM (
    SELECT * FROM (
      SELECT {shown}, bool_or(coalesce(suspected_on < DATE '{SPLIT_DATE}', FALSE)) AS early
      FROM staging WHERE {present} GROUP BY {", ".join(columns.values())})
    QUALIFY early OR NOT bool_or(early) OVER (PARTITION BY {", ".join(key)}))
)"""


PERSON_TWICE = _two_loads("person", "person_id", PERSON_COLUMNS, ["given", "family", "address"],
                          optional="died_on")


def _insert_if_absent_sql() -> str:
    shown = ", ".join(PERSON_COLUMNS)
    return _with(f", {PERSON_TWICE}\nSELECT person_id, {shown} FROM person2", ())


def _contact_two_loads_sql() -> str:
    associate = _two_loads("associate", "associate_id", {
        "given": "associate_given", "family": "associate_family"}, ["given", "family"])
    return _with(f"""
, {PERSON_TWICE}
, {associate}
, met AS (
  SELECT contact_kind AS kind, contact_from, contact_to, associate_id, person_id,
         bool_or(coalesce(staging.suspected_on < DATE '{SPLIT_DATE}', FALSE)
                 AND person2.early AND associate2.early) AS early
  FROM staging
  JOIN person2 ON (person_given, person_family) = (person2.given, person2.family)
  JOIN associate2 ON (associate_given, associate_family) = (associate2.given, associate2.family)
  WHERE contact_kind IS NOT NULL AND contact_from IS NOT NULL AND contact_to IS NOT NULL
  GROUP BY ALL
)
SELECT row_number() OVER (ORDER BY early DESC, person_id, associate_id, kind, contact_from,
                          contact_to) AS id,
       kind, contact_from, contact_to, associate_id, person_id
FROM met""", ())


def _lookup_sql() -> str:
    return _with("""SELECT facility_name, facility_address, stay_address, stay_from, stay_to,
       treatment, person_score, treated_from, treated_to, associate_given, associate_family,
       met_on, person_id FROM keyed""", ("person",))


def _violations_sql(suffix: str = "", planted: str = "") -> str:
    parts = []
    for table, schema in MODEL_SCHEMAS.items():
        for f in schema.fields:
            if not f.nullable:
                parts.append(f"SELECT '{table}' AS table_name, 'not_null' AS rule, "
                             f"'{f.name}' AS column_name, CAST(COUNT(*) FILTER "
                             f"(WHERE {f.name} IS NULL) AS BIGINT) AS n FROM {table}{suffix}")
            limit = LENGTH_LIMITS.get((table, f.name))
            if limit is not None:
                parts.append(f"SELECT '{table}', 'max_length', '{f.name}', CAST(COUNT(*) "
                             f"FILTER (WHERE strlen({f.name}) > {limit}) AS BIGINT) "
                             f"FROM {table}{suffix}")
        pk = ID_COLUMN[table]
        parts.append(f"SELECT '{table}', 'primary_key', '{pk}', CAST(COUNT(*) AS BIGINT) "
                     f"FROM (SELECT {pk} FROM {table}{suffix} GROUP BY {pk} HAVING COUNT(*) > 1) d")
    for table in ("associate", "person", "facility", "treatment"):
        key = ", ".join(INSERT_KEY[table])
        parts.append(f"SELECT '{table}', 'natural_key', '{','.join(INSERT_KEY[table])}', "
                     f"CAST(COUNT(*) AS BIGINT) FROM (SELECT {key} FROM {table}{suffix} "
                     f"GROUP BY {key} HAVING COUNT(*) > 1) d")
    for child, col, parent, pcol in FOREIGN_KEYS:
        parts.append(f"SELECT '{child}', 'foreign_key', '{col}', CAST(COUNT(*) AS BIGINT) "
                     f"FROM {child}{suffix} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                     f"(SELECT 1 FROM {parent}{suffix} p WHERE p.{pcol} = c.{col})")
    return _with(planted + "\nUNION ALL\n".join(parts))


def _broken_sql() -> str:
    ctes = ""
    for table, schema in MODEL_SCHEMAS.items():
        key = f"t.{ID_COLUMN[table]}"
        shown = []
        for i, f in enumerate(schema.fields):
            c = f"t.{f.name}"
            if (table, f.name) in LENGTH_LIMITS:
                c = f"if({key} % 5 = 1, repeat({c}, 200), {c})"
            if any(fk[:2] == (table, f.name) for fk in FOREIGN_KEYS):
                c = f"{c} + if({key} % 4 = 3, {ORPHAN}, 0)"
            if not f.nullable:
                c = f"if({key} % {i + 5} = 0, NULL, {c})"
            shown.append(f"{c} AS {f.name}")
        ctes += (f", {table}_broken AS (SELECT {', '.join(shown)} FROM {table} t, "
                 f"LATERAL (SELECT unnest(if({key} % 6 = 2, [1, 2], [1])) AS nth) d)\n")
    return _violations_sql("_broken", ctes)


VARIANT_SQL = STAGING_SQL.replace("staging AS", "plain AS", 1) + """, staging AS (
  SELECT * REPLACE (stay_address AS person_address,
    concat(facility_address, '-', CAST(year(suspected_on) AS VARCHAR)) AS facility_address)
  FROM plain
)"""


def _variants_sql(table: str) -> str:
    """One table after two loads of the feed with variants."""
    facility = _two_loads("facility", "facility_id", {
        "name": "facility_name", "address": "facility_address"}, ["name"])
    treatment = _two_loads("treatment", "treatment_id", {
        "description": "treatment", "score": "treatment_score"}, ["description", "score"])
    body = {
        "person": f"SELECT person_id, {', '.join(PERSON_COLUMNS)} FROM person2",
        "facility": "SELECT facility_id, name, address FROM facility2",
        "person_treatment": f"""
, given AS (
  SELECT s.person_score, s.treated_from, s.treated_to, treatment_id, person_id,
         bool_or(coalesce(s.suspected_on < DATE '{SPLIT_DATE}', FALSE)
                 AND p.early AND t.early) AS known
  FROM staging s
  JOIN person2 p ON (person_given, person_family, person_address) = (p.given, p.family, p.address)
  JOIN treatment2 t ON treatment = t.description
  GROUP BY ALL
), added AS (
  SELECT * FROM given
  QUALIFY known OR NOT bool_or(known) OVER (PARTITION BY person_id, treatment_id)
)
SELECT row_number() OVER (ORDER BY known DESC, person_id, treatment_id, person_score NULLS FIRST,
                          treated_from NULLS FIRST, treated_to NULLS FIRST) AS id,
       person_score, treated_from, treated_to, treatment_id, person_id
FROM added"""}[table]
    return f"WITH {VARIANT_SQL}, {PERSON_TWICE}, {facility}, {treatment}\n{body}"


def _result_rows_sql() -> str:
    names = dict(zip(R.REPORTS, [k for k in REPORT_SQL]))
    parts = [f"SELECT '{short}' AS report, CAST(COUNT(*) AS BIGINT) AS n "
             f"FROM ({REPORT_SQL[full]}) q{i}"
             for i, (short, full) in enumerate(names.items())]
    return _with("\nUNION ALL\n".join(parts))


def oracle_sql() -> dict[str, str]:
    out = {
        "s1_csv_scan": _csv_scan_sql(),
        "s2_staging_load": _with("SELECT * FROM staging", ()),
        "c1_parse_date": _with("SELECT " + ", ".join(DATE_COLUMNS) + " FROM staging", ()),
        "c3_empty_to_null": _with("SELECT * FROM staging", ()),
        "c4_numeric_cast": """
SELECT l_orderkey, l_linenumber, score_text,
       CASE WHEN ROUND(CAST(score_text AS DECIMAL(18, 4)), 0) BETWEEN -99 AND 99
            THEN CAST(ROUND(CAST(score_text AS DECIMAL(18, 4)), 0) AS INTEGER) END AS score
FROM (SELECT l_orderkey, l_linenumber,
             concat(CAST(CAST(l_quantity AS INTEGER) * 4 - 100 AS VARCHAR), '.',
                    CAST(l_linenumber AS VARCHAR)) AS score_text
      FROM lineitem) t""",
        "c5_reject_malformed": _reject_sql(),
        "s1_ragged_rows": RAGGED_SQL,
        "k1_dense_id": _dense_id_sql(),
        "k2_insert_if_absent": _insert_if_absent_sql(),
        "k2_contact_two_loads": _contact_two_loads_sql(),
        "st_stream_ingest": _insert_if_absent_sql(),
        "s5_append_model": _contact_two_loads_sql(),
        "k3_lookup_id": _lookup_sql(),
        "k4_k7_violations": _violations_sql(),
        "k4_k7_broken_model": _broken_sql(),
        "k2_variant_persons": _variants_sql("person"),
        "k2_variant_facilities": _variants_sql("facility"),
        "k2_variant_treatments": _variants_sql("person_treatment"),
        "w10_last_facility": _with(
            "SELECT person_id, max(facility_id) AS facility_id FROM person_facility "
            "GROUP BY person_id"),
        "a6_top_contact_kind": _with(
            "SELECT person_id, MAX(kind) AS kind FROM contact GROUP BY person_id"),
        "s8_result_rows": _result_rows_sql(),
    }
    builder_ids = {"associate": "b1", "person": "b2", "facility": "b3", "treatment": "b4",
                   "person_facility": "b5", "person_stay": "b6", "person_treatment": "b7",
                   "contact": "b8", "acquaintance": "b9"}
    for table, bid in builder_ids.items():
        cols = ", ".join(f.name for f in MODEL_SCHEMAS[table].fields)
        out[f"{bid}_{table}"] = _with(f"SELECT {cols} FROM {table}")
    for short, name in zip(R.REPORTS, REPORT_SQL):
        body = REPORT_SQL[name]
        if short in REPORT_ORDER:
            body = (f"SELECT *, CAST(row_number() OVER (ORDER BY {REPORT_ORDER[short]}) AS INTEGER) AS position\n"
                    f"FROM ({body}) report")
        out[name] = _with(body)
    if llm := _llm_parts():
        out |= llm[0].oracle_sql()
        if llm[1].ORACLE_SQL:
            out["pipeline"] = llm[1].ORACLE_SQL
    return out
