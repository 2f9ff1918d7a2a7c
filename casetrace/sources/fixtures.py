"""Case-record feed derived from the driver's TPC-H style tables.

One record per ``lineitem``: a *person* is an order (and its customer), an
*associate* the supplier, a *facility* the supplier's nation in its region, a
*treatment* the part type.  Nulls, homonyms and a two-score treatment occur
naturally (see FIXTURES.md section 3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casetrace.plans.model import Model
from casetrace.plans.reports import REPORTS
from casetrace.schema import CASE_RECORDS_SCHEMA

TPCH_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def case_records_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging feed, typed as ``CASE_RECORDS_SCHEMA``.

    Each input is projected to the columns it contributes before it is
    joined, so the scans read only those columns.  Customers join the orders
    and parts and suppliers the narrow line items, so that the records become
    wide only in the last shuffle join, on the order key; nation and region
    are tiny, Spark broadcasts them from file statistics after it.
    """
    t = lambda name: read_table(spark, sf_dir, name)
    line = t("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("ship_date"),
        F.when(F.col("l_linenumber") <= 2, F.col("l_returnflag")).alias("kind"),
        (F.col("l_quantity").cast("int") % 10).alias("score"))
    part = t("part").select("p_partkey", "p_type", F.when(
        F.col("p_type") == "ECONOMY", F.col("p_size") % 2).otherwise(F.lit(5)).alias("treatment_score"))
    supplier = t("supplier").select("s_suppkey", "s_name", "s_nationkey")
    customer = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                F.to_date("o_orderdate").alias("order_date"))
    nation = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    region = t("region").select("r_regionkey", "r_name")

    lines = (line.join(part, line.l_partkey == part.p_partkey)
             .join(supplier, line.l_suppkey == supplier.s_suppkey)
             .select("l_orderkey", "ship_date", "kind", "score", "treatment_score", "s_name", "s_nationkey",
                     F.when(F.col("l_partkey") % 19 != 0, F.col("p_type")).alias("treatment"),
                     (F.col("l_suppkey") % 17 != 0).alias("has_associate"),
                     (F.col("l_suppkey") % 13 != 0).alias("has_facility")))
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey).drop("o_custkey", "c_custkey")
    rows = (lines.join(placed, lines.l_orderkey == placed.o_orderkey)
            .join(nation, F.col("s_nationkey") == nation.n_nationkey)
            .join(region, F.col("n_regionkey") == region.r_regionkey))

    order_date, ship_date = F.col("order_date"), F.col("ship_date")
    cols = {
        "person_given": F.col("c_name"),
        "person_family": F.col("c_mktsegment"),
        "person_address": F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")),
        "suspected_on": order_date,
        "confirmed_on": F.date_add(order_date, 3),
        "died_on": F.when(F.col("o_orderkey") % 11 == 0, F.date_add(order_date, 30)),
        "person_status": (F.when(F.col("o_orderstatus") == "F", "deceased")
                          .when(F.col("o_orderstatus") == "O", "suspended")
                          .otherwise("treated")),
        "associate_given": F.when(F.col("has_associate"), F.col("s_name")),
        "associate_family": F.when(
            F.col("has_associate"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))),
        "met_on": ship_date,
        "contact_kind": F.col("kind"),
        "contact_from": order_date,
        "contact_to": ship_date,
        "facility_name": F.when(F.col("has_facility"), F.col("n_name")),
        "facility_address": F.col("r_name"),
        "stay_address": F.concat(F.lit("LOC-"), F.col("c_nationkey").cast("string")),
        "stay_from": order_date,
        "stay_to": ship_date,
        "treatment": F.col("treatment"),
        "treatment_score": F.col("treatment_score"),
        "treated_from": order_date,
        "treated_to": ship_date,
        "person_score": F.col("score"),
    }
    return rows.select(*[cols[f.name].cast(f.dataType).alias(f.name)
                         for f in CASE_RECORDS_SCHEMA.fields])


# Report parameters that fit this feed.
FIXTURE_PARAMETERS = {
    "r1": {"status": "deceased"},
    "r2": {"description": "PROMO"},
    "r3": {"status": "deceased"},
    "r4": {"status": "suspended", "kind": "A"},
    "r5": {"description": "PROMO"},
    "r6": {"address": "LOC-7", "description": "PROMO"},
}


def fixture_report(m: Model, name: str) -> DataFrame:
    """Report ``name`` with the parameters that fit this feed."""
    return REPORTS[name](m, **FIXTURE_PARAMETERS.get(name, {}))
