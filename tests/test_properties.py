"""Randomised properties (hypothesis) of ids, date parsing and report totals."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casetrace.functions import parse_date
from casetrace.operators.keys import assign_ids
from casetrace.plans import reports as R
from casetrace.plans.model import build_model

from feed_rows import records

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(keys=st.lists(st.tuples(st.text(alphabet="abcXYZ é", max_size=4),
                               st.one_of(st.none(), st.integers(-5, 5))),
                     unique=True, max_size=60),
       parts=st.integers(1, 9))
def test_ids_are_the_rank_in_key_order(spark, keys, parts):
    df = spark.createDataFrame(keys, "s string, i int").repartition(parts)
    got = {(r.s, r.i): r.id for r in assign_ids(df, ["s", "i"], "id").collect()}
    # Spark's order: binary strings, NULLs first
    want = sorted(keys, key=lambda k: (k[0].encode("utf-8"), k[1] is not None, k[1] or 0))
    assert got == {k: i + 1 for i, k in enumerate(want)}


@SETTINGS
@given(days=st.lists(st.dates(dt.date(1900, 1, 1), dt.date(2100, 12, 31)), max_size=20),
       junk=st.lists(st.text(alphabet="0123456789/ :-", max_size=16), max_size=20))
def test_parse_date_agrees_with_strptime(spark, days, junk):
    texts = [d.strftime("%d/%m/%Y") + " 10:30" for d in days] + junk
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in df.select(parse_date(F.trim("t")).alias("v")).collect()]

    def expect(t):
        head = t.strip().split(" ", 1)[0]
        if len(head) != 10 or head[2] != "/" or head[5] != "/":
            return None
        try:
            return dt.datetime.strptime(head, "%d/%m/%Y").date()
        except ValueError:
            return None
    assert got == [expect(t) for t in texts]


def test_facility_share_counts_sum_to_all_visits(spark):
    feed = records(spark, *[{"person_given": f"P{i}", "facility_name": f"F{i % 3}"}
                            for i in range(40)])
    m = build_model(feed)
    rows = R.facility_share(m).collect()
    assert sum(r.n for r in rows) == m.person_facility.count()
    assert abs(sum(r.pct for r in rows) - 100.0) < 0.05
