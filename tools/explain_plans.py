"""Print the physical plan trees of the heavy operators, as at scale.

    python tools/explain_plans.py [sf_dir] > /tmp/plans.txt

The broadcast threshold is cut to 4 KB so no data table fits under it (as at
100 TB), while tiny lookup tables still do; the shuffles that remain are the
ones a large cluster runs.
Only the operator tree of ``explain("formatted")`` is printed.
"""

from __future__ import annotations

import io
import os
import sys
import tempfile
from contextlib import redirect_stdout

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from casetrace.operators.keys import assign_ids  # noqa: E402
from casetrace.plans import model as B  # noqa: E402
from casetrace.plans import reports as R  # noqa: E402
from casetrace.session import build_session  # noqa: E402
from casetrace.sources.case_feed import stage  # noqa: E402
from casetrace.sources.fixtures import case_records_from_tables, fixture_report  # noqa: E402
from casetrace.sources.tables import read_model, write_model  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n")[0].strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="run-plans-", dir="/tmp")
    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.checkpoint.dir": f"{scratch}/ck",
        # as at scale: data tables are far above the threshold, while the
        # small lookup tables (kinds, K1 offsets) still fit under it
        "spark.sql.autoBroadcastJoinThreshold": "4096",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "4096"})
    staged = stage(case_records_from_tables(spark, sf_dir), f"{scratch}/staged")
    model = B.build_model(staged)
    write_model(model, f"{scratch}/model")
    m = read_model(spark, f"{scratch}/model")
    person = m.person
    keyed = B.attach_person(staged, person)
    shown = {
        "feed -> person (B2 incoming, before K1)": staged.where(F.col("person_given").isNotNull())
        .select("person_given", "person_family", "person_address").distinct(),
        "K1 numbering of a written, range-partitioned frame":
            assign_ids(m.contact.drop("id"), ["person_id", "associate_id", "kind",
                                              "contact_from", "contact_to"]),
        "K3 feed keyed by person (written once for B5/B6/B7/B9)": keyed,
        "B8 contact rows (fan-out on the recorded name)":
            B.contact_rows(staged, person, m.associate),
        "B9 acquaintance rows (pairs + per-person max, no self-join)":
            B.acquaintance_rows(keyed, m.associate),
        "R1 deaths_by_facility": fixture_report(m, "r1"),
        "R5 top_persons_by_treatment": fixture_report(m, "r5"),
        "R8 extremes_by_month": R.extremes_by_month(m),
        "R9 facility_share": R.facility_share(m),
        "R10 common_contact_by_facility": R.common_contact_by_facility(m),
    }
    for title, df in shown.items():
        print(f"### {title}\n\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()
