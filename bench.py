"""Benchmark: load, normalise and report at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Timings (seconds, wall clock):

* ``load``      feed derived from the given tables, staged as parquet;
* ``load_csv``  the feed as a headered text CSV parsed, cleaned and staged in
  one pass (clean rows and rejected values land in one parquet table);
* ``build``     all nine model tables built (ids included) and written;
* ``checks``    all constraint checks of the written model;
* ``r1``..``r10`` each report over the written model.

Every figure is the median of ``BENCH_REPEATS`` (default 3) runs; ``value`` is
the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from casetrace.operators.quality import violations  # noqa: E402
from casetrace.plans import model as B  # noqa: E402
from casetrace.plans.reports import REPORTS  # noqa: E402
from casetrace.session import build_session, scratch_path  # noqa: E402
from casetrace.sources.case_feed import load_and_stage, stage, write_case_feed  # noqa: E402
from casetrace.sources.fixtures import case_records_from_tables, fixture_report  # noqa: E402
from casetrace.sources.tables import read_model, write_model  # noqa: E402


def _build(staging, path):
    write_model(B.build_model(staging), path)
    return path


def _timed(fn):
    t = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    scratch = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    spark = build_session(f"local[{cpus}]", app="casetrace-bench",
                          shuffle_partitions=partitions,
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                          extra={"spark.checkpoint.dir": f"{scratch}/checkpoints",
                                 "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    times: dict[str, float] = {}
    # JVM/JIT warm-up outside the timings: one small scan, join and aggregate.
    warm = spark.read.parquet(f"{sf_dir}/nation.parquet")
    warm.join(spark.read.parquet(f"{sf_dir}/region.parquet"),
              warm.n_regionkey == F.col("r_regionkey")).groupBy("r_name").count().collect()

    def median_of(fn):
        runs = [_timed(fn) for _ in range(repeats)]
        print([round(t, 2) for _, t in runs], file=sys.stderr, flush=True)
        return runs[-1][0], statistics.median(t for _, t in runs)

    staging, times["load"] = median_of(lambda: stage(
        case_records_from_tables(spark, sf_dir), scratch_path(spark, "staged")))

    feed_path = scratch_path(spark, "feed")
    write_case_feed(staging, feed_path)
    _, times["load_csv"] = median_of(lambda: load_and_stage(
        spark, feed_path, scratch_path(spark, "staged-csv"), on_bad="null"))

    model_path, times["build"] = median_of(lambda: _build(staging, scratch_path(spark, "model")))

    model = read_model(spark, model_path)
    _, times["checks"] = median_of(lambda: violations(model).collect())

    for name in REPORTS:
        _, times[name] = median_of(lambda: fixture_report(model, name).write.format("noop")
                                   .mode("overwrite").save())

    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {
        "metric": "pipeline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "spark": spark.version,
        "master": f"local[{cpus}]",
        "shuffle_partitions": partitions,
        "repeats": repeats,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
