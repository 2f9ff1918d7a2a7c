"""Command line: the original routes as subcommands.

    python -m casetrace load   --feed FEED.csv --staged OUT [--on-bad null|drop|fail|original]
    python -m casetrace build  --staged STAGED --model OUT [--existing MODEL]
                               [--on-null report|drop|fail]
    python -m casetrace check  --model MODEL
    python -m casetrace report r9 --model MODEL [--param k=v ...] [--out PATH]
    python -m casetrace drop   [--database DB] [--staging NAME] [--model PATH] [--staged PATH]

The session comes from ``spark-submit``/the environment; ``--master`` is only
for local use.
"""

from __future__ import annotations

import argparse
import inspect
import sys

from casetrace.operators.quality import violations
from casetrace.plans.model import build_model
from casetrace.plans.reports import (REPORTS, original_report, rows_with_count,
                                     write_with_count)
from casetrace.session import build_session
from casetrace.sources.case_feed import ON_BAD_MODES, load_and_stage
from casetrace.sources.tables import (append_model, drop_model, drop_model_folder,
                                      drop_staged_folder, drop_staging, read_model, write_model)


def _typed(value: str, parameter: inspect.Parameter):
    """A text argument as the parameter's annotation says."""
    kind = str(parameter.annotation)
    return int(value) if "int" in kind else float(value) if "float" in kind else value


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="casetrace")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("--feed", required=True)
    p.add_argument("--staged", required=True)
    p.add_argument("--rejected")
    p.add_argument("--on-bad", default="null", choices=ON_BAD_MODES)
    p = sub.add_parser("build")
    p.add_argument("--staged", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--existing")
    p.add_argument("--on-null", default="fail", choices=["report", "drop", "fail"])
    p = sub.add_parser("check")
    p.add_argument("--model", required=True)
    p = sub.add_parser("report")
    p.add_argument("name", choices=sorted(REPORTS))
    p.add_argument("--model", required=True)
    p.add_argument("--param", action="append", default=[])
    p.add_argument("--original", action="store_true",
                   help="use the original program's literals for the report")
    p.add_argument("--out")
    p = sub.add_parser("drop")
    p.add_argument("--database")
    p.add_argument("--staging")
    p.add_argument("--model")
    p.add_argument("--staged")
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    if args.cmd == "load":
        feed = load_and_stage(spark, args.feed, args.staged, on_bad=args.on_bad)
        if args.rejected:
            feed.rejected.write.mode("overwrite").parquet(args.rejected)
        print(f"staged {feed.clean.count()} records, {feed.rejected.count()} rejected values")
    elif args.cmd == "build":
        staged = spark.read.parquet(args.staged).drop("problems", "record")
        existing = read_model(spark, args.existing) if args.existing else None
        model = build_model(staged, existing, on_null=args.on_null)
        if existing is not None and args.existing.rstrip("/") == args.model.rstrip("/"):
            append_model(model, existing, args.model)
        else:
            write_model(model, args.model)
        print({name: df.count() for name, df in read_model(spark, args.model).tables().items()})
    elif args.cmd == "check":
        violations(read_model(spark, args.model)).show(200, truncate=False)
    elif args.cmd == "report":
        fn = REPORTS[args.name]
        names = inspect.signature(fn).parameters
        params = dict(kv.split("=", 1) for kv in args.param)
        unknown = set(params) - set(names)
        if unknown:
            ap.error(f"unknown parameters for {args.name}: {sorted(unknown)}")
        missing = [n for n, p in names.items()
                   if p.default is p.empty and n != "m" and n not in params]
        if missing and not args.original:
            ap.error(f"{args.name} needs --param or --original for: {missing}")
        model = read_model(spark, args.model)
        if args.original:
            df = original_report(model, args.name)
        else:
            df = fn(model, **{k: _typed(v, names[k]) for k, v in params.items()})
        n = (write_with_count(df, args.out) if args.out else rows_with_count(
            df, lambda row: print("\t".join("" if v is None else str(v) for v in row))))
        print(f"{n} rows")
    elif args.cmd == "drop":
        if args.staging:
            drop_staging(spark, args.staging, args.database)
        if args.database:
            drop_model(spark, args.database)
        if args.staged:
            drop_staged_folder(spark, args.staged)
        if args.model:
            drop_model_folder(spark, args.model)
    return 0


if __name__ == "__main__":
    sys.exit(main())
