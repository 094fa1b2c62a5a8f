"""Command line: build, audit, score, export, sample, preprocess."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from tallywright.plans import build_stores, export_check, full_audit, preprocess, sample_match, score_rules
from tallywright.session import build_session
from tallywright.sources import readers


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tallywright")
    jobs = root.add_subparsers(dest="job", required=True)
    build = jobs.add_parser("build", help="raw extract to stores")
    build.add_argument("path")
    build.add_argument("--sum-lines", action="store_true")
    audit = jobs.add_parser("audit", help="full audit, or the close of one period")
    audit.add_argument("--year", type=int)
    audit.add_argument("--month", type=int)
    score = jobs.add_parser("score", help="score the rules")
    score.add_argument("--days", type=int, default=score_rules.LOOK_BACK_DAYS)
    export = jobs.add_parser("export", help="check a transaction export")
    export.add_argument("path")
    export.add_argument("--output", default="artifacts")
    export.add_argument("--validate-only", action="store_true")
    sample = jobs.add_parser("sample", help="match sample orders and ledger")
    sample.add_argument("orders")
    sample.add_argument("ledger")
    sample.add_argument("--output", default="artifacts")
    clean = jobs.add_parser("preprocess", help="profile, dedupe, convert")
    clean.add_argument("path")
    clean.add_argument("folder")
    clean.add_argument("name")
    return root


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    stamp = now.isoformat(" ", "seconds")
    if args.job == "build":
        build_stores.build(spark, args.path, stamp, args.sum_lines).show(truncate=False)
    elif args.job == "audit":
        result = full_audit.run(spark, stamp, args.year, args.month)
        for part in (result.summary, result.control_report, result.monthly_pnl, result.regional_profit):
            part.show(truncate=False)
    elif args.job == "score":
        score_rules.run(spark, now.date(), args.days).show(truncate=False)
    elif args.job == "export":
        if args.validate_only:
            verdict = readers.validate_export(spark, args.path)
            print(json.dumps(verdict, indent=2))
            return 0 if verdict["valid"] else 1
        print(export_check.run(spark, args.path, args.output, now.strftime("%Y%m%d_%H%M%S"), now.isoformat()))
    elif args.job == "sample":
        print(sample_match.run(spark, args.orders, args.ledger, args.output, now.isoformat()))
    else:
        print(preprocess.run(spark, args.path, args.folder, args.name))
    return 0


if __name__ == "__main__":
    sys.exit(main())
