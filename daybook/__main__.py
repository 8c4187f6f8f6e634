"""``spark-submit``-able front of the four jobs: ``python -m daybook <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from daybook import TableSpec, plans, sources
from daybook.operators import preview
from daybook.settings import apply_settings


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="daybook", description=__doc__)
    parser.add_argument("--key", action="append", help="key column, repeatable (default: id)")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *positional: str, stored: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for p in positional:
            sub.add_argument(p)
        if stored:
            sub.add_argument("--root", required=True, help="directory of the store")
        return sub

    integrate = job("daily-integration", "day", "csv")
    integrate.add_argument("--schema", required=True, help="columns of the CSV, as DDL")
    integrate.add_argument("--buckets", type=int)
    integrate.add_argument("--anchors", choices=["month", "year"], help="keep each one's first snapshot")
    integrate.add_argument("--strict", action="store_true", help="refuse lines that do not fit the columns")
    integrate.add_argument("--late", action="store_true", help="put in a day that was missed")
    report = job("report")
    report.add_argument("--by", action="append", required=True)
    report.add_argument("--limit", type=int, help="the largest groups only; all by default")
    report.add_argument("--output", help="write the report there as Parquet")
    job("recompute-dump", "day", "output")
    diff = job("diff", "old", "new", stored=False)
    diff.add_argument("--output")
    diff.add_argument("--limit", type=int, default=50, help="rows to show; --output gets all")
    diff.add_argument("--strict", action="store_true")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = apply_settings(SparkSession.builder.appName("daybook").getOrCreate())
    spec = TableSpec(args.key or "id")
    if args.job == "diff":
        changes = plans.diff_snapshots(spark, args.old, args.new, spec, strict=args.strict, output=args.output)
        preview(changes, args.limit).show(args.limit, truncate=False)
        return
    store = sources.DumpStore(args.root, spec, getattr(args, "buckets", None), getattr(args, "anchors", None))
    if args.job == "daily-integration":
        done = plans.integrate_csv(spark, store, args.day, args.csv, args.schema, strict=args.strict, late=args.late)
        print("skipped, integrated before" if done.skipped else "integrated", done.day, done.counts)
    elif args.job == "report":
        report = plans.report_latest(spark, store, args.by, args.limit)
        if args.output:
            sources.write_snapshot(report, args.output)
            report = sources.read_snapshot(spark, args.output, report.schema)
        report.show(report.count(), truncate=False)
    else:
        wrote = plans.recompute_snapshot(spark, store, args.day, args.output)
        print(f"written to {args.output}" if wrote else f"no log rows up to {args.day}, nothing written")


if __name__ == "__main__":
    main()
