"""Command line: one pipeline run.

    python -m lakeline --landing 's3a://b/landing/*.parquet' --root s3a://b/lake \\
        --zones s3a://b/reference/taxi_zone_lookup.csv [--vendors s3a://b/reference/vendors.csv] [--full-refresh] [--publish trips] \\
        [--var max_fare_amount=2500] [--no-tests] [--strict-reference]

Works the same under ``spark-submit lakeline/__main__.py ...``; master, memory
and shuffle partitions are those of the submit configuration. Prints the run
summary as JSON; exits non-zero when a data test fails.
"""

from __future__ import annotations

import argparse
import dataclasses
import sys

from lakeline.config import Thresholds


def parse_vars(pairs: list[str]) -> Thresholds:
    fields = {f.name for f in dataclasses.fields(Thresholds)}
    values = {}
    for pair in pairs:
        name, _, value = pair.partition("=")
        if name not in fields:
            raise SystemExit(f"unknown variable {name!r}; known: {', '.join(sorted(fields))}")
        values[name] = float(value)
    return Thresholds(**values)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="lakeline", description=__doc__.split("\n")[0])
    ap.add_argument("--landing", required=True, help="glob of the landing Parquet files")
    ap.add_argument("--root", required=True, help="lakehouse root folder")
    ap.add_argument("--zones", required=True, help="taxi zone lookup CSV")
    for name, what in (("vendors", "vendor"), ("rate-codes", "rate code"), ("payment-types", "payment type")):
        ap.add_argument(f"--{name}", metavar="CSV", help=f"{what} list (id, name); the built-in one without")
    ap.add_argument("--full-refresh", action="store_true")
    ap.add_argument("--publish", metavar="PREFIX", help="register tables as PREFIX_<layer>.<table>")
    ap.add_argument("--var", action="append", default=[], metavar="NAME=VALUE", help="a cleaning threshold")
    ap.add_argument("--no-tests", action="store_true")
    ap.add_argument("--strict-reference", action="store_true",
                    help="replace only keys present in the new rows (keeps stale rows of re-delivered files)")
    args = ap.parse_args(argv)

    from lakeline.operators.checks import DataTestFailure
    from lakeline.plans.pipeline import Pipeline
    from lakeline.session import submitted_session

    spark = submitted_session()
    pipe = Pipeline(spark, args.landing, args.root, zones=args.zones, thresholds=parse_vars(args.var),
                    run_tests=not args.no_tests, strict_reference=args.strict_reference,
                    publish_prefix=args.publish, vendors=args.vendors, rate_codes=args.rate_codes,
                    payment_types=args.payment_types)
    try:
        summary = pipe.run(full_refresh=args.full_refresh)
    except DataTestFailure as e:
        print(f"data tests failed: {e}", file=sys.stderr)
        return 2
    print(summary.to_json())
    return 0


if __name__ == "__main__":
    sys.exit(main())
