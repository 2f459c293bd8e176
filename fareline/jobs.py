"""spark-submit entry point.

    spark-submit --py-files fareline.zip fareline/jobs.py month --lake <folder> --raw-root <folder> \\
        --zones <csv> --service-type yellow --year 2024 --month 1
"""

from __future__ import annotations

import argparse
import logging

from fareline.functions.rules import NULL_POLICIES, REJECT
from fareline.operators.profile import (
    compare_profiles, duration_percentiles, quality_profile, schema_diff, value_percentiles,
)
from fareline.operators.reconcile import reconcile
from fareline.operators.zones import orphan_locations
from fareline.plans.ledger import Ledger
from fareline.plans.monthly import MIN_ROWS_PER_MONTH, backfill, load_month, run_month
from fareline.session import build_session
from fareline.sources.lake import Lake
from fareline.sources.trips import file_name, read_raw, trip_path
from fareline.sources.zones import read_zones

log = logging.getLogger("fareline")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="fareline")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in (("conform", "load one month, without marts"), ("month", "one full monthly run"),
                       ("backfill", "full runs of consecutive months"), ("profile", "profile one raw month")):
        command = commands.add_parser(name, help=text)
        command.add_argument("--raw-root", required=True)
        command.add_argument("--zones", required=True)
        command.add_argument("--service-type", default="yellow")
        command.add_argument("--year", type=int, required=True)
        command.add_argument("--month", type=int, required=True)
        if name == "profile":
            command.add_argument("--other-year", type=int, help="year of a second month to compare with")
            command.add_argument("--other-month", type=int)
            continue
        command.add_argument("--lake", required=True)
        command.add_argument("--database", default="fareline")
        command.add_argument("--null-policy", choices=NULL_POLICIES, default=REJECT)
        if name != "conform":
            command.add_argument("--min-rows", type=int, default=MIN_ROWS_PER_MONTH)
        if name == "backfill":
            command.add_argument("--months", type=int, required=True, help="number of months from the first")
            command.add_argument("--resume", action="store_true", help="skip months the lake's ledger has as done")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = _arguments(argv)
    spark = build_session(f"fareline-{args.command}")
    zones = read_zones(spark, args.zones)
    path = trip_path(args.raw_root, args.service_type, args.year, args.month)
    if args.command == "profile":
        raw = read_raw(spark, path)
        trips = reconcile(raw)
        if args.other_year and args.other_month:
            other = read_raw(spark, trip_path(args.raw_root, args.service_type, args.other_year, args.other_month))
            for difference in schema_diff(raw.schema, other.schema):
                log.info("column %s: %s, %s", *difference)
            for row in compare_profiles(trips, reconcile(other), zones).orderBy("measure").collect():
                log.info("%s", row.asDict())
            return
        for report in (quality_profile(trips), value_percentiles(trips), duration_percentiles(trips),
                       orphan_locations(trips, zones)):
            for row in report.collect():
                log.info("%s", row.asDict())
        return
    lake = Lake(spark, args.lake, args.database)
    options = {"null_policy": args.null_policy}
    if args.command == "conform":
        loaded = [load_month(lake, read_raw(spark, path), zones, args.service_type, args.year, args.month,
                             file_name(path), **options)]
    elif args.command == "month":
        loaded = [run_month(lake, args.raw_root, zones, args.service_type, args.year, args.month,
                            min_rows=args.min_rows, **options)]
    else:
        first = args.year * 12 + args.month - 1
        months = [(n // 12, n % 12 + 1) for n in range(first, first + args.months)]
        ledger = Ledger(spark, f"{args.lake.rstrip('/')}/load_ledger") if args.resume else None
        loaded = backfill(lake, args.raw_root, zones, args.service_type, months, min_rows=args.min_rows, ledger=ledger, **options)
    for counts in loaded:
        log.info("%s", counts)


if __name__ == "__main__":
    main()
