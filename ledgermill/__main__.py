"""python -m ledgermill --csv PATH --root FOLDER [--as-of YYYY-MM-DD]"""

import argparse
import datetime as dt
import logging

from pyspark.sql import SparkSession

from ledgermill.plans.refresh import KEPT, refresh
from ledgermill.plans.run import run
from ledgermill.plans.staging import ID_TYPE
from ledgermill.sources.raw_csv import FAIL, QUARANTINE


def main() -> None:
    parser = argparse.ArgumentParser(prog="ledgermill", description="Rebuild all layers from CSV files.")
    parser.add_argument("--csv", required=True, help="a CSV file or a folder of CSV files")
    parser.add_argument("--root", required=True, help="folder for the tables, reachable by all executors")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="reporting day; default: today")
    parser.add_argument("--id-type", choices=("bigint", "int"), default=ID_TYPE)
    parser.add_argument("--keep-going", action="store_true", help="go on when table tests fail")
    parser.add_argument("--multi-line", action="store_true", help="values may hold line breaks inside quotes")
    parser.add_argument(
        "--on-malformed", choices=(FAIL, QUARANTINE), default=FAIL, help="lines with surplus fields or broken quotes"
    )
    parser.add_argument("--catalog", action="store_true", help="register the tables under their layer names")
    parser.add_argument(
        "--fresh-within", type=int, nargs=2, metavar=("WARN", "ERROR"), help="hours a load may be old"
    )
    parser.add_argument(
        "--incremental", action="store_true", help="read only new files and rewrite only the months they touch"
    )
    args = parser.parse_args()
    if args.incremental and (args.multi_line or args.catalog or args.fresh_within):
        parser.error("--incremental does not go with --multi-line, --catalog or --fresh-within")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = (
        SparkSession.builder.appName("ledgermill")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    if args.incremental:
        outcome = refresh(
            spark, args.csv, args.root, args.as_of, args.id_type, not args.keep_going, args.on_malformed
        )
        print(f"files: {outcome.files}")
        for month in outcome.months:
            if month.change != KEPT:
                print(f"month {month.month}: {month.change}, {month.rows} rows")
        return
    result = run(
        spark,
        args.csv,
        args.root,
        args.as_of,
        args.id_type,
        fail_on_tests=not args.keep_going,
        multi_line=args.multi_line,
        on_malformed=args.on_malformed,
        catalog=args.catalog,
        fresh_within_hours=tuple(args.fresh_within) if args.fresh_within else None,
    )
    print(f"lines set aside: {result.loaded.lines_rejected}")
    for name, value in result.summary.asDict().items():
        print(f"{name}: {value}")


if __name__ == "__main__":
    main()
