"""Command line: ``python -m shelfcast <job> --root <folder> ...``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from shelfcast.operators import rollup
from shelfcast.operators.runlog import RunLog
from shelfcast.plans import jobs
from shelfcast.session import scratch_tables
from shelfcast.sources.holidays import read_holidays, uk_bank_holidays
from shelfcast.sources.star import star_transactions
from shelfcast.sources.transactions import read_transactions

JOBS = [
    "monthly",
    "features",
    "holiday-impact",
    "holiday-products",
    "seasonality",
    "demand",
    "stock",
    "clusters",
    "correlation",
    "report",
]


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shelfcast")
    parser.add_argument("job", choices=[*JOBS, "update", "all"])
    parser.add_argument("--root", required=True, help="shared folder for stage tables")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument("--transactions", help="raw transaction lines")
    parser.add_argument("--transactions-format", default="csv", help="csv, parquet or orc")
    parser.add_argument("--timestamp-format", help="date pattern of a CSV that is not ISO")
    parser.add_argument("--star", help="folder with lineitem, orders and part tables")
    parser.add_argument("--batch", help="name of the lines that update takes in")
    parser.add_argument("--holidays", help="calendar CSV; the bundled calendar if omitted")
    parser.add_argument(
        "--top", type=int, default=rollup.TOP_PRODUCTS, help="best sellers kept; 0 keeps all"
    )
    parser.add_argument("--product", action="append", help="of the report; may repeat")
    parser.add_argument("--first", type=date.fromisoformat, help="first month of the report")
    parser.add_argument("--last", type=date.fromisoformat, help="last month of the report")
    return parser.parse_args()


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName(f"shelfcast {args.job}").getOrCreate()
    stages = jobs.Stages(args.root, args.format)

    def transactions(keep_unreadable: bool = False):
        if args.star:
            return star_transactions(spark, args.star)
        if args.transactions:
            return read_transactions(
                spark,
                args.transactions,
                timestamp_format=args.timestamp_format,
                fmt=args.transactions_format,
                keep_unreadable=keep_unreadable,
            )
        raise SystemExit("this job needs --transactions or --star")

    log = RunLog(spark, stages.path("run_log"))
    calendar = read_holidays(spark, args.holidays) if args.holidays else uk_bank_holidays(spark)
    steps = {
        "monthly": lambda: jobs.monthly_job(
            transactions(True), stages, args.top or None, log=log
        ),
        "features": lambda: jobs.features_job(spark, stages, calendar, log),
        "holiday-impact": lambda: jobs.holiday_impact_job(spark, stages, calendar),
        "holiday-products": lambda: jobs.holiday_products_job(transactions(), stages, calendar),
        "seasonality": lambda: jobs.seasonality_job(spark, stages),
        "demand": lambda: jobs.demand_job(spark, stages).best_parameters,
        "stock": lambda: jobs.stock_job(spark, stages).best_parameters,
        "clusters": lambda: jobs.clusters_job(spark, stages),
        "correlation": lambda: jobs.correlation_job(spark, stages),
        "update": lambda: jobs.update_job(
            transactions(), stages, args.batch or "", calendar, args.top or None
        ),
        "report": lambda: jobs.report_job(
            spark, stages, args.product, args.first, args.last
        ),
    }
    for name in JOBS if args.job == "all" else [args.job]:
        with scratch_tables(spark):
            print(name, steps[name]() or "")


if __name__ == "__main__":
    main()
