"""Run the daily jobs: ``python -m ledgerline income|cost --as-of YYYY-MM-DD``.

Inputs come either from the test tables through the fixture views
(``--fixtures DIR``) or from catalog tables (``--tables inputs.json``, a map
of input name -> table name).  The session is the caller's cluster session.
"""

from __future__ import annotations

import argparse
import json
from datetime import date

from pyspark.sql import SparkSession

from ledgerline.context import RunContext
from ledgerline.plans import jobs as J
from ledgerline.plans.inputs import catalog_inputs, fixture_inputs
from ledgerline.session import apply_defaults


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerline")
    ap.add_argument("job", choices=["income", "cost"])
    ap.add_argument("--as-of", required=True, type=date.fromisoformat)
    ap.add_argument("--mode", choices=["incremental", "rebuild"], default="incremental")
    ap.add_argument("--first-close", default="20010601")
    ap.add_argument("--floor-month", default="2001-05")
    ap.add_argument("--prefix", default="", help="prefix for every output table name")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--fixtures", help="folder of the test tables (fixture views)")
    src.add_argument("--tables", help="JSON file: input name -> catalog table")
    ap.add_argument("--extract", help="folder for the daily cost extract (CSV)")
    ap.add_argument("--months", help="with --mode rebuild: comma-separated yyyy-MM months to rewrite only")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.getOrCreate()
    apply_defaults(spark)
    inputs = (fixture_inputs(spark, args.fixtures) if args.fixtures
              else catalog_inputs(spark, json.load(open(args.tables))))
    ctx = RunContext(as_of=args.as_of, first_close=args.first_close, floor_month=args.floor_month)
    if args.job == "income":
        months = args.months.split(",") if args.months else None
        J.run_income_job(spark, inputs, ctx, J.IncomeTables().prefixed(args.prefix), mode=args.mode, months=months)
    else:
        J.run_cost_job(spark, inputs, ctx, J.CostTables().prefixed(args.prefix), extract_path=args.extract)


if __name__ == "__main__":
    main()
