"""Command line: the two daily jobs.

    python -m daybook send  --tables DIR --snapshot PATH --counter PATH --export-dir PATH [--asof YYYY-MM-DD]
    python -m daybook check --snapshot PATH --counter PATH --results PATH [--asof YYYY-MM-DD]
    python -m daybook model --from-testdata DIR --tables DIR     (derive the operational tables)

``--tables`` holds the operational tables as parquet folders (ordOrder,
usrUser, ordHistory, ordBill, ordDelayRecord).  ``--asof`` defaults to today
in the business zone, so the report day is yesterday there.  Paths may be any
Hadoop file system URI.  The session is taken as configured (spark-submit).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

from daybook.functions.dates import BUSINESS_ZONE
from daybook.params import ReportParams
from daybook.plans import daily
from daybook.session import tune
from daybook.sources.loan_model import loan_tables, read_loan_tables, write_loan_tables


def _asof(text: str | None) -> dt.date:
    """The run day: given, or today in the business zone (UTC+7, no daylight
    saving; the fixed offset is used where no time zone data is installed)."""
    if text:
        return dt.date.fromisoformat(text)
    try:
        zone = ZoneInfo(BUSINESS_ZONE)
    except Exception:
        zone = dt.timezone(dt.timedelta(hours=7))
    return dt.datetime.now(zone).date()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="daybook")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("send")
    s.add_argument("--tables", required=True)
    s.add_argument("--snapshot", required=True)
    s.add_argument("--counter", required=True)
    s.add_argument("--export-dir", required=True)
    s.add_argument("--asof")
    s.add_argument("--partner", default=ReportParams().partner)
    c = sub.add_parser("check")
    c.add_argument("--snapshot", required=True)
    c.add_argument("--counter", required=True)
    c.add_argument("--results", required=True)
    c.add_argument("--asof")
    c.add_argument("--partner", default=ReportParams().partner)
    m = sub.add_parser("model")
    m.add_argument("--from-testdata", required=True)
    m.add_argument("--tables", required=True)
    args = ap.parse_args(argv)

    spark = tune(SparkSession.builder.appName(f"daybook-{args.cmd}").getOrCreate())
    if args.cmd == "model":
        write_loan_tables(loan_tables(spark, args.from_testdata), args.tables)
        print(json.dumps({"tables": args.tables}))
        return 0
    params = ReportParams(asof=_asof(args.asof), partner=args.partner)
    if args.cmd == "send":
        res = daily.send(spark, read_loan_tables(spark, args.tables), params, args.snapshot, args.counter, args.export_dir)
        print(json.dumps({"export_name": res.export_name, "export_file": res.export_file}))
        return 0
    res = daily.check(spark, params, args.snapshot, args.counter, args.results)
    message = res.message.first()["message"]
    out = f"{args.results}/_attachments-{params.rep:%Y%m%d}"
    res.attachments.write.mode("overwrite").json(out)
    print(json.dumps({"message": message, "attachments": out}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
