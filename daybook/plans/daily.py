"""The two daily jobs, end to end.

``send``: build the day's report -> replace its snapshot partition -> count
the run -> write the export ``<partner><yyyyMMdd>SIK<nn>.csv``, a folder of
parts ordered by loan (one part for a small report).

``check``: read the run counter (no change) -> read the partner's result file
and statistic document -> count the snapshot's last 7 days -> the
notification message and the base64 attachments.

Rows never pass through the driver.  The driver only handles folder metadata
(swap, rename, listing) and two single values: the day's counter (for the
file name) and the latest counter version.

The counter is a small versioned parquet table: each update writes a new
version into a folder of its own and renames it into place when it is whole, so
every version folder that is seen is complete, whatever marker files the
committer writes.  A failed update leaves the previous version in force, and
the next update takes the next free number.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.aggregates import daily_counts
from daybook.operators.counter import counter_upsert
from daybook.operators.filters import REPORT_DATE_COLUMN, filter_last_days
from daybook.params import ReportParams
from daybook.plans import snapshot
from daybook.plans.check import INTRO, summary_message
from daybook.plans.report import build_report
from daybook.sources import partner
from daybook.sources.loan_model import LoanTables

COUNTER_SCHEMA = f"{REPORT_DATE_COLUMN} date, counter int"
VERSION_PREFIX = "v"


# ---- versioned counter table ---------------------------------------------------
def _versions(spark: SparkSession, counter_path: str) -> list[int]:
    fs, root = snapshot._fs(spark, counter_path)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION_PREFIX) and name[1:].isdigit():
            out.append(int(name[1:]))
    return sorted(out)


def read_counter(spark: SparkSession, counter_path: str) -> DataFrame:
    versions = _versions(spark, counter_path)
    if not versions:
        return spark.createDataFrame([], COUNTER_SCHEMA)
    return spark.read.parquet(f"{counter_path}/{VERSION_PREFIX}{versions[-1]:08d}")


def write_counter(spark: SparkSession, counter_path: str, state: DataFrame) -> None:
    versions = _versions(spark, counter_path)
    nxt = (versions[-1] + 1) if versions else 1
    target = f"{counter_path}/{VERSION_PREFIX}{nxt:08d}"
    staging = f"{counter_path}/_staging-{uuid.uuid4().hex}"
    state.write.parquet(staging)
    if snapshot._exists(spark, target):  # another run took this number meanwhile
        raise FileExistsError(f"counter version exists: {target}")
    snapshot._rename(spark, staging, target)


def bump_counter(spark: SparkSession, counter_path: str, days: list[dt.date]) -> DataFrame:
    """Count one run for each of ``days``; returns the new state."""
    inc = spark.createDataFrame([(d, 1) for d in days], f"{REPORT_DATE_COLUMN} date, increment int")
    new = counter_upsert(read_counter(spark, counter_path), inc)
    write_counter(spark, counter_path, new)
    return read_counter(spark, counter_path)


def counter_text(state: DataFrame, day: dt.date) -> str:
    """The day's counter as 2-digit text, ``00`` when absent (one value)."""
    row = state.where(F.col(REPORT_DATE_COLUMN) == F.lit(day)).agg(F.max("counter").alias("c")).first()
    value = row["c"] if row is not None else None
    return "00" if value is None else str(value).zfill(2)


ORDER_COLUMN = "id_pinjaman"


# ---- send ----------------------------------------------------------------------------
@dataclass(frozen=True)
class SendResult:
    export_name: str
    export_file: str
    snapshot_path: str


def send(
    spark: SparkSession,
    tables: LoanTables,
    params: ReportParams,
    snapshot_path: str,
    counter_path: str,
    export_dir: str,
) -> SendResult:
    rep = params.rep
    report = build_report(tables, params)
    snapshot.replace_snapshot(spark, report, snapshot_path, [rep])
    state = bump_counter(spark, counter_path, [rep])
    name = f"{params.partner}{rep.strftime('%Y%m%d')}{snapshot.EXPORT_NAME_TAG}{counter_text(state, rep)}"
    day = snapshot.scan_snapshot(spark, snapshot_path, rep, schema=report.schema)
    lines = snapshot.export_lines(snapshot.export_projection(day), keep=(ORDER_COLUMN,))
    target = f"{export_dir}/{name}.csv"
    snapshot.write_export(lines, target, order_by=[ORDER_COLUMN, "line"])
    return SendResult(export_name=name, export_file=target, snapshot_path=snapshot_path)


# ---- check ----------------------------------------------------------------------------
@dataclass(frozen=True)
class CheckResult:
    message: DataFrame  # one row: message
    attachments: DataFrame  # filename, content (base64)


def check(
    spark: SparkSession,
    params: ReportParams,
    snapshot_path: str,
    counter_path: str,
    result_dir: str,
    intro: str = INTRO,
) -> CheckResult:
    rep = params.rep
    cc = counter_text(read_counter(spark, counter_path), rep)
    result_name = f"{params.partner}{rep.strftime('%Y%m%d')}{snapshot.EXPORT_NAME_TAG}{cc}.zip.out"
    stat_name = f"statistic_{params.partner}.json"
    for name in (result_name, stat_name):
        if not snapshot._exists(spark, f"{result_dir}/{name}"):
            raise FileNotFoundError(f"the partner's file is missing: {result_dir}/{name}")
    # only the two expected files are listed and read (the folder keeps
    # every day's results); the name filter stays as a guard
    files = partner.read_files(spark, result_dir, glob="{" + result_name + "," + stat_name + "}", recursive=False)
    files = files.where(partner.file_name(F.col("path")).isin(result_name, stat_name))
    texts = partner.read_result_text(files)
    result_text = texts.where(F.col("file_name") == result_name).select("text")
    stat = partner.stat_pairs(texts.where(F.col("file_name") == stat_name).select(F.col("text").alias("doc")), "doc")
    days = snapshot.read_snapshot(spark, snapshot_path, schema=f"{REPORT_DATE_COLUMN} date")
    counts = daily_counts(filter_last_days(days, rep, 7))
    message = summary_message(counts, F.lit(result_name), result_text, F.lit(stat_name), stat, intro)
    attachments = partner.attachment_b64(files)
    return CheckResult(message=message, attachments=attachments)
