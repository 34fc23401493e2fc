"""Snapshot table, export file and file names.

The snapshot table is parquet partitioned by report day.  Replacing a day is
done by writing the new rows to a staging folder and swapping partition
folders, so

* a rerun of a day is idempotent,
* a day whose new result is empty ends up empty (a plain dynamic partition
  overwrite would silently keep the old rows),
* readers never see a half-deleted, half-inserted day for longer than a
  folder rename.

Only folder metadata passes through the driver; rows go executor -> storage.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.text import LINE_END, csv_line, ymd, zfill
from daybook.operators.filters import REPORT_DATE_COLUMN, filter_report_day
from daybook.plans.report import REPORT_COLUMNS

# The 17 exported columns (the report without ``id`` and
# ``tgl_update``), the dates rendered as yyyyMMdd, the file name tag.
EXPORT_COLUMNS = tuple(c for c in REPORT_COLUMNS if c not in ("id", "tgl_update"))
EXPORT_DATE_COLUMNS = (
    "tgl_perjanjian_borrower",
    "tgl_penyaluran_dana",
    "tgl_pelaporan_data",
    "tgl_jatuh_tempo_pinjaman",
)
EXPORT_NAME_TAG = "SIK"


# ---- Hadoop file system helpers (driver-side metadata only) ---------------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise IOError(f"rename failed: {src} -> {dst}")


def partition_path(table_path: str, day: dt.date) -> str:
    return f"{table_path}/{REPORT_DATE_COLUMN}={day.isoformat()}"


ASIDE = "_aside"  # old day folders during a swap


def restore_snapshot(spark: SparkSession, table_path: str) -> list[str]:
    """Put back the days that a stopped swap left aside (folder names).  A day
    whose new folder is in place already keeps the new one."""
    fs, aside = _fs(spark, f"{table_path}/{ASIDE}")
    back = []
    if fs.exists(aside):
        for st in fs.listStatus(aside):
            name = st.getPath().getName()
            if _exists(spark, f"{table_path}/{name}"):
                fs.delete(st.getPath(), True)
            else:
                _rename(spark, f"{table_path}/{ASIDE}/{name}", f"{table_path}/{name}")
                back.append(name)
    return back


def replace_snapshot(
    spark: SparkSession,
    report: DataFrame,
    table_path: str,
    days: list[dt.date],
) -> str:
    """Replace the partitions of ``days`` in the snapshot table by ``report``.

    Every day in ``days`` is replaced, also when ``report`` has no row for it
    (that day is then cleared, as a delete-then-insert would do).  Rows of any
    other day are an error, raised before a day is touched.

    A day is swapped by two renames: the old folder aside, the new one in.  If
    a run stops in between, the next call finds the folder aside and puts it
    back first, so no day is lost."""
    fs_root, root = _fs(spark, table_path)
    fs_root.mkdirs(root)  # an all-empty table still reads as empty
    restore_snapshot(spark, table_path)
    staging = f"{table_path}/_staging/{uuid.uuid4().hex}"
    rows = report
    # Rebalance by day: AQE cuts each day into advisory-size write tasks (a
    # big day is split, small ones are merged), instead of one small file per
    # upstream task and day.  Only with AQE on: without it a rebalance by day
    # would send a whole day to one task.
    if str(spark.conf.get("spark.sql.adaptive.enabled", "true")).lower() == "true":
        rows = rows.hint("rebalance", REPORT_DATE_COLUMN)
    rows.write.mode("overwrite").partitionBy(REPORT_DATE_COLUMN).parquet(staging)
    expected = {partition_path("", day).strip("/") for day in days}
    found = {st.getPath().getName() for st in fs_root.listStatus(_fs(spark, staging)[1]) if st.isDirectory()}
    if strangers := sorted(x for x in found - expected if "=" in x):
        _delete(spark, staging)
        raise ValueError(f"the report has rows outside the replaced days: {', '.join(strangers[:5])}")
    for day in days:
        target, aside = partition_path(table_path, day), partition_path(f"{table_path}/{ASIDE}", day)
        if _exists(spark, target):
            _rename(spark, target, aside)
        staged = partition_path(staging, day)
        if _exists(spark, staged):
            _rename(spark, staged, target)
        _delete(spark, aside)
    _delete(spark, staging)
    fs, parent = _fs(spark, f"{table_path}/_staging")
    if fs.exists(parent) and len(fs.listStatus(parent)) == 0:
        fs.delete(parent, False)  # only when empty: a concurrent run may stage there
    return table_path


def read_snapshot(spark: SparkSession, table_path: str, schema=None) -> DataFrame:
    """The snapshot table; with ``schema`` (e.g. the report's) no inference is
    needed, so a table without any day yet reads as empty."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", table_path).parquet(table_path)


def scan_snapshot(spark: SparkSession, table_path: str, rep: dt.date, schema=None) -> DataFrame:
    """One report day (partition pruning), the 17 exported columns in order."""
    return filter_report_day(read_snapshot(spark, table_path, schema), rep).select(*EXPORT_COLUMNS)


def export_projection(snapshot_day: DataFrame) -> DataFrame:
    """The 17 columns with the four dates as ``yyyyMMdd`` text."""
    return snapshot_day.select(
        *[ymd(F.col(c)).alias(c) if c in EXPORT_DATE_COLUMNS else F.col(c) for c in EXPORT_COLUMNS]
    )


def export_lines(projected: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One ``line`` per row: ``|``-separated, minimal quoting, NULL as empty.
    Values render like the original's ``str()``: decimals keep their scale.
    ``keep``: columns to carry along (to sort by)."""
    return projected.select(*keep, csv_line(*[F.col(c) for c in EXPORT_COLUMNS]).alias("line"))


def write_export(lines: DataFrame, path: str, order_by: list[str] | None = None) -> str:
    """Write lines with CRLF line ends, no header, as part files.

    With ``order_by`` the rows are range-partitioned and sorted, so the parts
    concatenate in order; a small export is one part, and no task or value
    holds a whole large one.  ``lines`` may carry the sort columns next to
    ``line``."""
    if order_by:
        lines = lines.orderBy(*order_by)
    lines.select("line").write.mode("overwrite").option("lineSep", LINE_END).text(path)
    return path


def export_name(partner: Column, rep_day: Column, counter: Column) -> Column:
    """``<partner><yyyyMMdd>SIK<counter, 2 digits>``."""
    return F.concat(partner, ymd(rep_day), F.lit(EXPORT_NAME_TAG), zfill(counter, 2))
