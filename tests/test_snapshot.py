"""Snapshot replace, export bytes and the run counter."""

import csv
import datetime as dt
import glob
import io
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from daybook.operators.counter import counter_read, counter_upsert
from daybook.params import ReportParams
from daybook.plans import snapshot
from daybook.plans.report import build_report, build_report_days
from daybook.session import scratch_path
from daybook.sources.loan_model import loan_tables
from tests_helpers import local_dir

P = ReportParams()


def test_replace_is_idempotent_and_clears_empty_days(spark):
    t = loan_tables(spark, SF001)
    path = scratch_path(spark, "t-snapshot")
    days = [P.rep - dt.timedelta(days=1), P.rep]
    hist = build_report_days(t, days[0], days[1], P)
    snapshot.replace_snapshot(spark, hist, path, days)
    before = snapshot.read_snapshot(spark, path).groupBy("tgl_pelaporan_data").count().collect()
    snapshot.replace_snapshot(spark, build_report(t, P), path, [P.rep])  # rerun of the last day
    after = snapshot.read_snapshot(spark, path).groupBy("tgl_pelaporan_data").count().collect()
    assert sorted(before) == sorted(after) and len(after) == 2
    # an empty result for a day clears that day (a plain dynamic overwrite would keep it)
    snapshot.replace_snapshot(spark, build_report(t, P).limit(0), path, [P.rep])
    days_left = [r[0] for r in snapshot.read_snapshot(spark, path).select("tgl_pelaporan_data").distinct().collect()]
    assert days_left == [days[0]]


def test_rows_outside_the_replaced_days_are_an_error(spark):
    t = loan_tables(spark, SF001)
    path, day = scratch_path(spark, "t-snapshot"), P.rep - dt.timedelta(days=1)
    snapshot.replace_snapshot(spark, build_report(t, P), path, [P.rep])
    both = build_report_days(t, day, P.rep, P)
    with pytest.raises(ValueError, match=day.isoformat()):
        snapshot.replace_snapshot(spark, both, path, [P.rep])
    assert [r[0] for r in snapshot.read_snapshot(spark, path).select("tgl_pelaporan_data").distinct().collect()] == [P.rep]


@pytest.mark.parametrize("stop_at", [1, 2])
def test_a_stopped_swap_loses_no_day(spark, monkeypatch, stop_at):
    """Stopped after the old folder went aside (1) or the new one came in (2)."""
    t = loan_tables(spark, SF001)
    path = scratch_path(spark, "t-snapshot")
    report = build_report(t, P)
    snapshot.replace_snapshot(spark, report, path, [P.rep])
    n, rename, calls = report.count(), snapshot._rename, []

    def stopping(*args):
        if len(calls) == stop_at:
            raise OSError("stopped")
        calls.append(args)
        rename(*args)

    monkeypatch.setattr(snapshot, "_rename", stopping)
    if stop_at == 2:
        monkeypatch.setattr(snapshot, "_delete", lambda *a: stopping() if "_aside" in a[1] else None)
    with pytest.raises(OSError, match="stopped"):
        snapshot.replace_snapshot(spark, report.limit(n - 1), path, [P.rep])
    monkeypatch.undo()
    snapshot.restore_snapshot(spark, path)
    assert snapshot.read_snapshot(spark, path).count() == (n if stop_at == 1 else n - 1)
    snapshot.replace_snapshot(spark, report, path, [P.rep])
    assert snapshot.read_snapshot(spark, path).count() == n
    assert not snapshot._exists(spark, f"{path}/_aside/{snapshot.REPORT_DATE_COLUMN}={P.rep}")


def test_scan_snapshot_prunes_partitions(spark):
    t = loan_tables(spark, SF001)
    path = scratch_path(spark, "t-snapshot")
    snapshot.replace_snapshot(spark, build_report_days(t, P.rep - dt.timedelta(days=2), P.rep, P), path,
                              [P.rep - dt.timedelta(days=i) for i in range(3)])
    df = snapshot.scan_snapshot(spark, path, P.rep)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tgl_pelaporan_data" in plan
    assert list(df.columns) == list(snapshot.EXPORT_COLUMNS)


EDGE = ["plain", "a|b", 'say "hi"', "line\nbreak", "cr\rhere", "crlf\r\nx", " lead", "trail ", "back\\slash", "", None]


def test_export_bytes_equal_python_csv(spark):
    rows = [(i, v, v) for i, v in enumerate(EDGE)]
    df = spark.createDataFrame(rows, "k int, a string, b string").repartition(3)
    from daybook.functions.text import csv_line

    lines = df.select(csv_line(F.col("k"), F.col("a"), F.col("b")).alias("line"))
    path = scratch_path(spark, "t-export")
    snapshot.write_export(lines, path, order_by=["line"])
    parts = sorted(glob.glob(os.path.join(local_dir(path), "part-*")))
    got = b"".join(open(p, "rb").read() for p in parts)

    def py_line(k, a, b):
        buf = io.StringIO(newline="")
        csv.DictWriter(buf, fieldnames=["k", "a", "b"], delimiter="|", quotechar='"',
                       quoting=csv.QUOTE_MINIMAL).writerow({"k": k, "a": a, "b": b})
        return buf.getvalue().encode("utf-8")

    want = b"".join(sorted(py_line(*r) for r in rows))
    assert got == want


def test_parallel_export_parts_concatenate_in_order(spark):
    df = spark.range(0, 5000, numPartitions=7).select(F.format_string("%06d", "id").alias("line"))
    path = scratch_path(spark, "t-export")
    snapshot.write_export(df, path, order_by=["line"])
    parts = sorted(glob.glob(os.path.join(local_dir(path), "part-*")))
    data = b"".join(open(p, "rb").read() for p in parts)
    assert data == b"".join(b"%06d\r\n" % i for i in range(5000))


def test_export_name_and_zero_padding(spark):
    df = spark.createDataFrame([(dt.date(2020, 6, 15), 1), (dt.date(2020, 6, 15), 100)], "d date, c int")
    names = [r[0] for r in df.select(snapshot.export_name(F.lit("820053"), F.col("d"), F.col("c"))).collect()]
    assert names == ["82005320200615SIK01", "82005320200615SIK100"]


def test_counter_upsert_and_read(spark):
    day = lambda n: dt.date(2020, 6, n)
    state = spark.createDataFrame([(day(1), 9), (day(2), 99), (day(4), 1)], "tgl_pelaporan_data date, counter int")
    inc = spark.createDataFrame([(day(1), 1), (day(2), 1), (day(3), 1)], "tgl_pelaporan_data date, increment int")
    new = {r[0]: r[1] for r in counter_upsert(state, inc).collect()}
    assert new == {day(1): 10, day(2): 100, day(3): 1, day(4): 1}
    days = spark.createDataFrame([(day(n),) for n in range(1, 6)], "tgl_pelaporan_data date")
    read = {r[0]: r[1] for r in counter_read(days, counter_upsert(state, inc)).collect()}
    assert read == {day(1): "10", day(2): "100", day(3): "01", day(4): "01", day(5): "00"}


def test_copies_expand_in_chunks(spark):
    from daybook.operators.joins import expand_copies

    df = spark.createDataFrame([(1, 7, 3), (2, None, None), (3, 1, 5)], "k int, c_copies long, e_copies long")
    got = {r.k: r["count"] for r in expand_copies(df, chunk=4).groupBy("k").count().collect()}
    assert got == {1: 21, 2: 1, 3: 5}
    big = spark.createDataFrame([(1, 100_000, 30)], "k int, c_copies long, e_copies long")
    assert expand_copies(big, chunk=1000).count() == 3_000_000
    huge = expand_copies(spark.createDataFrame([(1, 50_000, 50_000)], "k int, c_copies long, e_copies long"))
    assert huge.limit(5).count() == 5  # a count beyond 32 bits is no error


def test_report_day_is_yesterday_in_business_zone(spark):
    """A run at 16:59:59 UTC is still the same day in UTC+7; at 17:00 it is
    the next day there, so the report day moves with it."""
    import datetime as dt

    from daybook.functions.dates import report_day_of

    cases = [
        (dt.datetime(2020, 6, 15, 16, 59, 59), dt.date(2020, 6, 14)),
        (dt.datetime(2020, 6, 15, 17, 0, 0), dt.date(2020, 6, 15)),
        (dt.datetime(2020, 6, 15, 0, 0, 0), dt.date(2020, 6, 14)),
        (dt.datetime(2020, 12, 31, 23, 30, 0), dt.date(2020, 12, 31)),
    ]
    df = spark.createDataFrame([(c,) for c, _ in cases], "ts timestamp_ntz")
    assert [r[0] for r in df.select(report_day_of(F.col("ts"))).collect()] == [d for _, d in cases]
