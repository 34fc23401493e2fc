"""The two daily jobs end to end: send twice, then check."""

import base64
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF001
from daybook.params import ReportParams
from daybook.plans import daily, snapshot
from daybook.plans.report import build_report
from daybook.session import scratch_path
from daybook.sources.loan_model import loan_tables
from tests_helpers import local_dir

P = ReportParams()


def _export(sent) -> bytes:
    """The parts of an export, one after the other."""
    folder = local_dir(sent.export_file)
    parts = sorted(x for x in os.listdir(folder) if x.startswith("part-"))
    return b"".join(open(os.path.join(folder, x), "rb").read() for x in parts)


def test_send_then_check(spark):
    t = loan_tables(spark, SF001)
    snap, counter = scratch_path(spark, "t-snap"), scratch_path(spark, "t-counter")
    export_dir, results = scratch_path(spark, "t-export"), scratch_path(spark, "t-results")

    first = daily.send(spark, t, P, snap, counter, export_dir)
    second = daily.send(spark, t, P, snap, counter, export_dir)
    assert first.export_name == "82005320200615SIK01"
    assert second.export_name == "82005320200615SIK02"

    data = _export(second)
    loans = [int(x.split(b"|")[6]) for x in data.split(b"\r\n")[:-1]]
    assert loans == sorted(loans)  # the parts follow each other in order
    lines = data.split(b"\r\n")
    assert lines[-1] == b""  # CRLF after every line
    want = snapshot.export_lines(snapshot.export_projection(build_report(t, P)))
    assert sorted(lines[:-1]) == sorted(r.line.encode() for r in want.collect())
    assert daily.counter_text(daily.read_counter(spark, counter), P.rep) == "02"
    assert daily.counter_text(daily.read_counter(spark, counter), P.asof) == "00"

    os.makedirs(local_dir(results), exist_ok=True)
    result_bytes = b"OK: all rows accepted\n"
    stat_bytes = b'[{"accepted": "475", "rejected": 0}]'
    with open(os.path.join(local_dir(results), second.export_name + ".zip.out"), "wb") as f:
        f.write(result_bytes)
    with open(os.path.join(local_dir(results), "statistic_820053.json"), "wb") as f:
        f.write(stat_bytes)

    out = daily.check(spark, P, snap, counter, results)
    message = out.message.first()["message"]
    n = build_report(t, P).count()
    assert f"<tr><td>2020-06-15</td> <td>{n}</td></tr>" in message
    assert "OK: all rows accepted" in message
    assert "accepted: 475<br/>rejected: 0<br/>" in message
    att = {r.filename: r.content for r in out.attachments.collect()}
    assert att == {
        second.export_name + ".zip.out": base64.b64encode(result_bytes).decode(),
        "statistic_820053.json": base64.b64encode(stat_bytes).decode(),
    }

    with open(os.path.join(local_dir(results), "statistic_820053.json"), "wb") as f:
        f.write(b"not json")
    message = daily.check(spark, P, snap, counter, results).message.first()["message"]
    assert message.endswith("statistic_820053.json:<br /><pre><div style='padding-left:2em'></div></pre></p>")


def test_send_with_empty_report_writes_empty_file(spark):
    import dataclasses

    t = loan_tables(spark, SF001)
    t = dataclasses.replace(t, order=t.order.limit(0))
    snap, counter, export_dir = (scratch_path(spark, n) for n in ("t-snap", "t-counter", "t-export"))
    sent = daily.send(spark, t, P, snap, counter, export_dir)
    assert _export(sent) == b""
    assert snapshot.read_snapshot(spark, snap, schema=build_report(t, P).schema).count() == 0
    results = scratch_path(spark, "t-results")
    os.makedirs(local_dir(results), exist_ok=True)
    # Empty result files are files: sections without rows, two attachments.
    for name in (sent.export_name + ".zip.out", "statistic_820053.json"):
        with pytest.raises(FileNotFoundError):
            daily.check(spark, P, snap, counter, results)
        open(os.path.join(local_dir(results), name), "wb").close()
    out = daily.check(spark, P, snap, counter, results, intro="Today.")
    message = out.message.first()["message"]
    assert message.startswith("Today.") and "<th>count</th></tr></table>" in message
    assert sorted(r.content for r in out.attachments.collect()) == ["", ""]


def test_counter_goes_on_after_a_failed_update(spark):
    path = scratch_path(spark, "t-counter")
    daily.bump_counter(spark, path, [P.rep])
    broken = spark.range(1).select(F.raise_error(F.lit("stopped")).cast("date").alias("tgl_pelaporan_data"), F.lit(1).alias("counter"))
    with pytest.raises(PySparkException):
        daily.write_counter(spark, path, broken)
    assert daily.counter_text(daily.read_counter(spark, path), P.rep) == "01"
    os.remove(os.path.join(local_dir(path), "v00000001", "_SUCCESS"))  # some committers write none
    daily.bump_counter(spark, path, [P.rep])
    assert daily.counter_text(daily.read_counter(spark, path), P.rep) == "02"


def test_last_value_of_a_repeated_key(spark):
    from daybook.sources.partner import stat_pairs

    docs = spark.createDataFrame([('[{"a": "1", "b": "2", "a": "3"}]',), ("[]",), ("x",)], "doc string")
    got = [(r.pos, r.key, r.value) for r in stat_pairs(docs).collect()]
    assert got == [(0, "a", "3"), (1, "b", "2"), (None, None, None), (None, None, None)]


def test_command_line_send_and_check(spark, capsys):
    """The jobs as a user runs them: operational tables stored as parquet."""
    import json

    from daybook.__main__ import main

    tables, snap, counter, export_dir, results = (
        scratch_path(spark, n) for n in ("t-tables", "t-snap", "t-counter", "t-export", "t-results")
    )
    assert main(["model", "--from-testdata", SF001, "--tables", tables]) == 0
    capsys.readouterr()
    assert main(["send", "--tables", tables, "--snapshot", snap, "--counter", counter, "--export-dir", export_dir,
                 "--asof", "2020-06-16"]) == 0
    sent = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert sent["export_name"] == "82005320200615SIK01"
    parts = [x for x in os.listdir(local_dir(sent["export_file"])) if x.startswith("part-")]
    n_lines = sum(open(os.path.join(local_dir(sent["export_file"]), x), "rb").read().count(b"\r\n") for x in parts)
    assert n_lines == build_report(loan_tables(spark, SF001), P).count()
    os.makedirs(local_dir(results), exist_ok=True)
    for name in (sent["export_name"] + ".zip.out", "statistic_820053.json"):
        with open(os.path.join(local_dir(results), name), "w") as f:
            f.write("[]")
    assert main(["check", "--snapshot", snap, "--counter", counter, "--results", results, "--asof", "2020-06-16"]) == 0
    checked = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert f"<tr><td>2020-06-15</td> <td>{n_lines}</td></tr>" in checked["message"]
    written = spark.read.json(checked["attachments"]).collect()
    assert sorted(r.filename for r in written) == sorted([sent["export_name"] + ".zip.out", "statistic_820053.json"])


def test_check_raises_on_a_result_file_that_is_not_utf8(spark):
    """The original logged and swallowed every error; here a bad partner file
    fails the check loudly."""
    t = loan_tables(spark, SF001)
    snap, counter, export_dir, results = (scratch_path(spark, n) for n in ("t-snap", "t-counter", "t-export", "t-res"))
    sent = daily.send(spark, t, P, snap, counter, export_dir)
    os.makedirs(local_dir(results), exist_ok=True)
    with open(os.path.join(local_dir(results), sent.export_name + ".zip.out"), "wb") as f:
        f.write(b"\xff\xfe not utf-8")
    open(os.path.join(local_dir(results), "statistic_820053.json"), "wb").close()
    with pytest.raises(PySparkException, match="MALFORMED_CHARACTER_CODING"):
        daily.check(spark, P, snap, counter, results).message.collect()


def test_history_follows_rewritten_tables(spark, tmp_path):
    """The stored history is built anew when the tables' files change."""
    from conftest import SF001
    from daybook.plans import catalog

    sf = str(tmp_path)
    for name in ("orders", "customer", "lineitem"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(f"{sf}/{name}.parquet")
    before = {r[0]: r[1] for r in catalog.QUERIES["daily_counts"](spark, sf).collect()}
    assert {r[0]: r[1] for r in catalog.QUERIES["daily_counts"](spark, sf).collect()} == before
    spark.read.parquet(f"{SF001}/orders.parquet").where("o_orderkey % 2 = 0").write.mode("overwrite").parquet(f"{sf}/orders.parquet")
    after = {r[0]: r[1] for r in catalog.QUERIES["daily_counts"](spark, sf).collect()}
    assert after.keys() == before.keys() and all(after[d] < before[d] for d in before)
