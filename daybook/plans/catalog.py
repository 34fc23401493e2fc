"""Registered queries: one callable ``(spark, data_dir) -> DataFrame`` per
operator key of the inventory.

Every query reads the data directory's tables (or data Spark derives from
them and writes to the shared folder), so its work grows with the tables.
Results pass through ``comparable`` (decimals and dates as text)
so they compare one-to-one with the DuckDB oracles in ``oracles.py``.
"""

from __future__ import annotations

import base64
import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import decode, paths, protect
from daybook.functions.cache import cached
from daybook.functions.dates import epoch_micros, epoch_seconds, report_day_of
from daybook.operators import joins, manifest, surface
from daybook.functions.text import LINE_END
from daybook.operators.aggregates import daily_counts, daily_counts_sql
from daybook.operators.counter import counter_read, counter_upsert, runs_per_day
from daybook.operators.filters import REPORT_DATE_COLUMN, filter_last_days, filter_report_day
from daybook.params import ReportParams
from daybook.plans import client_jobs, key_jobs, snapshot
from daybook.plans.check import summary_message
from daybook.plans.present import comparable
from daybook.plans.report import (
    REPORT_COLUMNS,
    admitted_rows,
    build_report,
    build_report_days,
    reported_orders,
)
from daybook.session import scratch_path, sized_shuffles, tune
from daybook.sources import jdbc, partner, raw_text
from daybook.sources.config import config_lookup, long_config
from daybook.sources.loan_model import LoanTables, loan_tables
from daybook.sources.tables import read_table, table_path

P = ReportParams()
REP = P.rep
FIRST = REP - dt.timedelta(days=7)  # eight report days: one outside the 7-day window
WINDOW_FIRST = REP - dt.timedelta(days=6)
RUN_CUTOFF = "2024-01-08 00:00:00"  # events before it are the counter's old state
STAT_FILE = f"statistic_{P.partner}.json"


def _t(spark: SparkSession, sf: str) -> LoanTables:
    tune(spark)
    return loan_tables(spark, sf)


_STORED: dict[tuple, str] = {}  # the last written history of a context


def _history(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot table with eight report days, as a daily job leaves it:
    written once per session and state of the input files, then read with
    filters on its partition column."""
    t, sc = _t(spark, sf), spark.sparkContext
    key = (sc.applicationId, sc.startTime, sf, state := _state(spark, sf))
    if key not in _STORED:
        path = scratch_path(spark, "history")
        days = [FIRST + dt.timedelta(days=i) for i in range(8)]
        with sized_shuffles(spark, _bytes(state)):
            snapshot.replace_snapshot(spark, build_report_days(t, FIRST, REP, P), path, days)
        _STORED.clear()
        _STORED[key] = path
    schema = cached(("report_schema", sf), lambda: build_report(t, P).schema)
    return snapshot.read_snapshot(spark, _STORED[key], schema).select(*REPORT_COLUMNS)


def _state(spark: SparkSession, sf: str) -> tuple:
    """Names, sizes and times of the files of the tables behind the report.
    (One listing per table: as many entries as a scan of it would plan.)"""
    jvm, found = spark.sparkContext._jvm, []
    for name in ("orders", "customer", "lineitem"):
        path = jvm.org.apache.hadoop.fs.Path(table_path(sf, name))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)]
    return tuple(sorted(found))


def _bytes(state: tuple) -> int:
    return sum(size for _, size, _ in state)


def _report(spark: SparkSession, sf: str) -> DataFrame:
    return build_report(_t(spark, sf), P)


def _report_cols(*names: str):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return comparable(_report(spark, sf).select(*names))

    return q


# ---- A. scans and sources -------------------------------------------------
def q_report(spark, sf):
    return comparable(_report(spark, sf))


def q_scan_tables(spark, sf):
    t = _t(spark, sf)
    parts = [
        ("ordOrder", t.order),
        ("usrUser", t.user),
        ("ordHistory", t.history),
        ("ordBill", t.bill),
        ("ordDelayRecord", t.delay),
    ]
    out = None
    for name, df in parts:
        sums = [F.struct(F.lit(c).alias("column_name"), (F.count("*") - F.count(c)).alias("n_nulls"), F.sum(_checksum(df, c)).alias("checksum")) for c in df.columns]
        c = df.agg(F.count("*").alias("n_rows"), F.array(*sums).alias("columns"))
        c = c.select(F.lit(name).alias("table_name"), "n_rows", F.inline("columns"))
        out = c if out is None else out.unionByName(c)
    return out


def _checksum(df: DataFrame, column: str):
    """32 bits of the MD5 of a value's text."""
    kind, c = df.schema[column].dataType, F.col(column)
    text = F.replace(F.format_number(c, kind.scale), F.lit(","), F.lit("")) if isinstance(kind, T.DecimalType) else c.cast("string")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def q_config_lookup(spark, sf):
    """Config records: one key (the customer) with its attributes folded to a
    map; every key of the long table in one grouped job."""
    long = long_config(read_table(spark, sf, "customer"))
    folded = config_lookup(long)
    return folded.select(
        F.col("group"),
        F.size("attributes").alias("n_attributes"),
        F.array_join(
            F.transform(F.map_entries("attributes"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","
        ).alias("attributes_text"),
    )


# ---- B. sinks ---------------------------------------------------------------
def _written_snapshot(spark: SparkSession, sf: str) -> str:
    """Write the eight-day history, then rerun the last day (idempotence)."""
    t = _t(spark, sf)
    path = scratch_path(spark, "snapshot")
    days = [FIRST + dt.timedelta(days=i) for i in range(8)]
    with sized_shuffles(spark, _bytes(_state(spark, sf))):
        snapshot.replace_snapshot(spark, build_report_days(t, FIRST, REP, P), path, days)
        snapshot.replace_snapshot(spark, build_report(t, P), path, [REP])
    return path


def q_replace_snapshot(spark, sf):
    path = _written_snapshot(spark, sf)
    return comparable(snapshot.read_snapshot(spark, path).select(*REPORT_COLUMNS))


def q_scan_snapshot(spark, sf):
    path = _written_snapshot(spark, sf)
    return comparable(snapshot.scan_snapshot(spark, path, REP))


def q_export_projection(spark, sf):
    return comparable(snapshot.export_projection(_report(spark, sf)))


def _export_file(spark: SparkSession, sf: str) -> str:
    """The day's export as ordered parts."""
    lines = snapshot.export_lines(snapshot.export_projection(_report(spark, sf)), keep=("id_pinjaman",))
    return snapshot.write_export(lines, scratch_path(spark, "export"), order_by=["id_pinjaman", "line"])


def q_export_psv(spark, sf):
    """The export written with CRLF ends and read back line by line."""
    return partner.read_lines(spark, _export_file(spark, sf), LINE_END).select("line")


def q_read_result_text(spark, sf):
    """The export's parts decoded as text, line by line, with the bytes of
    each line."""
    lines = partner.read_lines(spark, _export_file(spark, sf), LINE_END)
    return lines.select(F.octet_length("line").cast("bigint").alias("length"), F.col("line").alias("text"))


def q_attachment_b64(spark, sf):
    """Each part of the export as an attachment, decoded back to its lines."""
    files = partner.read_files(spark, _export_file(spark, sf), glob="part-*")
    name = snapshot.export_name(F.lit(P.partner), F.lit(REP), F.lit(1))
    attached = partner.attachment_b64(files, F.concat(name, F.lit(".csv")))
    text = F.regexp_replace(F.unbase64("content").cast("string"), LINE_END + "$", "")
    return attached.where("content <> ''").select("filename", F.explode(F.split(text, LINE_END)).alias("line"))


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """Export runs: one per event, on the report day of its start time."""
    ev = read_table(spark, sf, "events")
    return ev.select("ts", report_day_of(F.col("ts")).alias(REPORT_DATE_COLUMN))


def _counter_state(spark: SparkSession, sf: str) -> DataFrame:
    runs = _runs(spark, sf)
    old = runs_per_day(runs.where(F.col("ts") < F.lit(RUN_CUTOFF).cast("timestamp_ntz"))).select(
        REPORT_DATE_COLUMN, F.col("increment").alias("counter")
    )
    new = runs_per_day(runs.where(F.col("ts") >= F.lit(RUN_CUTOFF).cast("timestamp_ntz")))
    return counter_upsert(old, new)


def q_counter_upsert(spark, sf):
    tune(spark)
    return comparable(_counter_state(spark, sf))


def q_counter_read(spark, sf):
    """Every calendar day from the first to the last run day plus one (so one
    day is always absent), read with its 2-digit counter."""
    tune(spark)
    state = _counter_state(spark, sf)
    bounds = state.agg(F.min(REPORT_DATE_COLUMN).alias("lo"), F.max(REPORT_DATE_COLUMN).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", F.date_add("hi", 1))).alias(REPORT_DATE_COLUMN))
    return comparable(counter_read(days, state))


def q_export_name(spark, sf):
    tune(spark)
    state = _counter_state(spark, sf)
    return comparable(
        state.select(
            REPORT_DATE_COLUMN,
            snapshot.export_name(F.lit(P.partner), F.col(REPORT_DATE_COLUMN), F.col("counter")).alias("export_name"),
        )
    )


def q_report_date(spark, sf):
    tune(spark)
    ev = read_table(spark, sf, "events")
    return comparable(ev.select("event_id", report_day_of(F.col("ts")).alias("report_day")))


# ---- C. projections -----------------------------------------------------------
q_proj_constants = _report_cols("id_pinjaman", "id", "id_penyelenggara", "jenis_pengguna", "no_npwp")
q_proj_identity = _report_cols("id_pinjaman", "id_borrower", "nama_borrower", "no_identitas")
q_proj_dates = _report_cols(
    "id_pinjaman", "tgl_perjanjian_borrower", "tgl_penyaluran_dana", "tgl_pelaporan_data", "tgl_update"
)
q_outstanding = _report_cols("id_pinjaman", "nilai_pendanaan", "sisa_pinjaman_berjalan")
q_due_date = _report_cols("id_pinjaman", "tgl_jatuh_tempo_pinjaman")
q_quality = _report_cols("id_pinjaman", "id_kualitas_pinjaman")
q_dpd = _report_cols("id_pinjaman", "status_pinjaman_dpd")
q_max_dpd = _report_cols("id_pinjaman", "status_pinjaman_max_dpd")
q_loan_status = _report_cols("id_pinjaman", "status_pinjaman")


# ---- D. filters -------------------------------------------------------------------
def q_filter_base(spark, sf):
    return reported_orders(_t(spark, sf).order).select("a_uuid", "a_status", "a_orderType")


def q_filter_population(spark, sf):
    rows = joins.expand_copies(admitted_rows(_t(spark, sf), P))
    return rows.select("a_uuid", "a_status", "a_orderType", "f_status")


def q_filter_report_day(spark, sf):
    return comparable(filter_report_day(_history(spark, sf), REP))  # one folder is read


def q_filter_last_7_days(spark, sf):
    return comparable(
        filter_last_days(_history(spark, sf), REP, 7).select(
            REPORT_DATE_COLUMN, "id_pinjaman", "status_pinjaman", "status_pinjaman_dpd"
        )
    )


# ---- E. joins ---------------------------------------------------------------------
def q_join_borrower(spark, sf):
    t = _t(spark, sf)
    return joins.join_borrower(reported_orders(t.order), t.user).select("a_uuid", "b_uuid", "b_realName")


def q_join_latest_history(spark, sf):
    t = _t(spark, sf)
    rows = joins.join_latest_history(reported_orders(t.order), joins.latest_agreement_rows(t.history))
    return joins.expand_copies(rows).select("a_uuid", "c_statusChangeTime")


def q_join_bills(spark, sf):
    t = _t(spark, sf)
    rows = joins.join_bills(reported_orders(t.order), t.bill)
    return comparable(
        rows.select(
            "a_uuid", "d_refundTime", "d_billAmout", "d1_refundTime", "d1_actualRefundTime",
            "d2_refundTime", "d2_actualRefundTime",
        )
    )


def q_join_extension(spark, sf):
    t = _t(spark, sf)
    rows = joins.join_extension(reported_orders(t.order), joins.extension_leg(t.delay, t.order))
    return comparable(
        joins.expand_copies(rows).select("a_uuid", "f_status", "f_amountApply", "f_refundTime", "f_actualRefundTime")
    )


# ---- F. aggregation -------------------------------------------------------------------
def q_max_in_group(spark, sf):
    return joins.latest_agreement_max(_t(spark, sf).history)


def q_daily_counts(spark, sf):
    return comparable(daily_counts(filter_last_days(_history(spark, sf), REP, 7)))


def q_order_by_ordinal(spark, sf):
    view = f"snapshot_{uuid.uuid4().hex[:8]}"
    _history(spark, sf).createOrReplaceTempView(view)
    return comparable(daily_counts_sql(spark, view, WINDOW_FIRST, REP))


def _stat_docs(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Statistic documents (one per ``by`` group, or one in all): a JSON array
    of one object with the row count per loan status, keys in status order.
    Each document folds at most one entry per status."""
    per_status = rows.groupBy(*by, "status_pinjaman").agg(F.count(F.lit(1)).cast("string").alias("n"))
    entries = F.array_sort(F.collect_list(F.struct(F.col("status_pinjaman"), F.col("n"))))
    return per_status.groupBy(*by).agg(F.to_json(F.array(F.map_from_entries(entries))).alias("doc"))


def q_read_stat_json(spark, sf):
    """Statistic documents: per report day of the history, plus every event's
    ``props`` read as a document (objects, not arrays: read as empty)."""
    tune(spark)
    docs = _stat_docs(_history(spark, sf), (REPORT_DATE_COLUMN,)).select(
        F.date_format(REPORT_DATE_COLUMN, "yyyy-MM-dd").alias("doc_id"), "doc"
    )
    ev = read_table(spark, sf, "events").select(F.col("event_id").cast("string").alias("doc_id"), F.col("props").alias("doc"))
    return partner.stat_pairs(docs.unionByName(ev), "doc", key_cols=("doc_id",))


def q_summary_message(spark, sf):
    tune(spark)
    hist = _history(spark, sf)
    counts = daily_counts(filter_last_days(hist, REP, 7))
    rep_rows = filter_report_day(hist, REP)
    ack = rep_rows.agg(F.concat(F.lit("received "), F.count(F.lit(1)).cast("string"), F.lit(" rows")).alias("text"))
    stat = partner.stat_pairs(_stat_docs(rep_rows), "doc")
    result_name = F.concat(snapshot.export_name(F.lit(P.partner), F.lit(REP), F.lit(1)), F.lit(".zip.out"))
    return summary_message(counts, result_name, ack, F.lit(STAT_FILE), stat)


QUERIES = {
    "report": q_report,
    "scan_tables": q_scan_tables,
    "scan_snapshot": q_scan_snapshot,
    "read_result_text": q_read_result_text,
    "read_stat_json": q_read_stat_json,
    "config_lookup": q_config_lookup,
    "replace_snapshot": q_replace_snapshot,
    "export_psv": q_export_psv,
    "export_name": q_export_name,
    "attachment_b64": q_attachment_b64,
    "proj_constants": q_proj_constants,
    "proj_identity": q_proj_identity,
    "proj_dates": q_proj_dates,
    "outstanding": q_outstanding,
    "due_date": q_due_date,
    "quality": q_quality,
    "dpd": q_dpd,
    "max_dpd": q_max_dpd,
    "loan_status": q_loan_status,
    "export_projection": q_export_projection,
    "filter_base": q_filter_base,
    "filter_population": q_filter_population,
    "filter_report_day": q_filter_report_day,
    "filter_last_7_days": q_filter_last_7_days,
    "join_borrower": q_join_borrower,
    "join_latest_history": q_join_latest_history,
    "join_bills": q_join_bills,
    "join_extension": q_join_extension,
    "max_in_group": q_max_in_group,
    "daily_counts": q_daily_counts,
    "order_by_ordinal": q_order_by_ordinal,
    "summary_message": q_summary_message,
    "counter_upsert": q_counter_upsert,
    "counter_read": q_counter_read,
    "report_date": q_report_date,
}


# ---- I. typed decoding of text columns ---------------------------------------------
def _decoded(raw_df: DataFrame, decoder) -> DataFrame:
    d = decoder(F.col("raw"))
    return comparable(raw_df.select("id", "raw", d["value"].alias("value"), d["reject"].alias("reject")))


def q_decode_datetime(spark, sf):
    tune(spark)
    return _decoded(raw_text.datetime_texts(read_table(spark, sf, "events")), decode.decode_datetime)


def q_decode_date(spark, sf):
    tune(spark)
    return _decoded(raw_text.date_texts(read_table(spark, sf, "orders")), decode.decode_date)


def q_decode_time_interval(spark, sf):
    tune(spark)
    return _decoded(raw_text.interval_texts(read_table(spark, sf, "events")), decode.decode_time_interval)


def q_decode_time_of_day(spark, sf):
    tune(spark)
    return _decoded(raw_text.time_texts(read_table(spark, sf, "events")), decode.decode_time_of_day)


def q_decode_compact_timestamp(spark, sf):
    tune(spark)
    return _decoded(raw_text.compact_texts(read_table(spark, sf, "events")), decode.decode_compact_timestamp)


def q_decode_set(spark, sf):
    tune(spark)
    raw = raw_text.set_texts(read_table(spark, sf, "pages"))
    members = decode.decode_set(F.col("raw"))
    return raw.select("id", F.size(members).alias("n_members"), F.array_join(members, "|").alias("members_text"))


def q_decode_numeric(spark, sf):
    tune(spark)
    raw = raw_text.numeric_texts(read_table(spark, sf, "orders"))
    d = decode.decode_numeric(F.col("raw"))
    return comparable(raw.select("id", "raw", d["as_int"].alias("as_int"), d["as_float"].alias("as_float"),
                                 d["as_decimal"].alias("as_decimal"), d["reject"].alias("reject")))


def q_decode_charset(spark, sf):
    tune(spark)
    raw = raw_text.charset_bytes(read_table(spark, sf, "documents"))
    d = decode.decode_charset(F.col("content"), F.col("charset"))
    return comparable(raw.select("id", "charset", d["value"].alias("value"), d["binary"].alias("binary"),
                                 d["reject"].alias("reject")))


def q_encode_temporal(spark, sf):
    tune(spark)
    ev = read_table(spark, sf, "events")
    secs = F.col("event_id") * 37 % 360000
    iv = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (secs + F.lit(0.25) * (F.col("event_id") % 4)).cast("decimal(16,6)"))
    iv = F.when(F.col("event_type") == "error", -iv).otherwise(iv)
    return ev.select(
        F.col("event_id").alias("id"),
        decode.encode_timestamp(F.col("ts")).alias("ts_text"),
        decode.encode_timestamp(F.date_trunc("second", F.col("ts"))).alias("ts_whole_text"),
        decode.encode_date(F.to_date("ts")).alias("date_text"),
        decode.encode_interval(iv).alias("interval_text"),
    )


def q_ticks_to_temporal(spark, sf):
    tune(spark)
    ev = read_table(spark, sf, "events")
    ticks = (epoch_micros(F.col("ts")).cast("decimal(20,0)") / 1_000_000).alias("ticks")  # decimal: exact to the microsecond
    t = ev.select(F.col("event_id").alias("id"), ticks)
    return comparable(t.select(
        "id",
        decode.ticks_to_timestamp(F.col("ticks"), "UTC").alias("as_timestamp"),
        decode.ticks_to_date(F.col("ticks"), "UTC").alias("as_date"),
        decode.ticks_to_time(F.col("ticks"), "UTC").alias("as_time"),
    ))


QUERIES.update({
    "decode_datetime": q_decode_datetime,
    "decode_date": q_decode_date,
    "decode_time_interval": q_decode_time_interval,
    "decode_time_of_day": q_decode_time_of_day,
    "decode_compact_timestamp": q_decode_compact_timestamp,
    "decode_set": q_decode_set,
    "decode_numeric": q_decode_numeric,
    "decode_charset": q_decode_charset,
    "encode_temporal": q_encode_temporal,
    "ticks_to_temporal": q_ticks_to_temporal,
})


# ---- L. column protection -------------------------------------------------------------
# Fixed test keys (parameters of the jobs, not secrets).
HMAC_KEY = b"daybook-test-hmac-key"
GCM_KEY = bytes(range(32))
GCM_AAD = b"customer"
TOKEN_KEY = base64.urlsafe_b64encode(bytes(range(32))).decode()
TOKEN_KEY_OLD = base64.urlsafe_b64encode(bytes(range(100, 132))).decode()
TOKEN_KEY_UNKNOWN = base64.urlsafe_b64encode(bytes(range(200, 232))).decode()
TOKEN_EPOCH = 1_700_000_000
TOKEN_NOW = "2024-01-15 00:00:00"
TOKEN_TTL = 7 * 86400


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    cust = read_table(spark, sf, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_name").alias("value")
    )
    docs = read_table(spark, sf, "documents").select(
        F.lit("documents").alias("source"), F.col("doc_id").alias("id"), F.col("text").alias("value")
    )
    return cust.unionByName(docs)


def q_digest_column(spark, sf):
    tune(spark)
    v = F.col("value")
    return _texts(spark, sf).select(
        "source", "id",
        protect.digest_column(v, "md5").alias("md5_hex"),
        protect.digest_column(v, "sha1").alias("sha1_hex"),
        protect.digest_column(v, "sha256").alias("sha256_hex"),
        protect.digest_column(v, "sha256", "base64").alias("sha256_b64"),
    )


def q_hmac_column(spark, sf):
    tune(spark)
    return _texts(spark, sf).select("source", "id", protect.hmac_column(F.col("value"), HMAC_KEY).alias("mac"))


def q_hmac_verify(spark, sf):
    tune(spark)
    macs = _texts(spark, sf).withColumn("mac", protect.hmac_column(F.col("value"), HMAC_KEY))
    normalized = F.regexp_replace(F.col("value"), "[ \t\n\r]+", " ")
    both = macs.withColumn("normalized_mac", protect.hmac_column(normalized, HMAC_KEY))
    return both.select(
        "source", "id",
        protect.hmac_verify(F.col("value"), F.col("mac"), HMAC_KEY).alias("ok_self"),
        protect.hmac_verify(F.concat(F.col("value"), F.lit(".")), F.col("mac"), HMAC_KEY).alias("ok_tampered"),
        # the MAC of the whitespace-normalized text verifies exactly when the
        # text has no whitespace runs, tabs or line breaks
        protect.hmac_verify(F.col("value"), F.col("normalized_mac"), HMAC_KEY).alias("ok_normalized"),
    )


def q_aes_gcm_column(spark, sf):
    tune(spark)
    cust = read_table(spark, sf, "customer")
    sealed = protect.aes_gcm_encrypt(F.encode(F.col("c_name"), "UTF-8"), GCM_KEY, GCM_AAD)
    checks = protect.bind(sealed, lambda b: F.struct(
        protect.aes_gcm_decrypt(b, GCM_KEY, GCM_AAD).cast("string").alias("roundtrip"),
        protect.aes_gcm_decrypt(b, GCM_KEY, b"other").isNull().alias("wrong_aad_rejected"),
        F.length(protect.aes_gcm_ciphertext(b)).alias("sealed_len"),
    ))
    return cust.select(F.col("c_custkey").alias("id"), checks.alias("c")).select("id", "c.*")


def _customer_tokens(spark: SparkSession, sf: str) -> DataFrame:
    cust = read_table(spark, sf, "customer")
    return cust.select(
        F.col("c_custkey").alias("id"), "c_name", "c_mktsegment",
        protect.token_encrypt(F.col("c_name"), TOKEN_KEY, F.lit(TOKEN_EPOCH) + F.col("c_custkey")).alias("token"),
    )


def q_token_encrypt(spark, sf):
    tune(spark)
    opened = protect.token_decrypt(F.col("token"), TOKEN_KEY)
    return _customer_tokens(spark, sf).select(
        "id", F.length("token").alias("token_len"), opened["value"].cast("string").alias("plain"),
        opened["seconds"].alias("seconds"),
    )


def q_token_timestamp(spark, sf):
    tune(spark)
    return _customer_tokens(spark, sf).select(
        "id",
        F.when(F.col("c_mktsegment") == "BUILDING", protect.token_timestamp(F.col("token"), TOKEN_KEY_OLD))
        .otherwise(protect.token_timestamp(F.col("token"), TOKEN_KEY)).alias("seconds"),
    )


def _event_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of ``events.props`` stamped with the event time; ``click`` events
    under the old key, ``error`` events under a key nobody holds."""
    ev = read_table(spark, sf, "events")
    secs = epoch_seconds(F.col("ts"))
    kind = F.col("event_type")
    token = (
        F.when(kind == "click", protect.token_encrypt(F.col("props"), TOKEN_KEY_OLD, secs))
        .when(kind == "error", protect.token_encrypt(F.col("props"), TOKEN_KEY_UNKNOWN, secs))
        .otherwise(protect.token_encrypt(F.col("props"), TOKEN_KEY, secs))
    )
    return ev.select(F.col("event_id").alias("id"), token.alias("token"))


def q_token_decrypt(spark, sf):
    tune(spark)
    now = epoch_seconds(F.lit(TOKEN_NOW).cast("timestamp_ntz"))
    opened = protect.token_decrypt(F.col("token"), TOKEN_KEY, ttl=TOKEN_TTL, now=now)
    return _event_tokens(spark, sf).select(
        "id", opened["value"].cast("string").alias("value"), opened["reason"].alias("reason")
    )


def q_token_rotate(spark, sf):
    tune(spark)
    rotated = protect.token_rotate(F.col("token"), [TOKEN_KEY, TOKEN_KEY_OLD])
    opened = protect.token_decrypt(rotated, TOKEN_KEY)
    return _event_tokens(spark, sf).select(
        "id", opened["value"].cast("string").alias("value"), opened["seconds"].alias("seconds")
    )


QUERIES.update({
    "digest_column": q_digest_column,
    "hmac_column": q_hmac_column,
    "hmac_verify": q_hmac_verify,
    "aes_gcm_column": q_aes_gcm_column,
    "token_encrypt": q_token_encrypt,
    "token_decrypt": q_token_decrypt,
    "token_timestamp": q_token_timestamp,
    "token_rotate": q_token_rotate,
})


# ---- K. file manifests ------------------------------------------------------------------
MIRROR_ROOT = "/mirror"
DIGEST_BLOCK = 4096
_HOST = r"^[a-z]+://([^/?#]+)"
_PATH = r"^[a-z]+://[^/?#]+(/[^?#]*)?"


def _page_paths(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages")
    return pages.select(
        "page_id",
        F.regexp_extract("url", _HOST, 1).alias("host"),
        F.regexp_extract("url", _PATH, 1).alias("path"),
    )


def _written_pages(spark: SparkSession, sf: str) -> str:
    """Every page's html written as text, one folder per host."""
    pages = read_table(spark, sf, "pages").select(F.regexp_extract("url", _HOST, 1).alias("host"), "html")
    path = scratch_path(spark, "pages")
    pages.write.mode("overwrite").partitionBy("host").text(path)
    return path


_FOLDER = r"^([^/]+)/"


def q_file_inventory(spark, sf):
    """The files of the per-host page tree, added up by folder (the names of
    part files and their times differ per run)."""
    tune(spark)
    inv = manifest.file_inventory(spark, _written_pages(spark, sf), glob="*.txt")
    return inv.groupBy(F.regexp_extract("relative_path", _FOLDER, 1).alias("relative_path")).agg(F.sum("size").alias("size"))


def q_manifest_reconcile(spark, sf):
    """Expected bytes per host folder (from the table) against the files
    actually written (from the listing).  By the length of the host's name,
    some folders are not expected, some expected a byte larger, and some
    expected again under a name that was never written."""
    tune(spark)
    inv = manifest.file_inventory(spark, _written_pages(spark, sf), glob="*.txt")
    actual = inv.groupBy(F.regexp_extract("relative_path", _FOLDER, 1).alias("relative_path")).agg(
        F.sum("size").alias("size"), F.max("mtime").alias("mtime")
    )
    pages = read_table(spark, sf, "pages")
    per_host = pages.groupBy(F.regexp_extract("url", _HOST, 1).alias("host")).agg(F.sum(F.octet_length("html") + 1).alias("size"))
    kind = F.length("host") % 5
    folder = F.concat(F.lit("host="), F.col("host"))
    expected = (
        per_host.where(kind != 0)
        .select(folder.alias("relative_path"), (F.col("size") + F.when(kind == 1, 1).otherwise(0)).alias("size"))
        .unionByName(per_host.where(kind == 2).select(F.concat(folder, F.lit(".gone")).alias("relative_path"), "size"))
        .withColumn("mtime", F.lit(None).cast("timestamp"))
    )
    return manifest.manifest_reconcile(expected, actual)


def q_reparent_paths(spark, sf):
    tune(spark)
    p = _page_paths(spark, sf)
    return p.select("page_id", paths.reparent(MIRROR_ROOT, F.col("path")).alias("new_path"),
                    paths.reparent("", F.concat("host", "path")).alias("relative_path"))


def q_path_ancestors(spark, sf):
    tune(spark)
    p = _page_paths(spark, sf)
    return p.select("page_id", F.posexplode(paths.path_prefixes(F.concat("host", "path"))).alias("pos", "ancestor")).select(
        "page_id", (F.col("pos") + 1).alias("depth"), "ancestor"
    )


def q_block_digests(spark, sf):
    tune(spark)
    docs = read_table(spark, sf, "documents")
    blocks = paths.block_digests(F.encode("text", "UTF-8"), "sha1", DIGEST_BLOCK)
    return docs.select("doc_id", F.posexplode(blocks).alias("block", "digest"))


QUERIES.update({
    "file_inventory": q_file_inventory,
    "reparent_paths": q_reparent_paths,
    "path_ancestors": q_path_ancestors,
    "manifest_reconcile": q_manifest_reconcile,
    "block_digests": q_block_digests,
})


# ---- J. query surface, and bulk text load -------------------------------------------
PARAM_SQL = (
    "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} "
    "WHERE o_orderpriority = %(prio)s AND o_totalprice > %(min_price)s"
)
PARAM_ARGS = {"prio": "1-URGENT", "min_price": 100000.0}
PAGE_OFFSET, PAGE_SIZE = 200, 100


def q_param_query(spark, sf):
    tune(spark)
    return surface.param_query(spark, PARAM_SQL, PARAM_ARGS, orders=read_table(spark, sf, "orders"))


def q_page_rows(spark, sf):
    tune(spark)
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return surface.page(orders, ["o_orderkey"], PAGE_OFFSET, PAGE_SIZE)


def q_dedupe_columns(spark, sf):
    """Orders, their borrower, delay record and follow-up order: ``uuid``,
    ``status`` and ``disabled`` occur several times."""
    t = _t(spark, sf)
    a = t.order.select("uuid", "userUuid", "status", "disabled").alias("a")
    b = t.user.select("uuid", "realName", "disabled").alias("b")
    e = t.delay.alias("e")
    f = t.order.select("uuid", "status", "disabled").alias("f")
    return surface.join_unique(
        [("ordOrder", a), ("usrUser", b), ("ordDelayRecord", e), ("ordOrder", f)],
        [F.col("a.userUuid") == F.col("b.uuid"), F.col("a.uuid") == F.col("e.orderNo"),
         F.col("e.delayOrderNo") == F.col("f.uuid")],
    )


def q_bulk_text_load(spark, sf):
    """The export file loaded back with its schema (dates as yyyyMMdd)."""
    path = _export_file(spark, sf)
    schema = _report(spark, sf).select(*snapshot.EXPORT_COLUMNS).schema
    return comparable(jdbc.bulk_text_load(spark, path, schema, date_format="yyyyMMdd"))


QUERIES.update({
    "param_query": q_param_query,
    "page_rows": q_page_rows,
    "dedupe_columns": q_dedupe_columns,
    "bulk_text_load": q_bulk_text_load,
})


# ---- table jobs of the client library ------------------------------------------------
QUERIES.update(client_jobs.QUERIES)
QUERIES.update(key_jobs.QUERIES)
