"""DuckDB oracle SQL for the registered queries.

Only the driver's tables are registered in DuckDB, so the loan model views are
inlined as CTEs (``daybook.sources.loan_model.ORACLE_MODEL_CTES``).  The report
logic is written independently here as plain SQL (the correlated maximum is a
pre-aggregated join).  Outputs are presented engine-neutrally: amounts as
text with their scale, dates as ISO text, integers with explicit widths, matching
``daybook.plans.present.comparable`` on the Spark side.
"""

from __future__ import annotations

import datetime as dt

from daybook.params import ReportParams
from daybook.sources.loan_model import MODEL_ASOF, oracle_model_ctes

MODEL = oracle_model_ctes(MODEL_ASOF)
OPEN = "IN (7, 8)"
PAID = "IN (10, 11)"


def between(later: str, earlier: str) -> str:
    return f"date_diff('day', CAST({earlier} AS DATE), CAST({later} AS DATE))"


def g0(*xs: str) -> str:
    return "greatest(" + ", ".join(f"coalesce({x}, 0)" for x in xs) + ", 0)"


def gnull(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE greatest({x}, 0) END"


def iso(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def with_model(*ctes: str) -> str:
    return "WITH " + MODEL + ",\n" + ",\n".join(c.strip() for c in ctes)


class ReportSQL:
    """The report of one day as DuckDB SQL, in named pieces."""

    def __init__(self, params: ReportParams | None = None):
        self.p = params or ReportParams()
        self.asof = self.p.asof.isoformat()
        self.rep = self.p.rep.isoformat()

    def late(self, x: str) -> str:
        return f"date_diff('day', CAST({x} AS DATE), DATE '{self.rep}')"

    # ---- CTE pieces -------------------------------------------------------
    candidates = """
a AS (
  SELECT uuid AS a_uuid, userUuid AS a_userUuid, status AS a_status, orderType AS a_orderType,
         amountApply AS a_amountApply, lendingTime AS a_lendingTime, refundTime AS a_refundTime,
         actualRefundTime AS a_actualRefundTime, updateTime AS a_updateTime
  FROM ordOrder WHERE disabled = 0 AND status IN (7, 8, 10, 11) AND orderType IN (0, 2, 3)),
cand AS (
  SELECT a.*,
         d.refundTime AS d_refundTime, d.actualRefundTime AS d_actualRefundTime, d.billAmout AS d_billAmout,
         d1.refundTime AS d1_refundTime, d1.actualRefundTime AS d1_actualRefundTime, d1.billAmout AS d1_billAmout,
         d2.refundTime AS d2_refundTime, d2.actualRefundTime AS d2_actualRefundTime, d2.billAmout AS d2_billAmout,
         f.status AS f_status, f.amountApply AS f_amountApply, f.refundTime AS f_refundTime,
         f.actualRefundTime AS f_actualRefundTime
  FROM a
  LEFT JOIN ordBill d ON a.a_uuid = d.orderNo AND a.a_orderType = 3 AND d.billTerm = 3
  LEFT JOIN ordBill d1 ON a.a_uuid = d1.orderNo AND a.a_orderType = 3 AND d1.billTerm = 1
  LEFT JOIN ordBill d2 ON a.a_uuid = d2.orderNo AND a.a_orderType = 3 AND d2.billTerm = 2
  LEFT JOIN ordDelayRecord e ON a.a_uuid = e.orderNo
  LEFT JOIN ordOrder f ON e.delayOrderNo = f.uuid)"""

    latest_history = """
hmax AS (
  SELECT orderId, max(updateTime) AS mx FROM ordHistory WHERE status = 20 AND disabled = 0 GROUP BY orderId),
c AS (
  SELECT h.orderId AS c_orderId, h.statusChangeTime AS c_statusChangeTime
  FROM ordHistory h JOIN hmax ON h.orderId = hmax.orderId AND h.updateTime = hmax.mx
  WHERE h.status = 20)"""

    def population(self) -> str:
        late, rep = self.late, self.rep
        return f"""(
     (CAST(a_updateTime AS DATE) = DATE '{rep}' AND a_orderType IN (0, 1))
  OR ({late('a_refundTime')} <= 91 AND a_status {OPEN} AND a_orderType = 0)
  OR ({late('f_refundTime')} <= 91 AND f_status {OPEN})
  OR (a_orderType = 3 AND a_status {PAID} AND CAST(a_actualRefundTime AS DATE) = DATE '{rep}')
  OR (a_orderType = 3 AND a_status {OPEN} AND {late('d_refundTime')} <= 91))"""

    def joined(self) -> str:
        return f"""
adm AS (SELECT * FROM cand WHERE {self.population()}),
joined AS (
  SELECT adm.*, c.c_statusChangeTime, b.uuid AS b_uuid, b.realName AS b_realName, b.idCardNo AS b_idCardNo
  FROM adm
  LEFT JOIN c ON adm.a_uuid = c.c_orderId
  JOIN usrUser b ON adm.a_userUuid = b.uuid
  WHERE b.disabled = 0),""" + self.derive("joined")

    def derive(self, source: str) -> str:
        """CTEs ``x``, ``y``: the due pick and the day differences of a joined row."""
        late, asof = self.late, self.asof
        return f"""
x AS (
  SELECT *,
         CASE WHEN TIMESTAMP '{asof}' > d_refundTime THEN d_refundTime
              WHEN TIMESTAMP '{asof}' > d2_refundTime THEN d2_refundTime
              ELSE d1_refundTime END AS due_ts,
         {late('a_refundTime')} AS a_late, {late('f_refundTime')} AS f_late,
         {between('a_actualRefundTime', 'a_refundTime')} AS a_paid_late,
         {between('f_actualRefundTime', 'f_refundTime')} AS f_paid_late
  FROM {source}),
y AS (SELECT *, {late('due_ts')} AS due_late FROM x)"""

    # ---- derived columns --------------------------------------------------
    def outstanding(self) -> str:
        return f"""CAST(CASE
    WHEN a_status {PAID} AND a_orderType IN (0, 3) THEN 0
    WHEN a_status {PAID} AND a_orderType = 2 AND f_status {OPEN} THEN f_amountApply
    WHEN a_status {OPEN} AND a_orderType = 0 THEN a_amountApply
    WHEN a_status {OPEN} AND a_orderType = 3 THEN
      CASE WHEN a_refundTime = d_refundTime THEN d_billAmout
           WHEN a_refundTime = d1_refundTime THEN d1_billAmout * 3
           ELSE d2_billAmout * 2 END
    ELSE 0 END AS DECIMAL(18,2))"""

    def due_date(self) -> str:
        return "CASE WHEN a_orderType <> 3 THEN CAST(a_refundTime AS DATE) ELSE CAST(due_ts AS DATE) END"

    def quality(self) -> str:
        return f"""CAST(CASE
    WHEN (a_status {PAID} AND a_paid_late < 30 AND a_orderType IN (0, 3))
      OR (a_status {OPEN} AND a_orderType = 0 AND a_late < 30)
      OR (a_status {OPEN} AND a_orderType = 3 AND due_late < 30)
      OR (a_status {PAID} AND f_status IN (7, 8, 10, 11) AND a_orderType = 2
          AND date_diff('day', CAST(f_refundTime AS DATE), CAST(coalesce(f_actualRefundTime, TIMESTAMP '{self.rep}') AS DATE)) < 30)
      THEN 1
    WHEN (a_status {PAID} AND coalesce(a_paid_late, 0) BETWEEN 30 AND 90 AND a_orderType IN (0, 3))
      OR (a_status {OPEN} AND a_late >= 30 AND a_late <= 90 AND a_orderType = 0)
      OR (a_status {OPEN} AND due_late >= 30 AND due_late <= 90 AND a_orderType = 3)
      OR (a_status {PAID} AND f_status {PAID} AND f_paid_late >= 30 AND f_paid_late <= 90 AND a_orderType = 2)
      OR (a_status {PAID} AND f_status {OPEN} AND f_late >= 30 AND f_late <= 90 AND a_orderType = 2)
      THEN 2
    ELSE 3 END AS INTEGER)"""

    def dpd(self) -> str:
        return f"""CAST(CASE
    WHEN a_status {OPEN} AND a_orderType = 0 THEN {gnull('a_late')}
    WHEN a_status {OPEN} AND a_orderType = 3 THEN {gnull('due_late')}
    WHEN a_status {PAID} AND a_orderType = 2 AND f_status {OPEN} THEN {g0('f_late')}
    WHEN a_status {PAID} AND a_orderType IN (0, 3) THEN {g0('a_paid_late')}
    WHEN a_status {PAID} AND a_orderType = 2 AND f_status {PAID} THEN {g0('f_paid_late')}
    ELSE 0 END AS INTEGER)"""

    def max_dpd(self) -> str:
        late = self.late
        d1_paid = between("d1_actualRefundTime", "d1_refundTime")
        d2_paid = between("d2_actualRefundTime", "d2_refundTime")
        return f"""CAST(CASE
    WHEN a_status {OPEN} AND a_orderType = 0 THEN {g0('a_late')}
    WHEN a_status {PAID} AND a_orderType = 2 AND f_status {OPEN} THEN
      CASE WHEN coalesce(f_late, 0) < a_paid_late THEN {g0('a_paid_late')} ELSE {g0('f_late')} END
    WHEN a_status {PAID} AND a_orderType = 0 THEN {g0('a_paid_late')}
    WHEN a_status {PAID} AND a_orderType = 2 AND f_status {PAID} THEN
      CASE WHEN {g0('f_paid_late')} < a_paid_late THEN {g0('a_paid_late')} ELSE {g0('f_paid_late')} END
    WHEN a_status {OPEN} AND a_orderType = 3 THEN
      CASE WHEN d1_actualRefundTime IS NULL THEN {g0(late('d1_refundTime'))}
           WHEN d2_actualRefundTime IS NULL THEN {g0(late('d2_refundTime'), d1_paid)}
           ELSE {g0(late('d_refundTime'), d1_paid, d2_paid)}
      END
    WHEN a_status {PAID} AND a_orderType = 3 THEN
      {g0(between('a_actualRefundTime', 'd_refundTime'), d2_paid, d1_paid)}
    ELSE 0 END AS INTEGER)"""

    def loan_status(self) -> str:
        return f"""CASE
    WHEN (a_status {PAID} AND a_orderType IN (0, 3)) OR (a_status {PAID} AND a_orderType = 2 AND f_status {PAID}) THEN 'L'
    WHEN (a_status {OPEN} AND a_orderType = 0 AND a_late <= 90)
      OR (a_status {OPEN} AND a_orderType = 3 AND {self.late('d_refundTime')} <= 90)
      OR (a_status {PAID} AND a_orderType = 2 AND f_late <= 90 AND f_status {OPEN}) THEN 'O'
    ELSE 'W' END"""

    def columns(self, date_fmt=None) -> dict[str, str]:
        """The 19 report columns, presented engine-neutrally (dates as ISO text
        unless ``date_fmt`` renders them otherwise)."""
        fmt = date_fmt or iso
        return {
            "id": "CAST(NULL AS BIGINT)",
            "id_penyelenggara": f"CAST({self.p.provider_id} AS INTEGER)",
            "id_borrower": "b_uuid",
            "jenis_pengguna": "CAST(1 AS INTEGER)",
            "nama_borrower": "b_realName",
            "no_identitas": "substring(b_idCardNo, 1, 16)",
            "no_npwp": "CAST(NULL AS VARCHAR)",
            "id_pinjaman": "a_uuid",
            "tgl_perjanjian_borrower": fmt("CAST(coalesce(c_statusChangeTime, a_lendingTime) AS DATE)"),
            "tgl_penyaluran_dana": fmt("CAST(a_lendingTime AS DATE)"),
            "nilai_pendanaan": "CAST(CAST(a_amountApply AS DECIMAL(18,2)) AS VARCHAR)",
            "tgl_pelaporan_data": fmt(f"DATE '{self.rep}'"),
            "sisa_pinjaman_berjalan": f"CAST({self.outstanding()} AS VARCHAR)",
            "tgl_jatuh_tempo_pinjaman": fmt(self.due_date()),
            "id_kualitas_pinjaman": self.quality(),
            "status_pinjaman_dpd": self.dpd(),
            "status_pinjaman_max_dpd": self.max_dpd(),
            "status_pinjaman": self.loan_status(),
            "tgl_update": fmt("CAST(a_updateTime AS DATE)"),
        }

    def select(self, names=None, extra: dict[str, str] | None = None, date_fmt=None, cols=None) -> str:
        cols = cols or self.columns(date_fmt)
        names = list(cols) if names is None else list(names)
        items = [f"{cols[n]} AS {n}" for n in names] + [f"{v} AS {k}" for k, v in (extra or {}).items()]
        return with_model(self.candidates, self.latest_history, self.joined()) + "\nSELECT " + ",\n  ".join(items) + "\nFROM y"

    def report(self) -> str:
        return self.select()


def report_sql(params: ReportParams | None = None) -> str:
    return ReportSQL(params).report()


def report_days_sql(first_rep: dt.date, last_rep: dt.date) -> str:
    """Union of independent daily reports (checks the one-plan backfill)."""
    parts = []
    d = first_rep
    while d <= last_rep:
        parts.append(f"SELECT * FROM ({report_sql(ReportParams.for_report_day(d))})")
        d += dt.timedelta(days=1)
    return "\nUNION ALL\n".join(parts)



# ---- registered query oracles ---------------------------------------------
P = ReportParams()
REP = P.rep
FIRST = REP - dt.timedelta(days=7)
WINDOW_FIRST = REP - dt.timedelta(days=6)
RUN_CUTOFF = "2024-01-08 00:00:00"
EXPORT_COLUMNS = [
    "id_penyelenggara", "id_borrower", "jenis_pengguna", "nama_borrower", "no_identitas", "no_npwp",
    "id_pinjaman", "tgl_perjanjian_borrower", "tgl_penyaluran_dana", "nilai_pendanaan",
    "tgl_pelaporan_data", "sisa_pinjaman_berjalan", "tgl_jatuh_tempo_pinjaman",
    "id_kualitas_pinjaman", "status_pinjaman_dpd", "status_pinjaman_max_dpd", "status_pinjaman",
]


def ymd(expr: str) -> str:
    return f"strftime({expr}, '%Y%m%d')"


def history(first: dt.date = FIRST, last: dt.date = REP) -> str:
    return f"({report_days_sql(first, last)})"


def zfill2(expr: str) -> str:
    return f"CASE WHEN length(CAST({expr} AS VARCHAR)) >= 2 THEN CAST({expr} AS VARCHAR) ELSE lpad(CAST({expr} AS VARCHAR), 2, '0') END"


def csv_field(expr: str) -> str:
    v = f"coalesce(CAST({expr} AS VARCHAR), '')"
    return f"""CASE WHEN regexp_matches({v}, '[|"\r\n]') THEN '"' || replace({v}, '"', '""') || '"' ELSE {v} END"""


def export_lines_sql() -> str:
    r = ReportSQL(P)
    cols = r.columns(date_fmt=ymd)
    # amounts as text keep their decimal scale (like str(Decimal))
    cols["nilai_pendanaan"] = "CAST(a_amountApply AS DECIMAL(18,2))"
    cols["sisa_pinjaman_berjalan"] = r.outstanding()
    line = " || '|' || ".join(csv_field(cols[c]) for c in EXPORT_COLUMNS)
    return r.select(names=[], extra={"line": line}, cols=cols)


RUNS = f"""runs AS (
  SELECT ts, CAST(ts + INTERVAL 7 HOUR AS DATE) - 1 AS day FROM events),
state AS (SELECT day, CAST(count(*) AS INTEGER) AS counter FROM runs GROUP BY day)"""


def stat_pairs_sql(docs: str) -> str:
    """Pairs of the first object of JSON-array documents ``docs(doc_id, doc)``."""
    return f"""WITH docs AS ({docs}),
parsed AS (
  SELECT doc_id, doc,
         CASE WHEN json_valid(doc) AND json_type(doc) = 'ARRAY' AND json_type(doc, '$[0]') = 'OBJECT'
              THEN json_keys(doc, '$[0]') END AS ks
  FROM docs),
pairs AS (
  SELECT doc_id, doc, unnest(ks) AS key, unnest(range(len(ks))) AS i FROM parsed WHERE len(ks) > 0)
SELECT doc_id, CAST(i AS INTEGER) AS pos, key,
       json_extract_string(doc, '$[0]."' || key || '"') AS value FROM pairs
UNION ALL
SELECT doc_id, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
FROM parsed WHERE ks IS NULL OR len(ks) = 0"""


def _oracles_a_to_h() -> dict[str, str]:
    r = ReportSQL(P)
    o: dict[str, str] = {}
    o["report"] = r.report()
    tables = {
        "ordOrder": "uuid userUuid disabled status orderType amountApply lendingTime refundTime actualRefundTime updateTime",
        "usrUser": "uuid realName idCardNo disabled",
        "ordHistory": "orderId status disabled updateTime statusChangeTime",
        "ordBill": "orderNo billTerm refundTime billAmout actualRefundTime",
        "ordDelayRecord": "orderNo delayOrderNo",
    }
    scans = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, '{c}' AS column_name, count(*) - count({c}) AS n_nulls, "
        f"CAST(sum(CAST('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 8) AS BIGINT)) AS BIGINT) AS checksum FROM {t}"
        for t, cols in tables.items() for c in cols.split()
    )
    o["scan_tables"] = with_model(f"n AS ({scans})") + "\nSELECT * FROM n"
    o["config_lookup"] = """WITH long AS (
  SELECT CAST(c_custkey AS VARCHAR) AS grp, 'name' AS name, c_name AS value FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'nation', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'segment', c_mktsegment FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'balance', CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) FROM customer)
SELECT grp AS "group", CAST(count(DISTINCT name) AS INTEGER) AS n_attributes,
       string_agg(name || '=' || value, ',' ORDER BY name) AS attributes_text
FROM long GROUP BY grp"""
    o["replace_snapshot"] = f"SELECT * FROM {history()}"
    o["scan_snapshot"] = r.select(EXPORT_COLUMNS)
    o["export_projection"] = r.select(EXPORT_COLUMNS, date_fmt=ymd)
    o["export_psv"] = export_lines_sql()
    o["read_result_text"] = f"SELECT CAST(octet_length(encode(line)) AS BIGINT) AS length, line AS text FROM ({export_lines_sql()})"
    o["attachment_b64"] = f"SELECT '{P.partner}{REP.strftime('%Y%m%d')}SIK01.csv' AS filename, line FROM ({export_lines_sql()})"
    o["counter_upsert"] = f"WITH {RUNS}\nSELECT CAST(day AS VARCHAR) AS tgl_pelaporan_data, counter FROM state"
    o["counter_read"] = f"""WITH {RUNS},
days AS (
  SELECT CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) + 1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
  FROM state)
SELECT CAST(days.day AS VARCHAR) AS tgl_pelaporan_data, coalesce({zfill2('state.counter')}, '00') AS counter_text
FROM days LEFT JOIN state ON days.day = state.day"""
    o["export_name"] = (
        f"WITH {RUNS}\nSELECT CAST(day AS VARCHAR) AS tgl_pelaporan_data, "
        f"'{P.partner}' || strftime(day, '%Y%m%d') || 'SIK' || {zfill2('counter')} AS export_name FROM state"
    )
    o["report_date"] = "SELECT event_id, CAST(CAST(ts + INTERVAL 7 HOUR AS DATE) - 1 AS VARCHAR) AS report_day FROM events"
    for key, names in {
        "proj_constants": ["id_pinjaman", "id", "id_penyelenggara", "jenis_pengguna", "no_npwp"],
        "proj_identity": ["id_pinjaman", "id_borrower", "nama_borrower", "no_identitas"],
        "proj_dates": ["id_pinjaman", "tgl_perjanjian_borrower", "tgl_penyaluran_dana", "tgl_pelaporan_data", "tgl_update"],
        "outstanding": ["id_pinjaman", "nilai_pendanaan", "sisa_pinjaman_berjalan"],
        "due_date": ["id_pinjaman", "tgl_jatuh_tempo_pinjaman"],
        "quality": ["id_pinjaman", "id_kualitas_pinjaman"],
        "dpd": ["id_pinjaman", "status_pinjaman_dpd"],
        "max_dpd": ["id_pinjaman", "status_pinjaman_max_dpd"],
        "loan_status": ["id_pinjaman", "status_pinjaman"],
    }.items():
        o[key] = r.select(names)
    o["filter_base"] = with_model(
        "s AS (SELECT uuid AS a_uuid, status AS a_status, orderType AS a_orderType FROM ordOrder "
        "WHERE disabled = 0 AND status IN (7, 8, 10, 11) AND orderType IN (0, 2, 3))"
    ) + "\nSELECT * FROM s"
    o["filter_population"] = (
        with_model(r.candidates) + f"\nSELECT a_uuid, a_status, a_orderType, f_status FROM cand WHERE {r.population()}"
    )
    o["filter_report_day"] = r.report()
    o["filter_last_7_days"] = (
        "SELECT tgl_pelaporan_data, id_pinjaman, status_pinjaman, status_pinjaman_dpd "
        f"FROM {history(WINDOW_FIRST, REP)}"
    )
    a_only = r.candidates.split("cand AS")[0].rstrip().rstrip(",")
    o["join_borrower"] = with_model(a_only) + (
        "\nSELECT a.a_uuid, b.uuid AS b_uuid, b.realName AS b_realName FROM a JOIN usrUser b "
        "ON a.a_userUuid = b.uuid WHERE b.disabled = 0"
    )
    o["join_latest_history"] = with_model(a_only, r.latest_history) + (
        "\nSELECT a.a_uuid, c.c_statusChangeTime FROM a LEFT JOIN c ON a.a_uuid = c.c_orderId"
    )
    o["join_bills"] = with_model(r.candidates) + (
        "\nSELECT a_uuid, d_refundTime, CAST(CAST(d_billAmout AS DECIMAL(18,2)) AS VARCHAR) AS d_billAmout, d1_refundTime, "
        "d1_actualRefundTime, d2_refundTime, d2_actualRefundTime FROM cand"
    )
    o["join_extension"] = with_model(r.candidates) + (
        "\nSELECT a_uuid, f_status, CAST(CAST(f_amountApply AS DECIMAL(18,2)) AS VARCHAR) AS f_amountApply, f_refundTime, f_actualRefundTime FROM cand"
    )
    o["max_in_group"] = with_model(r.latest_history.split("c AS")[0].rstrip().rstrip(",")) + (
        "\nSELECT orderId, mx AS maxUpdateTime FROM hmax"
    )
    counts = (
        f"SELECT tgl_pelaporan_data, count(*) AS count FROM {history()} "
        f"WHERE tgl_pelaporan_data BETWEEN '{WINDOW_FIRST}' AND '{REP}' GROUP BY tgl_pelaporan_data"
    )
    o["daily_counts"] = counts
    o["order_by_ordinal"] = counts + " ORDER BY 1"
    day_docs = f"""SELECT tgl_pelaporan_data AS doc_id,
         '[{{' || string_agg('"' || status_pinjaman || '":"' || n || '"', ',' ORDER BY status_pinjaman) || '}}]' AS doc
  FROM (SELECT tgl_pelaporan_data, status_pinjaman, count(*) AS n FROM {history()} GROUP BY ALL)
  GROUP BY tgl_pelaporan_data
  UNION ALL SELECT CAST(event_id AS VARCHAR), props FROM events"""
    o["read_stat_json"] = stat_pairs_sql(day_docs)
    name = f"{P.partner}{REP.strftime('%Y%m%d')}SIK01.zip.out"
    o["summary_message"] = f"""WITH hist AS (SELECT * FROM {history()}),
counts AS (SELECT tgl_pelaporan_data AS d, count(*) AS n FROM hist
           WHERE tgl_pelaporan_data BETWEEN '{WINDOW_FIRST}' AND '{REP}' GROUP BY 1),
rep AS (SELECT * FROM hist WHERE tgl_pelaporan_data = '{REP}'),
st AS (SELECT status_pinjaman AS s, count(*) AS n FROM rep GROUP BY 1)
SELECT 'Results of the last report.<br /><br />'
    || '<table style=''width: 30%;'' border=''2'' cellpadding=''1''>'
    || '<tr><th>tanggal</th> <th>count</th></tr>'
    || (SELECT string_agg('<tr><td>' || d || '</td> <td>' || n || '</td></tr>', '' ORDER BY d) FROM counts)
    || '</table><p>{name}:<br /> <pre><div style=''padding-left:2em''>'
    || (SELECT 'received ' || count(*) || ' rows' FROM rep)
    || '</div></pre></p><p>statistic_{P.partner}.json:<br /><pre><div style=''padding-left:2em''>'
    || (SELECT string_agg(s || ': ' || n || '<br/>', '' ORDER BY s) FROM st)
    || '</div></pre></p>' AS message"""
    return o


# ---- I. typed decoding ------------------------------------------------------
# The accepted text shapes, stated here on their own.
_FRACTION = r"(?:.(\d{1,6}))?"
DT_P = r"^(\d{1,4})-(\d{1,2})-(\d{1,2})[T ](\d{1,2}):(\d{1,2}):(\d{1,2})" + _FRACTION
IV_P = r"^(-)?(\d{1,3}):(\d{1,2}):(\d{1,2})" + _FRACTION
TOD_P = r"^(\d{1,2}):(\d{1,2}):(\d{1,2})" + _FRACTION


def _g(raw: str, pattern: str, i: int) -> str:
    return f"regexp_extract({raw}, '{pattern}', {i})"


def _gi(raw: str, pattern: str, i: int) -> str:
    return f"CAST({_g(raw, pattern, i)} AS BIGINT)"


def _frac_us(raw: str, pattern: str, i: int) -> str:
    return f"CAST(rpad(CASE WHEN {_g(raw, pattern, i)} = '' THEN '0' ELSE {_g(raw, pattern, i)} END, 6, '0') AS BIGINT)"


def sql_date_value(raw: str) -> str:
    part = lambda i: f"TRY_CAST(trim(string_split({raw}, '-')[{i}]) AS BIGINT)"
    return (
        f"CASE WHEN regexp_matches({raw}, '^\\s*\\+?[0-9]+\\s*-\\s*\\+?[0-9]+\\s*-\\s*\\+?[0-9]+\\s*$') "
        f"THEN CAST(try_strptime(printf('%04d-%02d-%02d', {part(1)}, {part(2)}, {part(3)}), '%Y-%m-%d') AS DATE) END"
    )


def sql_datetime_value(raw: str) -> str:
    g = [_gi(raw, DT_P, i) for i in range(1, 7)]
    text = f"printf('%04d-%02d-%02d %02d:%02d:%02d.%06d', {', '.join(g)}, {_frac_us(raw, DT_P, 7)})"
    ts = f"CASE WHEN regexp_matches({raw}, '{DT_P}') THEN try_strptime({text}, '%Y-%m-%d %H:%M:%S.%f') END"
    return f"coalesce({ts}, CAST({sql_date_value(raw)} AS TIMESTAMP))"


def _decoded(raw_sql: str, value: str) -> str:
    return f"SELECT id, raw, value, CASE WHEN value IS NULL THEN raw END AS reject FROM (SELECT id, raw, {value} AS value FROM ({raw_sql}))"


RAW_DATETIME = """SELECT event_id AS id, CASE event_type
  WHEN 'error' THEN strftime(ts, '%Y') || '-02-31 ' || strftime(ts, '%H:%M:%S')
  WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.') || substr(strftime(ts, '%f'), 1, 3)
  WHEN 'signup' THEN strftime(ts, '%Y-%m-%d')
  WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC'
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS raw FROM events"""

RAW_DATE = """SELECT o_orderkey AS id, CASE o_orderpriority
  WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y') || '-02-31'
  WHEN '2-HIGH' THEN '0000-00-00'
  WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y') || '-' || CAST(month(o_orderdate) AS VARCHAR) || '-' || CAST(day(o_orderdate) AS VARCHAR)
  WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m')
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw FROM orders"""


def _hms_sql(secs: str, minute_offset: int = 0) -> str:
    return f"printf('%d:%02d:%02d', {secs} // 3600, ({secs} // 60) % 60 + {minute_offset}, {secs} % 60)"


_SECS = "(event_id * 37 % 360000)"
RAW_INTERVAL = f"""SELECT event_id AS id, CASE event_type
  WHEN 'error' THEN '-' || {_hms_sql(_SECS)}
  WHEN 'click' THEN {_hms_sql(_SECS)} || '.' || strftime(ts, '%f')
  WHEN 'signup' THEN 'n/a'
  WHEN 'purchase' THEN {_hms_sql(_SECS, 60)}
  ELSE {_hms_sql(_SECS)} END AS raw FROM events"""

RAW_TIME = """SELECT event_id AS id, CASE event_type
  WHEN 'error' THEN '-' || strftime(ts, '%H:%M:%S')
  WHEN 'click' THEN '24:' || strftime(ts, '%M:%S')
  WHEN 'signup' THEN strftime(ts, '%H:%M')
  WHEN 'purchase' THEN CAST(hour(ts) AS VARCHAR) || ':' || CAST(minute(ts) AS VARCHAR) || ':'
                       || CAST(second(ts) AS VARCHAR) || '.' || substr(strftime(ts, '%f'), 1, 3)
  ELSE strftime(ts, '%H:%M:%S.%f') END AS raw FROM events"""

RAW_COMPACT = """SELECT event_id AS id, CASE event_type
  WHEN 'click' THEN strftime(ts, '%Y%m%d%H')
  WHEN 'signup' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
  WHEN 'error' THEN strftime(ts, '%Y') || '0231' || strftime(ts, '%H%M%S')
  WHEN 'purchase' THEN strftime(ts, '%Y%m%d') || 'xx'
  ELSE strftime(ts, '%Y%m%d%H%M%S') END AS raw FROM events"""

RAW_NUMERIC = """SELECT o_orderkey AS id, CASE o_orderpriority
  WHEN '1-URGENT' THEN printf('%.2f', o_totalprice) || CASE o_orderkey % 3 WHEN 0 THEN 'x' WHEN 1 THEN 'd' ELSE '' END
  WHEN '2-HIGH' THEN CASE o_orderkey % 3 WHEN 0 THEN CAST(9223372036854775807 + CAST(o_orderkey % 2 AS HUGEINT) AS VARCHAR)
    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END
  WHEN '3-MEDIUM' THEN '  ' || printf('%.2f', o_totalprice) || CASE o_orderkey % 2 WHEN 0 THEN '0123456789012 ' ELSE ' ' END
  WHEN '4-NOT SPECIFIED' THEN CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '123456789012345678901234567890' || '.5' ELSE '0.' || repeat('1', 20) END
  ELSE printf('%.2f', o_totalprice) || CASE o_orderkey % 2 WHEN 0 THEN 'e1' ELSE '' END END AS raw FROM orders"""


def _oracles_i() -> dict[str, str]:
    o: dict[str, str] = {}
    o["decode_datetime"] = _decoded(RAW_DATETIME, sql_datetime_value("raw"))
    o["decode_date"] = (
        "SELECT id, raw, CAST(value AS VARCHAR) AS value, CASE WHEN value IS NULL THEN raw END AS reject "
        f"FROM (SELECT id, raw, {sql_date_value('raw')} AS value FROM ({RAW_DATE}))"
    )
    sign = f"CASE WHEN {_g('raw', IV_P, 1)} = '-' THEN -1 ELSE 1 END"
    iv_us = (
        f"CASE WHEN regexp_matches(raw, '{IV_P}') THEN {sign} * (({_gi('raw', IV_P, 2)} * 3600 + "
        f"{_gi('raw', IV_P, 3)} * 60 + {_gi('raw', IV_P, 4)}) * 1000000 + {_frac_us('raw', IV_P, 5)}) END"
    )
    o["decode_time_interval"] = _decoded(RAW_INTERVAL, iv_us)
    h, m, sec = (_gi("raw", TOD_P, i) for i in (1, 2, 3))
    tod_us = (
        f"CASE WHEN regexp_matches(raw, '{TOD_P}') AND {h} < 24 AND {m} < 60 AND {sec} < 60 "
        f"THEN ({h} * 3600 + {m} * 60 + {sec}) * 1000000 + {_frac_us('raw', TOD_P, 4)} END"
    )
    o["decode_time_of_day"] = _decoded(RAW_TIME, tod_us)
    compact = (
        f"CASE WHEN substr(raw, 5, 1) = '-' THEN {sql_datetime_value('raw')} "
        "WHEN length(raw) >= 5 AND regexp_matches(rpad(raw, 14, '0'), '^[0-9]{14}$') "
        "THEN try_strptime(rpad(raw, 14, '0'), '%Y%m%d%H%M%S') END"
    )
    o["decode_compact_timestamp"] = _decoded(RAW_COMPACT, compact)
    o["decode_set"] = """SELECT id, CAST(len(m) AS INTEGER) AS n_members, array_to_string(m, '|') AS members_text
FROM (SELECT page_id AS id,
             list_sort(list_distinct(string_split(regexp_replace(url, '[/?#&=.:]+', ',', 'g'), ','))) AS m
      FROM pages)"""
    number = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"
    # Exact in 38 digits, 18 of them after the point; all exponents here are 1.
    power = "CASE WHEN raw LIKE '%e1%' THEN 1 ELSE 0 END"
    before = r"length(regexp_extract(trim(raw), '^[+-]?0*([0-9]*)', 1))"
    after = r"length(regexp_replace(regexp_extract(trim(raw), '\.([0-9]*)', 1), '0+$', ''))"
    exact = f"regexp_matches(raw, {number}) AND {before} + {power} <= 20 AND {after} - {power} <= 18"
    mantissa = "CAST(trim(regexp_replace(raw, 'e1', '')) AS DECIMAL(38,18))"
    o["decode_numeric"] = f"""SELECT *, CASE WHEN as_decimal IS NULL OR (whole AND as_int IS NULL) THEN raw END AS reject FROM (
SELECT id, raw, regexp_matches(raw, '^\\s*[+-]?[0-9]+\\s*$') AS whole,
  CASE WHEN regexp_matches(raw, '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST(trim(raw) AS BIGINT) END AS as_int,
  CASE WHEN regexp_matches(raw, {number}) THEN TRY_CAST(trim(raw) AS DOUBLE) END AS as_float,
  CASE WHEN {exact} THEN CAST(CASE WHEN {power} = 1 THEN CAST({mantissa} * 10 AS DECIMAL(38,18)) ELSE {mantissa} END AS VARCHAR) END AS as_decimal
FROM ({RAW_NUMERIC}))"""
    o["decode_numeric"] = f"SELECT id, raw, as_int, as_float, as_decimal, reject FROM ({o['decode_numeric']})"
    o["decode_charset"] = """SELECT id, charset, value,
  CASE WHEN charset = 'binary' THEN hex(encode(text)) END AS "binary",
  CASE WHEN charset <> 'binary' AND value IS NULL THEN hex(encode(text)) END AS reject
FROM (SELECT doc_id AS id, text, charset,
        CASE WHEN charset IN ('utf8mb4', 'utf8mb3') THEN text
             WHEN charset = 'ascii' AND regexp_matches(text, '^[\\x00-\\x7F]*$') THEN text END AS value
      FROM (SELECT *, CASE lang WHEN 'en' THEN 'utf8mb4' WHEN 'de' THEN 'ascii' WHEN 'fr' THEN 'binary'
                                WHEN 'es' THEN 'koi8r' ELSE 'utf8mb3' END AS charset FROM documents))"""
    us = "(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END * ((event_id * 37 % 360000) * 1000000 + 250000 * (event_id % 4)))"
    secs = f"CAST(floor({us} / 1000000.0) AS BIGINT)"
    frac = f"((({us}) % 1000000) + 1000000) % 1000000"
    base = (
        f"printf('%02d:%02d:%02d', CAST(floor({secs} / 3600.0) AS BIGINT), "
        f"(((CAST(floor({secs} / 60.0) AS BIGINT)) % 60) + 60) % 60, (({secs} % 60) + 60) % 60)"
    )
    o["encode_temporal"] = f"""SELECT event_id AS id,
  CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts_text,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts_whole_text,
  strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date_text,
  CASE WHEN {frac} = 0 THEN {base} ELSE {base} || printf('.%06d', {frac}) END AS interval_text
FROM events"""
    o["ticks_to_temporal"] = """SELECT id, t AS as_timestamp, CAST(CAST(t AS DATE) AS VARCHAR) AS as_date,
  (hour(t) * 3600 + minute(t) * 60 + second(t)) * 1000000 AS as_time
FROM (SELECT event_id AS id, make_timestamp(CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) * 1000000) AS t FROM events)"""
    return o


# ---- L. column protection ---------------------------------------------------
TEXTS = """SELECT 'customer' AS source, c_custkey AS id, c_name AS value FROM customer
UNION ALL SELECT 'documents', doc_id, text FROM documents"""


def _oracles_l() -> dict[str, str]:
    from daybook.plans.catalog import HMAC_KEY, TOKEN_EPOCH, TOKEN_NOW, TOKEN_TTL

    padded = HMAC_KEY.ljust(64, b"\0")  # shorter than a block
    ipad, opad = (bytes(b ^ x for b in padded).hex() for x in (0x36, 0x5C))
    mac = f"sha256(from_hex('{opad}') || from_hex(sha256(from_hex('{ipad}') || encode(value))))"
    now = int(dt.datetime.fromisoformat(TOKEN_NOW).replace(tzinfo=dt.timezone.utc).timestamp())
    secs = "CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT)"
    o: dict[str, str] = {}
    o["digest_column"] = f"""SELECT source, id, md5(value) AS md5_hex, sha1(value) AS sha1_hex, sha256(value) AS sha256_hex,
  to_base64(from_hex(sha256(value))) AS sha256_b64 FROM ({TEXTS})"""
    o["hmac_column"] = f"SELECT source, id, {mac} AS mac FROM ({TEXTS})"
    o["hmac_verify"] = (
        "SELECT source, id, true AS ok_self, false AS ok_tampered, "
        r"value = regexp_replace(value, '[ \t\n\r]+', ' ', 'g') AS ok_normalized "
        f"FROM ({TEXTS})"
    )
    o["aes_gcm_column"] = """SELECT c_custkey AS id, c_name AS roundtrip, true AS wrong_aad_rejected,
  CAST(octet_length(encode(c_name)) + 16 AS INTEGER) AS sealed_len FROM customer"""
    o["token_encrypt"] = f"""SELECT c_custkey AS id,
  CAST(4 * ((57 + 16 * (octet_length(encode(c_name)) // 16 + 1) + 2) // 3) AS INTEGER) AS token_len,
  c_name AS plain, {TOKEN_EPOCH} + c_custkey AS seconds FROM customer"""
    o["token_timestamp"] = f"""SELECT c_custkey AS id,
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE {TOKEN_EPOCH} + c_custkey END AS seconds FROM customer"""
    o["token_decrypt"] = f"""SELECT id, CASE WHEN reason IS NULL THEN props END AS value, reason FROM (
  SELECT event_id AS id, props,
    CASE WHEN {secs} + {TOKEN_TTL} < {now} THEN 'expired'
         WHEN {now} + 60 < {secs} THEN 'future'
         WHEN event_type IN ('click', 'error') THEN 'bad_signature' END AS reason
  FROM events)"""
    o["token_rotate"] = f"""SELECT event_id AS id, CASE WHEN event_type = 'error' THEN NULL ELSE props END AS value,
  CASE WHEN event_type = 'error' THEN NULL ELSE {secs} END AS seconds FROM events"""
    return o


# ---- K. file manifests --------------------------------------------------------
PAGE_PATHS = """SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
  regexp_extract(url, '^[a-z]+://[^/?#]+(/[^?#]*)?', 1) AS path FROM pages"""


def _reparent_sql(parent: str, p: str) -> str:
    rel = f"CASE WHEN substr({p}, 1, 1) IN ('/', '\\') THEN '.' || {p} ELSE {p} END"
    if parent == "":
        return rel
    return f"'{parent.rstrip('/')}/' || {rel}"


def _oracles_k() -> dict[str, str]:
    o: dict[str, str] = {}
    o["reparent_paths"] = (
        f"SELECT page_id, {_reparent_sql('/mirror', 'path')} AS new_path, "
        f"{_reparent_sql('', 'host || path')} AS relative_path FROM ({PAGE_PATHS})"
    )
    o["path_ancestors"] = f"""SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) AS INTEGER) AS depth, ancestor
FROM (SELECT page_id, i, array_to_string(parts[1:i], '/') AS ancestor
      FROM (SELECT page_id, parts, unnest(generate_series(1, len(parts))) AS i
            FROM (SELECT page_id, string_split(host || path, '/') AS parts FROM ({PAGE_PATHS}))))
WHERE ancestor <> ''"""
    hosts = "SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, CAST(sum(octet_length(encode(html)) + 1) AS BIGINT) AS size FROM pages GROUP BY 1"
    o["file_inventory"] = f"SELECT 'host=' || host AS relative_path, size FROM ({hosts})"
    o["manifest_reconcile"] = f"""WITH h AS (SELECT *, length(host) % 5 AS kind FROM ({hosts}))
SELECT 'host=' || host AS relative_path, CASE WHEN kind = 0 THEN NULL WHEN kind = 1 THEN size + 1 ELSE size END AS source_size,
  size AS target_size, CASE kind WHEN 0 THEN 'extra' WHEN 1 THEN 'size_mismatch' ELSE 'ok' END AS status FROM h
UNION ALL SELECT 'host=' || host || '.gone', size, NULL, 'missing' FROM h WHERE kind = 2"""
    n = 4096
    o["block_digests"] = f"""SELECT doc_id, CAST(b AS INTEGER) AS block,
  sha1(from_hex(substring(h, b * {2 * n} + 1, {2 * n}))) AS digest
FROM (SELECT doc_id, h, unnest(generate_series(0, CAST(ceil(length(h) / {2 * n}) AS BIGINT) - 1)) AS b
      FROM (SELECT doc_id, hex(encode(text)) AS h FROM documents))"""
    return o


# ---- J. query surface, bulk load -------------------------------------------------
def _oracles_j() -> dict[str, str]:
    r = ReportSQL(P)
    o: dict[str, str] = {}
    o["param_query"] = """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 100000.0"""
    o["page_rows"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 200"
    o["dedupe_columns"] = with_model("j AS (SELECT 1)") + """
SELECT a.uuid AS "uuid", a.userUuid AS "userUuid", a.status AS "status", a.disabled AS "disabled",
       b.uuid AS "usrUser.uuid", b.realName AS "realName", b.disabled AS "usrUser.disabled",
       e.orderNo AS "orderNo", e.delayOrderNo AS "delayOrderNo",
       f.uuid AS "ordOrder.uuid", f.status AS "ordOrder.status", f.disabled AS "ordOrder.disabled"
FROM ordOrder a JOIN usrUser b ON a.userUuid = b.uuid
JOIN ordDelayRecord e ON a.uuid = e.orderNo JOIN ordOrder f ON e.delayOrderNo = f.uuid"""
    o["bulk_text_load"] = r.select(EXPORT_COLUMNS, extra={"_corrupt_record": "CAST(NULL AS VARCHAR)"})
    return o


# ---- table jobs of the client library ----------------------------------------------
def _quoted(text: str) -> str:
    for plain, form in (("chr(92)", "chr(92) || chr(92)"), ("chr(10)", "chr(92) || 'n'"), ("chr(13)", "chr(92) || 'r'"),
                        ("chr(26)", "chr(92) || 'Z'"), ("chr(34)", "chr(92) || chr(34)"), ("chr(39)", "chr(92) || chr(39)")):
        text = f"replace({text}, {plain}, {form})"
    return f"chr(39) || {text} || chr(39)"


def _statements(limit: int, k: int) -> str:
    """Greedy packing, one statement after the other."""
    return f"""
n{k} AS MATERIALIZED (
  SELECT t.rn, greatest(coalesce(b.rn, (SELECT max(rn) + 1 FROM t)), t.rn + 1) AS after
  FROM t ASOF LEFT JOIN (SELECT rn, upto FROM t) b ON t.upto - t.size + {limit} - (SELECT length(pre) + length(post) - 1 FROM c) < b.upto),
s{k} AS (
  SELECT 1 AS rn, 0 AS statement
  UNION ALL SELECT n{k}.after, statement + 1 FROM s{k} JOIN n{k} USING (rn) WHERE n{k}.after <= (SELECT max(rn) FROM t)),
m{k} AS (
  SELECT {limit}::BIGINT AS max_bytes, statement::BIGINT AS statement, count(*)::BIGINT AS n_rows,
    (SELECT pre FROM c) || string_agg(v, ',' ORDER BY t.rn) || (SELECT post FROM c) AS sql
  FROM t ASOF JOIN s{k} ON t.rn >= s{k}.rn GROUP BY statement)"""


def _oracles_client() -> dict[str, str]:
    from daybook.plans.client_jobs import STATEMENT_BYTES, STATEMENT_POSTFIX

    o: dict[str, str] = {}
    note = "'it''s ' || chr(34) || chr(92) || chr(10) || o_orderpriority || chr(9) || chr(13) || ' é' || chr(26)"
    o["insert_statements"] = f"""WITH RECURSIVE c AS (
  SELECT 'INSERT INTO orders (o_orderkey, o_custkey, o_totalprice, per_day, o_orderdate, note) VALUES ' AS pre, '{STATEMENT_POSTFIX}' AS post),
r AS (
  SELECT row_number() OVER (ORDER BY o_orderkey) AS rn, '(' || o_orderkey || ',' || o_custkey || ',' || printf('%.15g', o_totalprice) || ',' || printf('%.15g', o_totalprice / 365)
    || ',' || chr(39) || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(o_orderdate) % 1000000 = 0 THEN '' ELSE strftime(o_orderdate, '.%f') END || chr(39)
    || ',' || CASE WHEN o_orderkey % 7 = 0 THEN 'NULL' ELSE {_quoted(note)} END || ')' AS v FROM orders),
t AS MATERIALIZED (SELECT rn, v, octet_length(encode(v)) + 1 AS size, (sum(octet_length(encode(v)) + 1) OVER (ORDER BY rn))::BIGINT AS upto FROM r),
{",".join(_statements(size, k) for k, size in enumerate(STATEMENT_BYTES))}
SELECT max_bytes, statement, n_rows, octet_length(encode(sql))::BIGINT AS n_bytes, md5(sql) AS digest
FROM ({" UNION ALL ".join(f"SELECT * FROM m{k}" for k in range(len(STATEMENT_BYTES)))})"""
    i = _oracles_i()
    sides = {
        "events": [("at", RAW_DATETIME), ("gap", RAW_INTERVAL), ("stamp", RAW_COMPACT), ("props", "SELECT event_id AS id, props AS raw FROM events"), ("kind", "SELECT event_id AS id, event_type AS raw FROM events")],
        "orders": [("day", RAW_DATE), *[(n, RAW_NUMERIC) for n in ("price", "number", "count", "real")], ("small", "SELECT o_orderkey AS id, CAST(o_orderkey % 300 - 150 AS VARCHAR) AS raw FROM orders")],
        "pages": [("tags", "SELECT page_id AS id, regexp_replace(url, '[/?#&=.:]+', ',', 'g') AS raw FROM pages"), ("bytes", "SELECT page_id AS id, url AS raw FROM pages")],
    }
    cells = " UNION ALL ".join(
        f"SELECT '{result}' AS result, id AS row, '{name}' AS name, CASE WHEN id % 11 <> {k} THEN raw END AS raw FROM ({raw})"
        for result, columns in sides.items() for k, (name, raw) in enumerate(columns)
    )
    int_ok = lambda low, high: f"CASE WHEN regexp_matches(raw, '^\\s*[+-]?[0-9]+\\s*$') AND TRY_CAST(trim(raw) AS HUGEINT) BETWEEN {low} AND {high} THEN CAST(CAST(trim(raw) AS DECIMAL(38,18)) AS VARCHAR) END"
    o["decode_by_descriptor"] = f"""WITH cells AS ({cells}),
num AS MATERIALIZED (SELECT id, as_decimal, as_float FROM ({i["decode_numeric"]})),
micros AS (SELECT id, value FROM ({i["decode_time_interval"]})),
compact AS (SELECT id, value FROM ({i["decode_compact_timestamp"]})),
made AS (
  SELECT c.result, c.row, c.name, c.raw,
    CASE name WHEN 'price' THEN CAST(num.as_decimal AS VARCHAR) WHEN 'number' THEN {int_ok("-9223372036854775808", "9223372036854775807")}
      WHEN 'count' THEN {int_ok("0", "18446744073709551615")} WHEN 'small' THEN {int_ok("-128", "127")} END AS as_decimal,
    CASE WHEN name = 'real' THEN as_float END AS as_double,
    CASE WHEN name = 'gap' THEN micros.value END AS as_micros,
    CASE name WHEN 'at' THEN {sql_datetime_value("raw")} WHEN 'stamp' THEN compact.value WHEN 'day' THEN CAST({sql_date_value("raw")} AS TIMESTAMP) END AS as_time,
    CASE name WHEN 'kind' THEN c.raw WHEN 'tags' THEN array_to_string(list_sort(list_distinct(string_split(c.raw, ','))), '|') WHEN 'bytes' THEN hex(encode(c.raw)) END AS as_text,
    CASE WHEN name = 'props' THEN c.raw IS NOT NULL AND json_valid(c.raw) END AS is_json
  FROM cells c LEFT JOIN num ON c.result = 'orders' AND name IN ('price', 'real') AND c.row = num.id AND c.raw IS NOT NULL
  LEFT JOIN micros ON name = 'gap' AND c.row = micros.id AND c.raw IS NOT NULL LEFT JOIN compact ON name = 'stamp' AND c.row = compact.id AND c.raw IS NOT NULL)
SELECT result, row, name, as_decimal, as_double, as_micros, as_time, as_text, is_json,
  CASE WHEN coalesce(as_decimal, as_text) IS NULL AND as_double IS NULL AND as_micros IS NULL AND as_time IS NULL AND NOT coalesce(is_json, FALSE) THEN raw END AS reject
FROM made"""
    o["range_read_plan"] = """WITH r AS (
  SELECT CASE WHEN event_type = 'click' THEN 'hot' ELSE 'user-' || (user_id % 50) END AS file, event_id * 104729 % 40000003 AS a,
    CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN event_id % 300007 ELSE event_id * 31 % 9001 END AS size FROM events),
p AS (SELECT file, a, a + size AS b, max(a + size) OVER (PARTITION BY file ORDER BY a, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach, size FROM r WHERE size > 0),
g AS (SELECT *, sum(CASE WHEN a <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY file ORDER BY a, size ROWS UNBOUNDED PRECEDING) AS island FROM p),
s AS (SELECT file, min(a) AS a, max(b) AS b FROM g GROUP BY file, island),
q AS (SELECT file, b, unnest(generate_series(a, b - 1, 32768)) AS off FROM s)
SELECT file, off::BIGINT AS "offset", least(32768, b - off)::BIGINT AS length FROM q"""
    o["host_config_lookup"] = r"""WITH h AS (
  SELECT host, ('0x' || substr(md5(host), 1, 7))::BIGINT AS k FROM (SELECT DISTINCT regexp_extract(url, '^[^:]+://([^/?#]*)', 1) AS host FROM pages)),
pat AS (
  SELECT k AS block, CASE k % 5 WHEN 0 THEN host WHEN 1 THEN '*' || regexp_extract(host, '\..*$') WHEN 2 THEN substr(host, 1, 3) || '*'
    WHEN 3 THEN '?' || substr(host, 2) ELSE '*[' || substr(host, length(host) - 6, 1) || 'x]' || substr(host, length(host) - 5) END AS pattern, FALSE AS negated FROM h
  UNION ALL SELECT k, 'm.*', TRUE FROM h WHERE k % 4 = 0 UNION ALL SELECT 268435456, '*', FALSE),
fit AS (
  SELECT host, block FROM h JOIN pat ON host GLOB pattern GROUP BY host, block HAVING bool_or(NOT negated) AND NOT bool_or(negated)),
opt AS (
  SELECT k AS block, 'port' AS key, '1' || k AS value FROM h WHERE k % 2 = 0 UNION ALL SELECT k, 'user', 'u' || k FROM h
  UNION ALL SELECT k, 'proxycommand', CASE WHEN k % 9 = 0 THEN NULL ELSE 'nc %h:%p -l %r ~' END FROM h WHERE k % 3 = 0
  UNION ALL SELECT k, 'identityfile', '%d/id_' || (k % 3) || '_%r' FROM h UNION ALL SELECT k, 'hostname', '%h.internal' FROM h WHERE k % 7 = 0
  UNION ALL SELECT 268435456, 'controlpath', '%n-%p-%u' UNION ALL SELECT 268435456, 'user', 'root'),
hits AS (SELECT host, key, block, value, row_number() OVER (PARTITION BY host, key ORDER BY block) AS n FROM fit JOIN opt USING (block)),
one AS (SELECT host, key, value FROM hits WHERE n = 1 AND key <> 'identityfile'),
known AS (
  SELECT h.host, coalesce(replace(a.value, '%h', h.host), h.host) AS name, coalesce(p.value, '22') AS port, u.value AS usr
  FROM h LEFT JOIN one a ON a.host = h.host AND a.key = 'hostname' LEFT JOIN one p ON p.host = h.host AND p.key = 'port' LEFT JOIN one u ON u.host = h.host AND u.key = 'user'),
files AS (
  SELECT host, count(*) AS n, string_agg(replace(replace(value, '%d', '/home/me'), '%r', usr), '|' ORDER BY block) AS text
  FROM (SELECT host, value, min(block) AS block FROM hits WHERE key = 'identityfile' GROUP BY host, value) JOIN known USING (host) GROUP BY host)
SELECT host, 'hostname' AS key, 1 AS n, name AS text FROM known
UNION ALL SELECT host, 'identityfile', n::INT, text FROM files
UNION ALL SELECT host, key, 1, CASE key
    WHEN 'proxycommand' THEN coalesce(replace(replace(replace(replace(value, '%h', name), '%p', port), '%r', usr), '~', '/home/me'), '(none)')
    WHEN 'controlpath' THEN replace(replace(replace(value, '%n', host), '%p', port), '%u', 'me') ELSE value END
  FROM one JOIN known USING (host) WHERE key <> 'hostname'"""
    o["resolve_links"] = """WITH RECURSIVE l AS (
  SELECT '/o/l' || k AS path, CASE WHEN k % 10 = 0 THEN '/o/f' || k WHEN k % 50 = 7 THEN '/o/l' || (k - 3) ELSE '/o/l' || (k + 1) END AS target
  FROM (SELECT o_orderkey AS k FROM orders)),
walk AS (
  SELECT path, target AS here, 1 AS hops FROM l
  UNION ALL SELECT walk.path, l.target, hops + 1 FROM walk JOIN l ON walk.here = l.path WHERE hops < 64),
stop AS (SELECT path, here, hops FROM walk WHERE here NOT IN (SELECT path FROM l))
SELECT l.path, l.target, here AS final, hops::BIGINT AS hops,
  CASE WHEN here IS NULL THEN 'cycle' WHEN here IN (SELECT '/o/f' || o_orderkey FROM orders WHERE o_orderkey % 10 = 0 AND o_orderkey % 3 <> 0) THEN 'ok' ELSE 'broken' END AS status
FROM l LEFT JOIN stop USING (path)"""
    return o


# ---- keyed functions -------------------------------------------------------------
def _sql_pads(digits: str, size: int) -> str:
    """(inner, outer) hex pads of a key given as hex digits, at most a block long."""
    padded = f"rpad({digits}, {2 * size}, '0')"
    mixed = lambda p: " || ".join(f"lpad(hex(xor(('0x' || substr({padded}, {16 * i + 1}, 16))::UBIGINT, ('0x' || repeat('{p}', 8))::UBIGINT)), 16, '0')" for i in range(size // 8))
    return f"{mixed('36')} AS i, {mixed('5c')} AS o"


def _sql_mac(digest: str, data: str) -> str:
    return f"{digest}(from_hex(o) || from_hex({digest}(from_hex(i) || {data})))"


def _sql_siphash() -> str:
    """One sum, turn and mix after another; every state binds the one before as
    the only element of a list."""
    add = lambda a, b: f"((({a})::UHUGEINT + ({b})::UHUGEINT) % 18446744073709551616)::UBIGINT"
    rot = lambda a, n: f"((({a})::UHUGEINT * {1 << n}) % 18446744073709551616 + ({a})::UHUGEINT // {1 << (64 - n)})::UBIGINT"
    pack = lambda a, b, c, d, m: f"{{'a': {a}, 'b': {b}, 'c': {c}, 'd': {d}, 'm': {m}}}"

    def let(value: str, name: str, body: str) -> str:
        return f"list_transform([{value}], lambda {name}: {body})[1]"

    def sip_round(s: str, t: str) -> str:
        step = pack(add(f"{s}.a", f"{s}.b"), f"{s}.b", add(f"{s}.c", f"{s}.d"), f"{s}.d", f"{s}.m")
        u, v = t + "u", t + "v"
        turned = pack(rot(f"{u}.a", 32), f"xor({rot(f'{u}.b', 13)}, {u}.a)", f"{u}.c", f"xor({rot(f'{u}.d', 16)}, {u}.c)", f"{u}.m")
        again = pack(add(f"{v}.a", f"{v}.d"), f"{v}.b", add(f"{v}.c", f"{v}.b"), f"{v}.d", f"{v}.m")
        w = t + "w"
        last = pack(f"{w}.a", f"xor({rot(f'{w}.b', 17)}, {w}.c)", rot(f"{w}.c", 32), f"xor({rot(f'{w}.d', 21)}, {w}.a)", f"{w}.m")
        return let(step, u, let(turned, v, let(again, w, last)))

    def rounds(start: str, n: int, tag: str, body) -> str:
        def go(name: str, i: int) -> str:
            return body(name) if i == n else let(sip_round(name, f"{tag}{i}"), f"{tag}{i}r", go(f"{tag}{i}r", i + 1))

        return let(start, f"{tag}s", go(f"{tag}s", 0))

    entered = pack("s.a", "s.b", "s.c", "xor(s.d, x.m)", "x.m")
    fold = rounds(entered, 2, "p", lambda t: pack(f"xor({t}.a, {t}.m)", f"{t}.b", f"{t}.c", f"{t}.d", f"{t}.m"))
    end = rounds(pack("z.a", "z.b", "xor(z.c, 255::UBIGINT)", "z.d", "z.m"), 4, "q", lambda t: f"xor(xor({t}.a, {t}.b), xor({t}.c, {t}.d))")
    little = lambda text, at: "('0x' || " + " || ".join(f"substr({text}, {at} + {14 - 2 * j}, 2)" for j in range(8)) + ")::UBIGINT"
    zero = "0::UBIGINT"
    start = [f"xor({k}, ('0x{v}')::UBIGINT)" for k, v in (("k0", "736f6d6570736575"), ("k1", "646f72616e646f6d"), ("k0", "6c7967656e657261"), ("k1", "7465646279746573"))]
    return f"""WITH t AS MATERIALIZED (
  SELECT doc_id, md5(coalesce(source, '')) AS k, octet_length(encode(text)) AS n,
    rpad(hex(encode(text)), ((octet_length(encode(text)) // 8) * 16 + 14)::INT, '0') || lpad(hex(octet_length(encode(text)) % 256), 2, '0') AS h FROM documents),
w AS (SELECT doc_id, n, {little("k", "1")} AS k0, {little("k", "17")} AS k1, list_transform(range(0, n // 8 + 1), lambda j: substr(h, (16 * j + 1)::BIGINT, 16)) AS parts FROM t),
m AS (SELECT doc_id, [{pack(*start, zero)}] || list_transform(parts, lambda x: {pack(zero, zero, zero, zero, little("x", "1"))}) AS l FROM w),
f AS (SELECT doc_id, list_reduce(l, lambda s, x: {fold}) AS z FROM m WHERE l IS NOT NULL),
g AS (SELECT doc_id, {end} AS v FROM f)
SELECT doc_id, (CASE WHEN v >= 9223372036854775808 THEN v::HUGEINT - 18446744073709551616 ELSE v END)::BIGINT AS hash FROM documents LEFT JOIN g USING (doc_id)"""


def _oracles_keyed() -> dict[str, str]:
    from daybook.plans.key_jobs import KEY_BYTES, SINGLE_BYTES

    info = "encode(doc_id::VARCHAR)"
    block = lambda before, i: _sql_mac("sha256", f"{before}{info} || from_hex('{i:02x}')")
    o: dict[str, str] = {}
    o["hkdf_column"] = f"""WITH s AS (
  SELECT doc_id, encode(text) AS data, encode(coalesce(source, '')) AS salt, {_sql_pads("hex(encode(coalesce(source, '')))", 64)} FROM documents),
p AS MATERIALIZED (SELECT doc_id, data, salt, {_sql_mac("sha256", "data")} AS prk FROM s),
e AS MATERIALIZED (SELECT doc_id, data, salt, {_sql_pads("prk", 64)} FROM p),
t1 AS MATERIALIZED (SELECT *, {block("", 1)} AS b1 FROM e),
t2 AS MATERIALIZED (SELECT *, {block("from_hex(b1) || ", 2)} AS b2 FROM t1),
t3 AS MATERIALIZED (SELECT *, {block("from_hex(b2) || ", 3)} AS b3 FROM t2),
k AS MATERIALIZED (SELECT doc_id, data, salt, substr(b1 || b2 || b3, 1, {2 * KEY_BYTES}) AS derived FROM t3),
h AS MATERIALIZED (SELECT *, sha256(from_hex(derived)) AS short FROM k),
q AS (SELECT doc_id, data, salt, derived, {_sql_pads("short", 64)} FROM h)
SELECT doc_id, derived, substr(sha256(from_hex('00000001') || data || {info}) || sha256(from_hex('00000002') || data || {info}), 1, {2 * SINGLE_BYTES}) AS single,
  {_sql_mac("sha256", "salt")} AS mac FROM q"""
    code = lambda counter: _sql_mac("sha1", f"from_hex(lpad(hex({counter}), 16, '0'))")
    digits = "lpad(((('0x' || substr(mac, 2 * ('0x' || right(mac, 1))::INT + 1, 8))::BIGINT & 2147483647) % 1000000)::VARCHAR, 6, '0')"
    o["totp_verify"] = f"""WITH e AS (
  SELECT event_id, user_id, event_type, CAST(floor(epoch_us(ts) / 86400000000.0) AS BIGINT) * 86400 + event_id % 60 AS sec FROM events),
u AS MATERIALIZED (SELECT user_id, {_sql_pads("substr(sha256('secret ' || user_id), 1, 40)", 64)} FROM (SELECT DISTINCT user_id FROM events)),
need AS (SELECT DISTINCT user_id, sec // 30 + d AS counter FROM e, range(-1, 3) t(d)),
codes AS MATERIALIZED (SELECT user_id, counter, {digits} AS code FROM (SELECT user_id, counter, {code("counter")} AS mac FROM need JOIN u USING (user_id))),
g AS (
  SELECT e.*, CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN NULL WHEN event_type = 'purchase' THEN reverse(code) ELSE code END AS given
  FROM e JOIN codes c ON c.user_id = e.user_id AND c.counter = sec // 30 + CASE event_type WHEN 'view' THEN -1 WHEN 'signup' THEN 2 ELSE 0 END),
m AS (
  SELECT event_id, g.user_id, sec, given, arg_min(c.counter, abs(c.counter - sec // 30) * 2 + CASE WHEN c.counter > sec // 30 THEN 1 ELSE 0 END) AS step
  FROM g LEFT JOIN codes c ON c.user_id = g.user_id AND c.code = given AND c.counter BETWEEN sec // 30 - 1 AND sec // 30 + 1
  GROUP BY event_id, g.user_id, sec, given)
SELECT event_id AS attempt, given AS code, step,
  CASE WHEN step IS NULL THEN 'refused' WHEN row_number() OVER (PARTITION BY user_id, step ORDER BY sec, event_id) = 1 THEN 'accepted' ELSE 'replayed' END AS status
FROM m"""
    fewest = lambda x: f"CASE {' '.join(f'WHEN {x} BETWEEN {-(1 << 8 * k - 1)} AND {(1 << 8 * k - 1) - 1} THEN {k}' for k in range(1, 8))} ELSE 8 END"
    head = lambda n: f"CASE WHEN {n} < 128 THEN 2 WHEN {n} < 256 THEN 3 ELSE 4 END"
    o["ber_explode"] = f"""WITH b AS (
  SELECT o_orderkey AS k, repeat(o_orderpriority, o_custkey % 60) AS words, o_orderstatus AS status, -o_orderkey * CAST(pow(10, o_orderkey % 13) AS BIGINT) AS far FROM orders),
n AS MATERIALIZED (SELECT *, {fewest("k")} AS nk, octet_length(encode(words)) AS nw, {fewest("far")} AS nf, octet_length(encode(status)) AS ns FROM b),
p AS (
  SELECT k, '1' AS path, 0 AS class, true AS constructed, 16 AS tag, 2 + nk + {head("nw")} + nw + 2 + 2 + nf + 3 + 4 + ns AS size, NULL AS value FROM n
  UNION ALL SELECT k, '1.1', 0, false, 2, nk, k::VARCHAR FROM n UNION ALL SELECT k, '1.2', 0, false, 4, nw, words FROM n
  UNION ALL SELECT k, '1.3', 0, true, 16, nf + 5, NULL FROM n UNION ALL SELECT k, '1.3.1', 0, false, 2, nf, far::VARCHAR FROM n
  UNION ALL SELECT k, '1.3.2', 0, false, 1, 1, CASE WHEN k % 2 = 0 THEN 'FF' ELSE '00' END FROM n UNION ALL SELECT k, '1.4', 2, false, 200, ns, status FROM n)
SELECT k AS o_orderkey, path, class, constructed, tag::BIGINT AS tag, CASE WHEN k % 11 <> 0 THEN size END::BIGINT AS size, value, CASE WHEN k % 11 = 0 THEN 'truncated' ELSE 'ok' END AS status
FROM p WHERE k % 11 <> 0 OR path = '1'"""
    o["siphash_column"] = _sql_siphash()
    o["cmac_column"] = """SELECT doc_id, CASE WHEN text IS NOT NULL THEN 16 END AS tag_bytes, CASE WHEN text IS NOT NULL THEN true END AS ok_self,
  CASE WHEN text IS NOT NULL THEN false END AS ok_longer, CASE WHEN text IS NOT NULL THEN false END AS ok_other_key FROM documents"""
    return o


def oracles() -> dict[str, str]:
    return {**_oracles_client(), **_oracles_keyed(), **_oracles_a_to_h(), **_oracles_i(), **_oracles_l(), **_oracles_k(), **_oracles_j()}


if __name__ == "__main__":  # pragma: no cover - manual inspection
    print(report_sql())
