"""Facts of the report on the sf0.01 loan model (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from daybook.params import ReportParams
from daybook.plans.report import build_report, candidate_rows, joined_rows
from daybook.sources.loan_model import loan_tables


@pytest.fixture(scope="module")
def report(spark):
    return build_report(loan_tables(spark, SF01), ReportParams()).cache()


def counts(df, col):
    return {r[col]: r["count"] for r in df.groupBy(col).count().collect()}


def test_row_and_loan_counts(report):
    assert report.count() == 4613
    assert report.select("id_pinjaman").distinct().count() == 4610


def test_quality_and_status_split(report):
    assert counts(report, "id_kualitas_pinjaman") == {1: 2148, 2: 1661, 3: 804}
    assert counts(report, "status_pinjaman") == {"O": 2437, "L": 1764, "W": 412}


def test_dpd_facts(report):
    assert report.where(F.col("status_pinjaman_dpd").isNull()).count() == 5
    assert report.where(F.col("status_pinjaman_dpd") > 0).count() == 3344
    differs = report.where(~F.col("status_pinjaman_max_dpd").eqNullSafe(F.col("status_pinjaman_dpd")))
    assert differs.count() == 2024


def test_constants_and_types(report):
    row = report.first()
    assert row["id"] is None and row["no_npwp"] is None
    assert row["id_penyelenggara"] == 820053 and row["jenis_pengguna"] == 1
    assert len(row["no_identitas"]) == 16
    types = dict(report.dtypes)
    assert types["nilai_pendanaan"] == "decimal(18,2)"
    assert types["sisa_pinjaman_berjalan"] == "decimal(18,2)"
    assert types["tgl_pelaporan_data"] == "date"


def test_open_instalment_branches(spark):
    """Open type-3 rows by which bill equals the order's due time."""
    t = loan_tables(spark, SF01)
    rows = joined_rows(t, ReportParams()).where((F.col("a_orderType") == 3) & F.col("a_status").isin(7, 8))
    got = rows.select(
        F.when(F.col("a_refundTime") == F.col("d_refundTime"), "d")
        .when(F.col("a_refundTime") == F.col("d1_refundTime"), "d1")
        .otherwise("other")
        .alias("branch")
    )
    assert counts(got, "branch") == {"d": 245, "d1": 481, "other": 486}


COMBOS = [
    (0, (10, 11), None, "L", {1, 2, 3}),
    (0, (7, 8), None, "O", {1, 2}),
    (0, (7, 8), None, "W", {3}),
    (2, (10, 11), (7, 8), "O", {1, 2}),
    (2, (10, 11), (7, 8), "W", {3}),
    (2, (7, 8), (7, 8), "W", {3}),
    (3, (10,), None, "L", {1, 2, 3}),
    (3, (7, 8), None, "O", {1, 2}),
]


@pytest.mark.parametrize("otype,a_status,f_status,status,qualities", COMBOS)
def test_branch_combinations_non_empty(spark, otype, a_status, f_status, status, qualities):
    t = loan_tables(spark, SF01)
    from daybook.functions.loan import LoanRules
    from daybook.plans.report import with_days

    rules = LoanRules(ReportParams())
    rows = with_days(joined_rows(t, ReportParams()), rules).select(
        "a_orderType", "a_status", "f_status",
        rules.loan_status().alias("st"), rules.quality().alias("q"),
    )
    cond = (F.col("a_orderType") == otype) & F.col("a_status").isin(*a_status) & (F.col("st") == status)
    cond = cond & (F.col("f_status").isNull() if f_status is None else F.col("f_status").isin(*f_status))
    seen = {r["q"] for r in rows.where(cond).select("q").distinct().collect()}
    assert qualities <= seen, (qualities, seen)


def test_candidates_keep_every_reported_order(spark):
    t = loan_tables(spark, SF01)
    base = t.order.where("disabled = 0 and status in (7,8,10,11) and orderType in (0,2,3)").count()
    # one delay record per type-2 order and one bill per term: no fan-out here
    assert candidate_rows(t).count() == base
