"""Join semantics on hand-written source tables: fan-out is kept exactly."""

import datetime as dt
import decimal

from daybook.params import ReportParams
from daybook.plans.report import build_report
from daybook.sources.loan_model import LoanTables

P = ReportParams()
D = lambda n: dt.datetime.combine(P.rep, dt.time()) - dt.timedelta(days=n)
AMT = decimal.Decimal("300.00")


def tables(spark, orders, users, history, bills, delays):
    o = spark.createDataFrame(
        orders,
        "uuid bigint, userUuid bigint, disabled int, status int, orderType int, amountApply decimal(18,2), "
        "lendingTime timestamp_ntz, refundTime timestamp_ntz, actualRefundTime timestamp_ntz, updateTime timestamp_ntz",
    )
    u = spark.createDataFrame(users, "uuid bigint, realName string, idCardNo string, disabled int")
    h = spark.createDataFrame(
        history, "orderId bigint, status int, disabled int, updateTime timestamp_ntz, statusChangeTime timestamp_ntz"
    )
    b = spark.createDataFrame(
        bills,
        "orderNo bigint, billTerm int, refundTime timestamp_ntz, actualRefundTime timestamp_ntz, billAmout decimal(18,2)",
    )
    e = spark.createDataFrame(delays, "orderNo bigint, delayOrderNo bigint")
    return LoanTables(order=o, user=u, history=h, bill=b, delay=e)


def order(k, status=7, otype=0, refund=5, user=1, disabled=0, actual=None):
    return (k, user, disabled, status, otype, AMT, D(35), D(refund), actual, D(0))


USERS = [(1, "Ann", "3200000000000000001", 0), (2, "Bob", "3200000000000000002", 1)]


def test_tied_history_fans_out_and_disabled_max_is_ignored(spark):
    hist = [
        (1, 20, 0, D(30), D(29)),
        (1, 20, 1, D(30), D(29)),  # disabled row on the max time: still joined
        (1, 20, 1, D(10), D(9)),  # disabled later row: not the max
        (1, 10, 0, D(5), D(4)),  # other status: ignored
    ]
    t = tables(spark, [order(1)], USERS, hist, [], [])
    rows = build_report(t, P).collect()
    assert len(rows) == 2
    assert {r["tgl_perjanjian_borrower"] for r in rows} == {D(29).date()}


def test_no_agreement_row_falls_back_to_lending_time(spark):
    t = tables(spark, [order(1)], USERS, [(1, 20, 1, D(3), D(2))], [], [])
    (row,) = build_report(t, P).collect()
    assert row["tgl_perjanjian_borrower"] == D(35).date()


def test_duplicate_bills_and_delay_records_fan_out(spark):
    bills = [(3, 1, D(5), None, AMT), (3, 1, D(5), None, AMT), (3, 2, D(-25), None, AMT), (3, 3, D(-55), None, AMT)]
    orders = [order(3, otype=3, refund=5), order(4, status=10, otype=2, refund=50, actual=D(45)),
              order(10, refund=2), order(11, refund=3)]
    delays = [(4, 10), (4, 11)]
    t = tables(spark, orders, USERS, [], bills, delays)
    got = [r["id_pinjaman"] for r in build_report(t, P).collect()]
    assert sorted(got) == [3, 3, 4, 4, 10, 11]


def test_disabled_borrower_and_order_are_dropped(spark):
    orders = [order(1, user=2), order(2, disabled=1), order(5, status=20), order(6, otype=1)]
    t = tables(spark, orders, USERS, [], [], [])
    assert build_report(t, P).count() == 0


def test_bills_only_join_instalment_orders(spark):
    bills = [(1, 1, D(5), None, AMT), (1, 2, D(5), None, AMT), (1, 3, D(5), None, AMT)]
    t = tables(spark, [order(1, otype=0)], USERS, [], bills, [])
    (row,) = build_report(t, P).collect()
    assert row["sisa_pinjaman_berjalan"] == AMT  # open normal loan: whole amount, bills ignored


def test_copies_of_history_rows_are_collapsed_before_the_join(spark):
    """A group of identical agreement rows (here 1,000 copies) crosses the
    report join as one distinct row with its count, and the report still
    repeats the loan once per copy."""
    from daybook.operators.joins import latest_agreement_rows

    hist = [(1, 20, 0, D(30), D(29))] * 1000 + [(1, 20, 0, D(31), D(30)), (3, 20, 0, D(30), D(29))]
    orders = [order(1), order(3)]
    t = tables(spark, orders, USERS, hist, [], [])
    latest = {(r.c_orderId, r.c_copies) for r in latest_agreement_rows(t.history).collect()}
    assert latest == {(1, 1000), (3, 1)}
    got = [r["id_pinjaman"] for r in build_report(t, P).collect()]
    assert sorted(got) == [1] * 1000 + [3]


def test_copies_of_delay_records_multiply_with_history_copies(spark):
    from daybook.operators.joins import extension_leg

    orders = [order(4, status=10, otype=2, refund=50, actual=D(45)), order(10, refund=2)]
    hist = [(4, 20, 0, D(30), D(29))] * 3
    delays = [(4, 10)] * 500
    t = tables(spark, orders, USERS, hist, [], delays)
    leg = extension_leg(t.delay, t.order).collect()
    assert [(r.e_orderNo, r.e_copies) for r in leg] == [(4, 500)]
    got = [r["id_pinjaman"] for r in build_report(t, P).collect()]
    assert sorted(got) == [4] * 1500 + [10]
