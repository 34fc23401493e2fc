"""Derived columns of the daily report, as Column expressions.

All rules work on the flat, prefixed row the report joins produce:

``a_*``   the reported order (ordOrder a)
``d_*``   its third instalment bill, ``d1_*`` the first, ``d2_*`` the second
``f_*``   the follow-up order of an extension (ordOrder f via ordDelayRecord)
``c_*``   the latest agreement history row, ``b_*`` the borrower

Notation: ``rep`` is the report day, ``asof = rep + 1``.  ``late(x)`` is
``datediff(rep, date(x))``.  ``open`` = status 7/8, ``paid`` = status 10/11.
The day differences (``a_late``, ``due_late``, ``a_paid_late``, ...) are
added as columns once per row (``plans.report.with_days``); the rules read
those columns.

NULL semantics follow the original SQL: ``greatest`` there returns NULL when
any argument is NULL, while Spark's skips NULLs, so ``greatest_keep_null`` restores
NULL where the original has no inner ``coalesce``.  Comparisons with NULL are
unknown and fall to the ``otherwise`` branch, exactly like SQL ``IF``/``CASE``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.params import (
    AMOUNT_TYPE,
    OPEN_STATUS_MAX_DAYS,
    OPEN_STATUSES,
    PAID_STATUSES,
    POPULATION_WINDOW_DAYS,
    QUALITY_1_BELOW_DAYS,
    QUALITY_2_MAX_DAYS,
    ReportParams,
)


def col(prefix: str, name: str) -> Column:
    return F.col(f"{prefix}_{name}")


def days_between(later: Column, earlier: Column) -> Column:
    """``datediff`` on the date parts only (time of day ignored)."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


def greatest_keep_null(x: Column, floor: int = 0) -> Column:
    """``greatest(x, floor)`` that is NULL when ``x`` is NULL."""
    return F.when(x.isNull(), F.lit(None).cast("int")).otherwise(F.greatest(x, F.lit(floor)))


def greatest0(*xs: Column) -> Column:
    """``greatest(coalesce(x1,0), ..., 0)``: never NULL."""
    return F.greatest(*[F.coalesce(x, F.lit(0)) for x in xs], F.lit(0))


class LoanRules:
    """Column builders bound to one report day, or to a per-row day column
    (``rep_col``) when many days are reported in one plan."""

    def __init__(self, params: ReportParams | None = None, rep_col: str | None = None):
        if rep_col is not None:
            self.key = ("column", rep_col)
            self.rep = F.col(rep_col)
            self.asof_ts = F.date_add(self.rep, 1).cast("timestamp_ntz")
        else:
            params = params or ReportParams()
            self.key = ("day", params.rep)
            self.rep = F.lit(params.rep)
            self.asof_ts = F.lit(params.asof).cast("timestamp_ntz")

    # ---- row predicates -------------------------------------------------
    def status_in(self, prefix: str, codes) -> Column:
        return col(prefix, "status").isin(*codes)

    def is_open(self, prefix: str = "a") -> Column:
        return self.status_in(prefix, OPEN_STATUSES)

    def is_paid(self, prefix: str = "a") -> Column:
        return self.status_in(prefix, PAID_STATUSES)

    def otype(self) -> Column:
        return F.col("a_orderType")

    def late(self, ts: Column) -> Column:
        """Days from ``date(ts)`` to the report day (negative for future dates)."""
        return F.datediff(self.rep, F.to_date(ts))

    # ---- instalment pick ------------------------------------------------
    def due_ts(self) -> Column:
        """Type-3 due time: the first of bills 3, 2 whose due time is before
        midnight of ``asof``, else bill 1.  Computed once and reused."""
        return (
            F.when(self.asof_ts > col("d", "refundTime"), col("d", "refundTime"))
            .when(self.asof_ts > col("d2", "refundTime"), col("d2", "refundTime"))
            .otherwise(col("d1", "refundTime"))
        )

    # ---- day differences, computed once per row ----------------------------
    def day_columns(self) -> list[tuple[str, Column]]:
        """The due time and the day differences the rules read.  Added as
        columns by ``with_days`` (which then adds ``due_late`` from
        ``due_ts``), so every difference is computed once per row and the
        rule expressions stay small (cheaper to analyse, optimise and
        compile)."""
        paid_late = lambda p: days_between(col(p, "actualRefundTime"), col(p, "refundTime"))
        return [
            ("due_ts", self.due_ts()),
            ("a_late", self.late(F.col("a_refundTime"))),
            ("f_late", self.late(F.col("f_refundTime"))),
            ("d_late", self.late(col("d", "refundTime"))),
            ("d1_late", self.late(col("d1", "refundTime"))),
            ("d2_late", self.late(col("d2", "refundTime"))),
            ("a_paid_late", paid_late("a")),
            ("f_paid_late", paid_late("f")),
            ("d1_paid_late", paid_late("d1")),
            ("d2_paid_late", paid_late("d2")),
            ("a_paid_vs_d", days_between(F.col("a_actualRefundTime"), col("d", "refundTime"))),
            ("f_late_to_rep", days_between(F.coalesce(F.col("f_actualRefundTime"), self.rep), F.col("f_refundTime"))),
        ]

    # ---- reported columns -----------------------------------------------
    def agreement_date(self) -> Column:
        return F.to_date(F.coalesce(F.col("c_statusChangeTime"), F.col("a_lendingTime")))

    def due_date(self) -> Column:
        return F.when(self.otype() != 3, F.to_date(F.col("a_refundTime"))).otherwise(F.to_date(F.col("due_ts")))

    def outstanding(self) -> Column:
        t = self.otype()
        a_refund = F.col("a_refundTime")
        instalment = (
            F.when(a_refund == col("d", "refundTime"), col("d", "billAmout"))
            .when(a_refund == col("d1", "refundTime"), col("d1", "billAmout") * 3)
            .otherwise(col("d2", "billAmout") * 2)
        )
        zero = F.lit(0).cast(AMOUNT_TYPE)
        return (
            F.when(self.is_paid() & t.isin(0, 3), zero)
            .when(self.is_paid() & (t == 2) & self.is_open("f"), F.col("f_amountApply"))
            .when(self.is_open() & (t == 0), F.col("a_amountApply"))
            .when(self.is_open() & (t == 3), instalment)
            .otherwise(zero)
            .cast(AMOUNT_TYPE)
        )

    def quality(self) -> Column:
        t = self.otype()
        open_, paid = self.is_open(), self.is_paid()
        lo, hi = QUALITY_1_BELOW_DAYS, QUALITY_2_MAX_DAYS
        a_paid, a_open, due, f_open, f_paid = (
            F.col(c) for c in ("a_paid_late", "a_late", "due_late", "f_late", "f_paid_late")
        )
        bucket1 = (
            (paid & (a_paid < lo) & t.isin(0, 3))
            | (open_ & (t == 0) & (a_open < lo))
            | (open_ & (t == 3) & (due < lo))
            | (paid & self.status_in("f", OPEN_STATUSES + PAID_STATUSES) & (F.col("f_late_to_rep") < lo) & (t == 2))
        )
        a_paid0 = F.coalesce(a_paid, F.lit(0))
        bucket2 = (
            (paid & a_paid0.between(lo, hi) & t.isin(0, 3))
            | (open_ & a_open.between(lo, hi) & (t == 0))
            | (open_ & due.between(lo, hi) & (t == 3))
            | (paid & self.is_paid("f") & f_paid.between(lo, hi) & (t == 2))
            | (paid & self.is_open("f") & f_open.between(lo, hi) & (t == 2))
        )
        return F.when(bucket1, 1).when(bucket2, 2).otherwise(3).cast("int")

    def dpd(self) -> Column:
        t = self.otype()
        open_, paid = self.is_open(), self.is_paid()
        return (
            F.when(open_ & (t == 0), greatest_keep_null(F.col("a_late")))
            .when(open_ & (t == 3), greatest_keep_null(F.col("due_late")))
            .when(paid & (t == 2) & self.is_open("f"), greatest0(F.col("f_late")))
            .when(paid & t.isin(0, 3), greatest0(F.col("a_paid_late")))
            .when(paid & (t == 2) & self.is_paid("f"), greatest0(F.col("f_paid_late")))
            .otherwise(0)
            .cast("int")
        )

    def max_dpd(self) -> Column:
        t = self.otype()
        open_, paid = self.is_open(), self.is_paid()
        a_leg = F.col("a_paid_late")
        f_open_leg = F.coalesce(F.col("f_late"), F.lit(0))
        f_paid_leg = greatest0(F.col("f_paid_late"))
        d1_paid, d2_paid = F.col("d1_paid_late"), F.col("d2_paid_late")
        open_instalment = (
            F.when(col("d1", "actualRefundTime").isNull(), greatest0(F.col("d1_late")))
            .when(col("d2", "actualRefundTime").isNull(), greatest0(F.col("d2_late"), d1_paid))
            .otherwise(greatest0(F.col("d_late"), d1_paid, d2_paid))
        )
        paid_instalment = greatest0(F.col("a_paid_vs_d"), d2_paid, d1_paid)
        return (
            F.when(open_ & (t == 0), greatest0(F.col("a_late")))
            .when(
                paid & (t == 2) & self.is_open("f"),
                F.when(f_open_leg < a_leg, greatest0(a_leg)).otherwise(greatest0(f_open_leg)),
            )
            .when(paid & (t == 0), greatest0(a_leg))
            .when(
                paid & (t == 2) & self.is_paid("f"),
                F.when(f_paid_leg < a_leg, greatest0(a_leg)).otherwise(f_paid_leg),
            )
            .when(open_ & (t == 3), open_instalment)
            .when(paid & (t == 3), paid_instalment)
            .otherwise(0)
            .cast("int")
        )

    def loan_status(self) -> Column:
        t = self.otype()
        open_, paid = self.is_open(), self.is_paid()
        m = OPEN_STATUS_MAX_DAYS
        settled = (paid & t.isin(0, 3)) | (paid & (t == 2) & self.is_paid("f"))
        current = (
            (open_ & (t == 0) & (F.col("a_late") <= m))
            | (open_ & (t == 3) & (F.col("d_late") <= m))
            | (paid & (t == 2) & (F.col("f_late") <= m) & self.is_open("f"))
        )
        return F.when(settled, "L").when(current, "O").otherwise("W")

    # ---- population -----------------------------------------------------
    def population(self) -> Column:
        """OR of the five admission rules (rule 1 lists type 1, which the base
        filter already excludes; kept as written)."""
        t = self.otype()
        w = POPULATION_WINDOW_DAYS
        return (
            ((F.to_date(F.col("a_updateTime")) == self.rep) & t.isin(0, 1))
            | ((self.late(F.col("a_refundTime")) <= w) & self.is_open() & (t == 0))
            | ((self.late(F.col("f_refundTime")) <= w) & self.is_open("f"))
            | ((t == 3) & self.is_paid() & (F.to_date(F.col("a_actualRefundTime")) == self.rep))
            | ((t == 3) & self.is_open() & (self.late(col("d", "refundTime")) <= w))
        )
