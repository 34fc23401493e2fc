"""Row filters of the report and of the snapshot table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.params import OPEN_STATUSES, PAID_STATUSES, REPORTED_ORDER_TYPES

REPORT_DATE_COLUMN = "tgl_pelaporan_data"


def base_condition(prefix: str = "") -> Column:
    """Enabled orders in an open or paid state, of a reported type."""
    c = lambda n: F.col(f"{prefix}{n}")
    return (
        (c("disabled") == 0)
        & c("status").isin(*(OPEN_STATUSES + PAID_STATUSES))
        & c("orderType").isin(*REPORTED_ORDER_TYPES)
    )


def filter_base(order: DataFrame) -> DataFrame:
    """The order part of the base filter, applied at the scan (pushed down)."""
    return order.where(base_condition())


def filter_report_day(df: DataFrame, rep: dt.date, column: str = REPORT_DATE_COLUMN) -> DataFrame:
    """Equality on the report day; on a table partitioned by the day this
    prunes partitions (``PartitionFilters`` in the scan)."""
    return df.where(F.col(column) == F.lit(rep))


def filter_last_days(df: DataFrame, rep: dt.date, days: int = 7, column: str = REPORT_DATE_COLUMN) -> DataFrame:
    """Inclusive range ``rep - (days - 1) .. rep`` (the original's
    ``subdate(current_date, 7) .. subdate(current_date, 1)``)."""
    lo = rep - dt.timedelta(days=days - 1)
    return df.where(F.col(column).between(F.lit(lo), F.lit(rep)))
