"""Run parameters of the daily report.

One ``asof`` date drives everything (the SQL's "current date" and the file
names), so a rerun of an old day is reproducible and a warm process never uses
a stale clock.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values of the report (must equal the original job's output).
DEFAULT_PROVIDER_ID = 820053  # id_penyelenggara
BORROWER_KIND = 1  # jenis_pengguna: 1 = individual
OPEN_STATUSES = (7, 8)
PAID_STATUSES = (10, 11)
AGREEMENT_HISTORY_STATUS = 20
REPORTED_ORDER_TYPES = (0, 2, 3)  # 0 normal, 2 extended, 3 three-term instalment
POPULATION_WINDOW_DAYS = 91
QUALITY_1_BELOW_DAYS = 30
QUALITY_2_MAX_DAYS = 90
OPEN_STATUS_MAX_DAYS = 90
ID_CARD_LENGTH = 16
AMOUNT_TYPE = "decimal(18,2)"


@dataclass(frozen=True)
class ReportParams:
    """``asof`` is the run day; the report describes ``asof - 1`` (``rep``)."""

    asof: dt.date = field(default_factory=lambda: dt.date(2020, 6, 16))
    provider_id: int = DEFAULT_PROVIDER_ID
    partner: str = "820053"

    @property
    def rep(self) -> dt.date:
        return self.asof - dt.timedelta(days=1)

    @classmethod
    def for_report_day(cls, rep: dt.date, **kw) -> "ReportParams":
        return cls(asof=rep + dt.timedelta(days=1), **kw)
