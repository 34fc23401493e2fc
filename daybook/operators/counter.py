"""Daily run counter: how many times each report day has been exported.

The original updates one row per run with separate read/update commits.  Here
the counter is a small keyed table updated for any number of days at once:
a full outer join of the old state with the increments, written as a new
version (write, then point readers at it) instead of in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.text import zfill
from daybook.operators.filters import REPORT_DATE_COLUMN

DAY = REPORT_DATE_COLUMN


def runs_per_day(runs: DataFrame, day_col: str = DAY) -> DataFrame:
    """Increments: number of runs per day (partial aggregation before shuffle)."""
    return runs.groupBy(day_col).agg(F.count(F.lit(1)).cast("int").alias("increment"))


def counter_upsert(state: DataFrame, increments: DataFrame) -> DataFrame:
    """``counter = coalesce(old, 0) + coalesce(increment, 0)`` for every day in
    either input: absent days start at 0 (the original's insert of 1 for a
    first run), present days are incremented."""
    old = state.select(F.col(DAY), F.col("counter").alias("old"))
    inc = increments.select(F.col(DAY), F.col("increment"))
    return old.join(inc, DAY, "full_outer").select(
        F.col(DAY),
        (F.coalesce(F.col("old"), F.lit(0)) + F.coalesce(F.col("increment"), F.lit(0))).cast("int").alias("counter"),
    )


def counter_read(days: DataFrame, state: DataFrame) -> DataFrame:
    """Read-only: the 2-digit counter of each requested day, ``00`` if absent."""
    return days.join(state, DAY, "left").select(
        F.col(DAY),
        F.coalesce(zfill(F.col("counter"), 2), F.lit("00")).alias("counter_text"),
    )
