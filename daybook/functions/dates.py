"""Date rules of the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the job's business zone (UTC+7, no daylight saving).
BUSINESS_ZONE = "Asia/Jakarta"


EPOCH_NTZ = "1970-01-01 00:00:00"


def report_day_of(utc_wall_clock: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Report day of a run started at ``utc_wall_clock`` (a timestamp_ntz in
    UTC): yesterday in the business zone.  A column rule, so a whole
    event-time column is mapped in one projection (the original computed it
    once from the host clock).  ``convert_timezone`` on the NTZ value does not
    depend on the session time zone."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall_clock)
    return F.date_sub(F.to_date(local), 1)


def epoch_seconds(utc_wall_clock: Column) -> Column:
    """Whole epoch seconds of a UTC timestamp_ntz (session-zone independent)."""
    micros = epoch_micros(utc_wall_clock)  # integer arithmetic: a double has too few digits for far dates
    return floor_div(micros, 1_000_000)


def floor_div(n: Column, by: int) -> Column:
    """Floor of an integer quotient, without a double in between."""
    return ((n - F.pmod(n, F.lit(by).cast("bigint"))).cast("decimal(20,0)") / F.lit(by)).cast("bigint")


def epoch_micros(utc_wall_clock: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), utc_wall_clock)


def from_epoch_seconds(seconds: Column, zone: str = "UTC") -> Column:
    """Wall clock (timestamp_ntz) in ``zone`` of whole epoch seconds."""
    utc = F.timestamp_add("SECOND", seconds.cast("bigint"), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
