"""Small text rules shared by export, counter and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the export format.
FIELD_SEPARATOR = "|"
QUOTE = '"'
LINE_END = "\r\n"
NEEDS_QUOTING = r'[|"\r\n]'


def zfill(c: Column, width: int = 2) -> Column:
    """Python ``str(n).zfill(width)``: pad with zeros, never truncate
    (plain ``lpad`` would cut ``100`` to ``10``)."""
    s = c.cast("string")
    return F.lpad(s, F.greatest(F.length(s), F.lit(width)), "0")


def csv_field(c: Column) -> Column:
    """One field as a minimal-quoting writer renders it: NULL and empty are
    empty; a field holding the separator, the quote or a line break is quoted
    with inner quotes doubled; anything else verbatim."""
    s = F.coalesce(c.cast("string"), F.lit(""))
    quoted = F.concat(F.lit(QUOTE), F.replace(s, F.lit(QUOTE), F.lit(QUOTE + QUOTE)), F.lit(QUOTE))
    return F.when(s.rlike(NEEDS_QUOTING), quoted).otherwise(s)


def csv_line(*cols: Column) -> Column:
    return F.concat_ws(FIELD_SEPARATOR, *[csv_field(c) for c in cols])


def ymd(c: Column) -> Column:
    """``yyyyMMdd`` text of a date (the original's ``%Y%m%d``)."""
    return F.date_format(c, "yyyyMMdd")
