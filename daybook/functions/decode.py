"""Typed decoding of raw text columns (one job over a whole table).

Each decoder returns a struct ``(value, reject)``: the typed value, or NULL
with the raw text in ``reject`` when the text does not parse.  (The client
library these rules come from returns the raw text in place of the value; the
reject column keeps that text without mixing types in one column.)

All rules are built-in expressions (regex, ``try_*`` constructors), so they
stay inside whole-stage codegen; no Python runs per row.  Patterns anchor at
the start only, like a regex ``match``: trailing text is ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.dates import floor_div
from daybook.functions.protect import bind

# Accepted shapes of temporal text, as the client library
# states them, plus a leading ``^`` (it matches at the start of the text;
# ``rlike`` / ``regexp_extract`` search).  ``\d`` is an ASCII digit here.
DATETIME_PATTERN = r"^(\d{1,4})-(\d{1,2})-(\d{1,2})[T ](\d{1,2}):(\d{1,2}):(\d{1,2})(?:.(\d{1,6}))?"
INTERVAL_PATTERN = r"^(-)?(\d{1,3}):(\d{1,2}):(\d{1,2})(?:.(\d{1,6}))?"
TIME_OF_DAY_PATTERN = r"^(\d{1,2}):(\d{1,2}):(\d{1,2})(?:.(\d{1,6}))?"
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
DECIMAL_TEXT = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]{1,4})?\s*$"
FLOAT_TEXT = r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf(?:inity)?|nan))\s*$"
DATE_TEXT = r"^\s*\+?[0-9]+\s*-\s*\+?[0-9]+\s*-\s*\+?[0-9]+\s*$"
UTF8_CHARSETS = ("utf8", "utf8mb3", "utf8mb4", "utf-8")
LATIN1_CHARSETS = ("latin1", "iso-8859-1")
ASCII_CHARSETS = ("ascii", "us-ascii")
BINARY_CHARSETS = ("binary",)


_MARK = "\x01"


def _result(value: Column, raw: Column) -> Column:
    """The value (computed once) and the text it leaves."""
    return bind(value, lambda v: F.struct(v.alias("value"), F.when(v.isNull(), raw).alias("reject")))


def _matched(raw: Column, pattern: str, n: int, fn: Callable[[Callable[[int], Column]], Column]) -> Column:
    """``fn`` of the groups 1 to ``n`` of one match at the start of the text,
    NULL without a match.  The pattern runs once: the text is replaced by its
    groups, each after a mark; a text that itself begins with the mark fits no
    pattern."""
    marked = F.regexp_replace(raw, pattern + r"(?s:.*)\z", "".join(f"{_MARK}${i}" for i in range(1, n + 1)))
    groups = F.when(marked.startswith(_MARK) & ~raw.startswith(_MARK), F.split(marked, _MARK, -1))
    return bind(groups, lambda g: F.when(g.isNotNull(), fn(lambda i: F.get(g, i))))


def _int(c: Column) -> Column:
    # try_cast, not cast: Spark may evaluate a repeated subexpression before
    # the guard that protects it, and an ANSI cast of bad text would fail the
    # job instead of rejecting the row.
    return F.when(c != "", c.try_cast("bigint"))


def _micros(frac: Column) -> Column:
    """Fraction digits right-padded to microseconds (``'5'`` -> 500000)."""
    return F.when(frac == "", F.lit(0)).otherwise(F.rpad(frac, 6, "0").try_cast("int"))


def _seconds(s: Column, frac: Column) -> Column:
    return (s + _micros(frac) / F.lit(1_000_000)).cast("decimal(16,6)")


def _timestamp(y, mo, d, h, mi, s, us) -> Column:
    """Timestamp of valid calendar fields, else NULL (year 1..9999, hour < 24,
    minute and second < 60; the guard keeps ``try_make_timestamp_ntz`` from
    seeing year 0 or second 60, which it raises on or rolls over)."""
    ok = y.between(1, 9999) & h.between(0, 23) & mi.between(0, 59) & s.between(0, 59)
    secs = (s + us / F.lit(1_000_000)).cast("decimal(16,6)")
    return F.when(ok, F.try_make_timestamp_ntz(y, mo, d, h, mi, secs))


def date_value(raw: Column) -> Column:
    """``y-m-d`` split on the first two ``-``, each part an unsigned integer
    (surrounding blanks allowed); invalid calendar dates are NULL.  (Three
    integer parts split on the first two ``-`` is exactly one anchored
    pattern, checked once per row.)"""
    parts = F.split(raw, "-", 3)
    y, mo, d = (F.trim(F.get(parts, i)).try_cast("bigint") for i in range(3))
    safe = raw.rlike(DATE_TEXT) & y.between(1, 9999) & mo.between(1, 12) & d.between(1, 31)
    return F.to_date(F.when(safe, F.try_make_timestamp_ntz(y, mo, d, F.lit(0), F.lit(0), F.lit(0))))


def decode_date(raw: Column) -> Column:
    return _result(date_value(raw), raw)


def datetime_value(raw: Column) -> Column:
    """Datetime shape (``T`` or blank, 1..6 fraction digits); if that fails,
    the date rule (value at midnight)."""
    ts = _matched(raw, DATETIME_PATTERN, 7, lambda g: _timestamp(*[_int(g(i)) for i in range(1, 7)], _micros(g(7))))
    return F.coalesce(ts, date_value(raw).cast("timestamp_ntz"))


def decode_datetime(raw: Column) -> Column:
    return _result(datetime_value(raw), raw)


def decode_time_interval(raw: Column) -> Column:
    """Signed ``H:M:S[.f]`` duration, hours up to 3 digits; minutes and
    seconds above 59 are accepted and carried over."""

    def value(g: Callable[[int], Column]) -> Column:
        h, mi, s = (_int(g(i)) for i in (2, 3, 4))
        sign = F.when(g(1) == "-", F.lit(-1)).otherwise(F.lit(1))
        return F.make_dt_interval(F.lit(0), h, mi, _seconds(s, g(5))) * sign

    return _result(_matched(raw, INTERVAL_PATTERN, 5, value), raw)


def decode_time_of_day(raw: Column) -> Column:
    """``H:M:S[.f]`` time of day (as the interval since midnight); hours < 24,
    minutes and seconds < 60, no sign."""

    def value(g: Callable[[int], Column]) -> Column:
        h, mi, s = (_int(g(i)) for i in (1, 2, 3))
        ok = h.between(0, 23) & mi.between(0, 59) & s.between(0, 59)
        return F.when(ok, F.make_dt_interval(F.lit(0), h, mi, _seconds(s, g(4))))

    return _result(_matched(raw, TIME_OF_DAY_PATTERN, 4, value), raw)


def decode_compact_timestamp(raw: Column) -> Column:
    """``yyyymmddhhmmss`` right-padded with zeros to 14 digits; text whose 5th
    character is ``-`` follows the datetime rule instead."""
    padded = F.rpad(raw, 14, "0")
    digits = padded.rlike(r"^[0-9]{14}$") & (F.length(raw) >= 5)
    f = [F.substring(padded, a, n).try_cast("bigint") for a, n in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2))]
    compact = F.when(digits, _timestamp(*f, F.lit(0)))
    value = F.when(F.substring(raw, 5, 1) == "-", datetime_value(raw)).otherwise(compact)
    return _result(value, raw)


def decode_set(raw: Column) -> Column:
    """Comma-separated members, each once (sorted: a set has no order)."""
    return F.when(raw.isNotNull(), F.array_sort(F.array_distinct(F.split(raw, ",", -1))))


def decode_numeric(raw: Column, precision: int = 38, scale: int = 18) -> Column:
    """Integer, float and exact decimal readings of the same text.

    A reading that cannot hold the text is NULL: the integer reading of a
    fraction, of 64 bits exceeded, the decimal reading of more digits than the
    type has (never rounded), of infinities and of not-a-number.  ``reject``
    keeps the raw text whenever an integer text or any number lost a reading
    that way, and for text that is no number (``1d`` and ``0x1p3`` are none)."""
    whole, text = raw.rlike(INT_TEXT), F.trim(raw)
    as_int = F.when(whole, text.try_cast("bigint"))
    # Digits before and after the point, without the zeros that carry nothing.
    before = F.length(F.regexp_extract(text, r"^[+-]?0*([0-9]*)", 1))
    after = F.length(F.regexp_replace(F.regexp_extract(text, r"\.([0-9]*)", 1), "0+$", ""))
    shift = F.coalesce(F.regexp_extract(text, r"[eE]([+-]?[0-9]{1,4})\s*$", 1).try_cast("int"), F.lit(0))
    exact = raw.rlike(DECIMAL_TEXT) & (before + shift <= precision - scale) & (after - shift <= scale)
    as_decimal = F.when(exact, text.try_cast(f"decimal({precision},{scale})"))
    return F.struct(
        as_int.alias("as_int"),
        F.when(raw.rlike(FLOAT_TEXT), text.try_cast("double")).alias("as_float"),
        as_decimal.alias("as_decimal"),
        F.when(as_decimal.isNull() | (whole & as_int.isNull()), raw).alias("reject"),
    )


UNSIGNED_64_MAX = 18446744073709551615  # fixed value: 2**64 - 1


def decode_unsigned(raw: Column) -> Column:
    """Unsigned 64-bit integer text as ``decimal(20,0)`` (it may exceed
    ``bigint``); a sign, a fraction or a value beyond 2**64 - 1 is rejected."""
    value = F.when(raw.rlike(r"^\s*\+?[0-9]+\s*$"), F.trim(raw).try_cast("decimal(38,0)"))
    ok = value.between(F.lit(0), F.lit(str(UNSIGNED_64_MAX)).cast("decimal(38,0)"))
    return _result(F.when(ok, value.cast("decimal(20,0)")), raw)


def decode_charset(content: Column, charset: Column) -> Column:
    """Bytes to text by the column's charset name.  UTF-8 family: valid UTF-8
    only; ASCII: 7-bit bytes only; latin1: every byte; ``binary`` stays bytes
    (``value`` NULL, ``binary`` set).  Anything else is rejected."""
    cs = F.lower(charset)
    utf8 = content.cast("string")
    latin1 = F.decode(content, "ISO-8859-1")
    text = (
        F.when(cs.isin(*UTF8_CHARSETS) & F.is_valid_utf8(utf8), utf8)
        .when(cs.isin(*ASCII_CHARSETS) & latin1.rlike(r"^[\x00-\x7F]*$"), latin1)
        .when(cs.isin(*LATIN1_CHARSETS), latin1)
    )
    is_binary = cs.isin(*BINARY_CHARSETS)
    return F.struct(
        text.alias("value"),
        F.when(is_binary, content).alias("binary"),
        F.when(text.isNull() & ~is_binary, F.hex(content)).alias("reject"),
    )


# ---- encoding and epoch seconds ----------------------------------------------------
def encode_timestamp(ts: Column) -> Column:
    """Canonical text: ``yyyy-MM-dd HH:mm:ss`` plus ``.ffffff`` only when the
    fraction is not zero."""
    base = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return F.when(F.date_format(ts, "SSSSSS") == "000000", base).otherwise(
        F.concat(base, F.lit("."), F.date_format(ts, "SSSSSS"))
    )


def encode_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def interval_micros(iv: Column) -> Column:
    """Signed microseconds of a day-time interval."""
    day, hour, minute = (F.extract(F.lit(u), iv).cast("bigint") for u in ("DAY", "HOUR", "MINUTE"))
    second = F.extract(F.lit("SECOND"), iv)  # decimal with the fraction
    return ((day * 24 + hour) * 60 + minute) * 60_000_000 + (second * 1_000_000).cast("bigint")


def encode_interval(iv: Column) -> Column:
    """``HH:MM:SS[.ffffff]`` of a duration, rendered like a Python timedelta
    is by the client library: hours = floor(total / 1 h) (not wrapped, may be
    negative), minutes and seconds are the floor remainders, fraction only
    when not zero (``-25:06:17``, and ``-1:59:59`` for minus one second)."""
    us = interval_micros(iv)
    secs = floor_div(us, 1_000_000)
    frac = F.pmod(us, F.lit(1_000_000))
    base = F.format_string(
        "%02d:%02d:%02d", floor_div(secs, 3600), F.pmod(floor_div(secs, 60), F.lit(60)), F.pmod(secs, F.lit(60))
    )
    return F.when(frac == 0, base).otherwise(F.concat(base, F.format_string(".%06d", frac)))


def ticks_to_timestamp(ticks: Column, zone: str | None = None) -> Column:
    """Epoch seconds -> wall-clock timestamp in ``zone`` (default: the
    session zone, like the process-local zone of the original), whole seconds
    (a fraction is dropped, as ``localtime`` does)."""
    from daybook.functions.dates import from_epoch_seconds

    if zone is None:
        return F.timestamp_seconds(F.floor(ticks)).cast("timestamp_ntz")
    return from_epoch_seconds(F.floor(ticks), zone)


def ticks_to_date(ticks: Column, zone: str | None = None) -> Column:
    return F.to_date(ticks_to_timestamp(ticks, zone))


def ticks_to_time(ticks: Column, zone: str | None = None) -> Column:
    """Time of day as the interval since local midnight."""
    ts = ticks_to_timestamp(ticks, zone)
    return F.make_dt_interval(F.lit(0), F.hour(ts), F.minute(ts), F.second(ts).cast("decimal(16,6)"))
