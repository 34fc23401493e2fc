"""Typed decoding: the client library's documented example values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.functions import decode


def one(spark, fn, raw):
    r = spark.createDataFrame([(raw,)], "raw string").select(fn(F.col("raw")).alias("d")).first()["d"]
    return r["value"], r["reject"]


@pytest.mark.parametrize(
    "raw,value",
    [
        ("2007-02-25 23:06:20", dt.datetime(2007, 2, 25, 23, 6, 20)),
        ("2007-02-25T23:06:20", dt.datetime(2007, 2, 25, 23, 6, 20)),
        ("2007-02-25 23:06:20.5", dt.datetime(2007, 2, 25, 23, 6, 20, 500000)),
        ("2007-02-26", dt.datetime(2007, 2, 26)),  # date rule fallback
        ("2007-02-31T23:06:20", None),
        ("0000-00-00 00:00:00", None),
        ("2007-02-25 24:06:20", None),
        ("2007-02-25 23:06:60", None),
    ],
)
def test_datetime(spark, raw, value):
    assert one(spark, decode.decode_datetime, raw) == (value, None if value else raw)


@pytest.mark.parametrize(
    "raw,value",
    [
        ("25:06:17", dt.timedelta(days=1, seconds=3977)),
        # the library documents (-2, 83177) here, but its own arithmetic
        # (timedelta(hours=25, minutes=6, seconds=17) * -1) gives (-2, 82423)
        ("-25:06:17", -dt.timedelta(hours=25, minutes=6, seconds=17)),
        ("1:99:17.25", dt.timedelta(hours=1, minutes=99, seconds=17.25)),
        ("random crap", None),
    ],
)
def test_time_interval(spark, raw, value):
    assert one(spark, decode.decode_time_interval, raw) == (value, None if value is not None else raw)


@pytest.mark.parametrize(
    "raw,value",
    [("15:06:17", dt.timedelta(hours=15, minutes=6, seconds=17)), ("-25:06:17", None), ("random crap", None),
     ("24:00:00", None)],
)
def test_time_of_day(spark, raw, value):
    assert one(spark, decode.decode_time_of_day, raw) == (value, None if value is not None else raw)


@pytest.mark.parametrize(
    "raw,value",
    [("2007-02-26", dt.date(2007, 2, 26)), ("2007-02-31", None), ("0000-00-00", None), ("2007-02", None),
     (" 2007-2-6 ", dt.date(2007, 2, 6))],
)
def test_date(spark, raw, value):
    assert one(spark, decode.decode_date, raw) == (value, None if value else raw)


@pytest.mark.parametrize(
    "raw,value",
    [
        ("2007-02-25 22:32:17", dt.datetime(2007, 2, 25, 22, 32, 17)),
        ("20070225223217", dt.datetime(2007, 2, 25, 22, 32, 17)),
        ("200702252232", dt.datetime(2007, 2, 25, 22, 32)),
        ("2007-02-31 22:32:17", None),
        ("00000000000000", None),
    ],
)
def test_compact_timestamp(spark, raw, value):
    assert one(spark, decode.decode_compact_timestamp, raw) == (value, None if value else raw)


def test_set_numeric_charset(spark):
    df = spark.createDataFrame([("b,a,b",)], "raw string")
    assert df.select(decode.decode_set(F.col("raw"))).first()[0] == ["a", "b"]
    nums = spark.createDataFrame([(" 12 ",), ("1.5",), ("x",)], "raw string").select(
        decode.decode_numeric(F.col("raw")).alias("d")
    )
    got = [(r.d.as_int, r.d.as_float, r.d.reject) for r in nums.collect()]
    assert got == [(12, 12.0, None), (None, 1.5, None), (None, None, "x")]
    raw = spark.createDataFrame(
        [(bytearray("é".encode()), "utf8mb4"), (bytearray(b"\xff"), "utf8"), (bytearray(b"\xe9"), "latin1"),
         (bytearray("é".encode()), "ascii"), (bytearray(b"ab"), "binary"), (bytearray(b"ab"), "koi8r")],
        "content binary, charset string",
    ).select(decode.decode_charset(F.col("content"), F.col("charset")).alias("d"))
    got = [(r.d.value, r.d.reject) for r in raw.collect()]
    assert got == [("é", None), (None, "FF"), ("é", None), (None, "C3A9"), (None, None), (None, "6162")]


def test_encode_interval_like_timedelta(spark):
    cases = {
        dt.timedelta(days=1, seconds=3977): "25:06:17",
        dt.timedelta(days=-2, seconds=83177): "-25:06:17",
        dt.timedelta(seconds=-1): "-1:59:59",
        dt.timedelta(seconds=5, microseconds=250): "00:00:05.000250",
    }
    df = spark.createDataFrame([(c,) for c in cases], "iv interval day to second")
    got = [r[0] for r in df.select(decode.encode_interval(F.col("iv"))).collect()]
    assert got == list(cases.values())


@pytest.mark.parametrize(
    "raw,as_int,as_float,as_decimal,rejected",
    [
        ("1.123456789012", None, 1.123456789012, "1.123456789012000000", False),
        ("0.1234567890123456789", None, 0.1234567890123456789, None, True),
        ("0.1000000000000000000000", None, 0.1, "0.100000000000000000", False),
        ("12345678901234567890123456789012.5", None, 1.2345678901234567e31, None, True),
        ("00012", 12, 12.0, "12.000000000000000000", False),
        ("9223372036854775807", 2**63 - 1, 2.0**63, "9223372036854775807.000000000000000000", False),
        ("9223372036854775808", None, 2.0**63, "9223372036854775808.000000000000000000", True),
        ("-.5e1", None, -5.0, "-5.000000000000000000", False),
        ("1e30", None, 1e30, None, True),
        ("1d", None, None, None, True),
        ("1f", None, None, None, True),
        ("0x1p3", None, None, None, True),
        (" inf ", None, float("inf"), None, True),
        ("", None, None, None, True),
    ],
)
def test_numeric_readings_lose_nothing_silently(spark, raw, as_int, as_float, as_decimal, rejected):
    d = spark.createDataFrame([(raw,)], "raw string").select(decode.decode_numeric(F.col("raw")).alias("d")).first()["d"]
    assert (d.as_int, d.as_float, None if d.as_decimal is None else f"{d.as_decimal:f}") == (as_int, as_float, as_decimal)
    assert d.reject == (raw if rejected else None)


def test_a_pattern_runs_once_per_text(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "raw string").select(decode.decode_datetime(F.col("raw")).alias("d"))
    plan = df.select("d.value", "d.reject")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan and plan.count("regexp_replace") <= 2


def test_text_that_begins_like_the_internal_mark(spark):
    raw = "\x012024\x0101\x0101\x0100\x0100\x0100\x01"
    assert one(spark, decode.decode_datetime, raw) == (None, raw)
    assert one(spark, decode.decode_datetime, "2024-01-02 03:04:05\x01\n") == (dt.datetime(2024, 1, 2, 3, 4, 5), None)


def test_far_seconds_stay_whole(spark):
    from daybook.functions.dates import epoch_seconds

    far = dt.datetime(9999, 12, 31, 23, 59, 59, 999999)
    df = spark.createDataFrame([(far,), (dt.datetime(1969, 12, 31, 23, 59, 59, 1),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(epoch_seconds(F.col("t"))).collect()] == [253402300799, -1]


MESSY = ["2024-02-31 00:00:07", "x-y-z", "1-2-3-4", "", "-", "--", "2024-13-01", "99999999999999999999-1-1",
         "20240231000000", "2024xx", "12", "99999999999999999999", " 7 ", "1:2", "::", "-1:-2:-3", "٣-1-1"]


@pytest.mark.parametrize(
    "fn",
    [decode.decode_date, decode.decode_datetime, decode.decode_time_interval, decode.decode_time_of_day,
     decode.decode_compact_timestamp, decode.decode_numeric, decode.decode_set,
     lambda c: decode.date_value(c), lambda c: decode.datetime_value(c)],
)
def test_decoders_never_fail_on_messy_text(spark, fn):
    """Each decoder alone, over text that does not parse: rows are rejected,
    the job never fails (no ANSI cast error through eager subexpressions)."""
    df = spark.createDataFrame([(m,) for m in MESSY] + [(None,)], "raw string")
    out = df.select(fn(F.col("raw")).alias("d"))
    assert out.count() == len(MESSY) + 1
    out.collect()


def test_unsigned_64(spark):
    import decimal

    raws = ["18446744073709551615", "18446744073709551616", " +42 ", "-1", "1.5", "9223372036854775808"]
    df = spark.createDataFrame([(r,) for r in raws], "raw string").select(decode.decode_unsigned(F.col("raw")).alias("d"))
    got = [(r.d.value, r.d.reject) for r in df.collect()]
    assert got == [
        (decimal.Decimal("18446744073709551615"), None),
        (None, "18446744073709551616"),
        (decimal.Decimal(42), None),
        (None, "-1"),
        (None, "1.5"),
        (decimal.Decimal("9223372036854775808"), None),
    ]
