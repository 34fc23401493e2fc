"""Raw text columns for the typed-decoding jobs, derived from driver tables.

Each builder renders a typed column of a driver table as text in several
shapes, chosen by a categorical column of the same row (event type, order
priority, document language), so that a fixed share of rows carries malformed
or unusual text.  The same derivations are written as DuckDB SQL in
``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def datetime_texts(events: DataFrame) -> DataFrame:
    ts, kind = F.col("ts"), F.col("event_type")
    raw = (
        F.when(kind == "error", F.concat(F.date_format(ts, "yyyy"), F.lit("-02-31 "), F.date_format(ts, "HH:mm:ss")))
        .when(kind == "click", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == "purchase", F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return events.select(F.col("event_id").alias("id"), raw.alias("raw"))


def date_texts(orders: DataFrame) -> DataFrame:
    d, prio = F.col("o_orderdate"), F.col("o_orderpriority")
    raw = (
        F.when(prio == "1-URGENT", F.concat(F.date_format(d, "yyyy"), F.lit("-02-31")))
        .when(prio == "2-HIGH", F.lit("0000-00-00"))
        .when(prio == "3-MEDIUM", F.date_format(d, "yyyy-M-d"))
        .when(prio == "4-NOT SPECIFIED", F.date_format(d, "yyyy-MM"))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )
    return orders.select(F.col("o_orderkey").alias("id"), raw.alias("raw"))


def _hms(total_seconds, minute_offset=0):
    return F.format_string(
        "%d:%02d:%02d",
        F.floor(total_seconds / 3600),
        F.floor(total_seconds / 60) % 60 + minute_offset,
        total_seconds % 60,
    )


def interval_texts(events: DataFrame) -> DataFrame:
    secs = F.col("event_id") * 37 % 360000  # a duration up to 99:59:59
    kind = F.col("event_type")
    raw = (
        F.when(kind == "error", F.concat(F.lit("-"), _hms(secs)))
        .when(kind == "click", F.concat(_hms(secs), F.lit("."), F.date_format("ts", "SSSSSS")))
        .when(kind == "signup", F.lit("n/a"))
        .when(kind == "purchase", _hms(secs, minute_offset=60))  # minutes 60..119: carried over
        .otherwise(_hms(secs))
    )
    return events.select(F.col("event_id").alias("id"), raw.alias("raw"))


def time_texts(events: DataFrame) -> DataFrame:
    ts, kind = F.col("ts"), F.col("event_type")
    raw = (
        F.when(kind == "error", F.concat(F.lit("-"), F.date_format(ts, "HH:mm:ss")))
        .when(kind == "click", F.concat(F.lit("24:"), F.date_format(ts, "mm:ss")))
        .when(kind == "signup", F.date_format(ts, "HH:mm"))
        .when(kind == "purchase", F.date_format(ts, "H:m:s.SSS"))
        .otherwise(F.date_format(ts, "HH:mm:ss.SSSSSS"))
    )
    return events.select(F.col("event_id").alias("id"), raw.alias("raw"))


def compact_texts(events: DataFrame) -> DataFrame:
    ts, kind = F.col("ts"), F.col("event_type")
    raw = (
        F.when(kind == "click", F.date_format(ts, "yyyyMMddHH"))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "error", F.concat(F.date_format(ts, "yyyy"), F.lit("0231"), F.date_format(ts, "HHmmss")))
        .when(kind == "purchase", F.concat(F.date_format(ts, "yyyyMMdd"), F.lit("xx")))
        .otherwise(F.date_format(ts, "yyyyMMddHHmmss"))
    )
    return events.select(F.col("event_id").alias("id"), raw.alias("raw"))


def set_texts(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").alias("id"), F.regexp_replace(F.col("url"), r"[/?#&=.:]+", ",").alias("raw")
    )


def numeric_texts(orders: DataFrame) -> DataFrame:
    """Prices as text, with suffixes that are no number, integers around 64
    bits, long fractions, more digits than a decimal has, and exponents."""
    price, prio, k = F.col("o_totalprice"), F.col("o_orderpriority"), F.col("o_orderkey")
    text = F.format_string("%.2f", price)
    raw = (
        F.when(prio == "1-URGENT", F.concat(text, F.when(k % 3 == 0, "x").when(k % 3 == 1, "d").otherwise("")))
        .when((prio == "2-HIGH") & (k % 3 == 0), F.when(k % 2 == 0, "9223372036854775807").otherwise("9223372036854775808"))
        .when(prio == "2-HIGH", F.floor(price).cast("string"))
        .when(prio == "3-MEDIUM", F.concat(F.lit("  "), text, F.when(k % 2 == 0, "0123456789012 ").otherwise(" ")))
        .when(prio == "4-NOT SPECIFIED", F.when(k % 3 == 0, "").when(k % 3 == 1, "123456789012345678901234567890.5").otherwise("0." + "1" * 20))
        .otherwise(F.concat(text, F.when(k % 2 == 0, "e1").otherwise("")))
    )
    return orders.select(k.alias("id"), raw.alias("raw"))


# Declared charset per document language in the test data.
CHARSET_BY_LANG = {"en": "utf8mb4", "de": "ascii", "fr": "binary", "es": "koi8r"}


def charset_bytes(documents: DataFrame) -> DataFrame:
    lang = F.col("lang")
    charset = F.lit("utf8mb3")
    for k, v in CHARSET_BY_LANG.items():
        charset = F.when(lang == k, v).otherwise(charset)
    return documents.select(
        F.col("doc_id").alias("id"),
        charset.alias("charset"),
        F.encode(F.col("text"), "UTF-8").alias("content"),
    )
