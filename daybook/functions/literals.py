"""SQL literals of typed columns, as the bytes a client sends.

Rules of the client library for values inside a statement: text is quoted and
seven characters are escaped, numbers are plain text, doubles have 15
significant digits, temporal values are canonical text in quotes, NULL is
``NULL``.  Text is encoded as UTF-8; bytes of a binary column are sent as they
are, quoted and escaped like text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.decode import encode_date, encode_interval, encode_timestamp
from daybook.functions.protect import bind

# Characters and their escaped forms (the backslash first).
ESCAPES = (("\\", "\\\\"), ("\0", "\\0"), ("\n", "\\n"), ("\r", "\\r"), ("\x1a", "\\Z"), ('"', '\\"'), ("'", "\\'"))
SIGNIFICANT = 15


def escaped(text: Column) -> Column:
    for plain, form in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(form))
    return text


def general_double(x: Column, digits: int = SIGNIFICANT) -> Column:
    """C's ``%.15g``: ``digits`` significant digits without trailing zeros, an
    exponent below 10^-4 and from 10^digits.  (Subnormal numbers, below 2.3e-308,
    have the fewest digits that tell them apart.)"""
    # Digits with the point after ``k`` of them, without idle zeros.
    def pointed(text: Column, k: Column) -> Column:
        return F.regexp_replace(F.concat(F.substr(text, F.lit(1), k), F.lit("."), F.substr(text, k + 1)), r"\.?0*$", "")

    def shaped(p: Column) -> Column:
        exponent, sign, known = p["exponent"], p["sign"], p["digits"]
        power = F.format_string("e%+03d", exponent)
        plain = F.when(exponent >= 0, pointed(known, exponent + 1)).otherwise(pointed(F.concat(F.repeat(F.lit("0"), -exponent), known), F.lit(1)))
        return F.concat(sign, F.when((exponent < -4) | (exponent >= digits), F.concat(pointed(known, F.lit(1)), power)).otherwise(plain))

    # (``format_string`` would round the shortest digits, not the value.)
    shown = F.call_function("format_number", x.cast("double"), F.lit("0." + "0" * (digits - 1) + "E0"))

    # Each part once per row.
    def parts(text: Column) -> Column:
        return F.struct(
            F.when(text.startswith("-"), "-").otherwise("").alias("sign"),
            F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int").alias("exponent"),
            F.replace(F.regexp_extract(text, r"^-?(.*)E", 1), F.lit("."), F.lit("")).alias("digits"),
        )

    finite = bind(shown, lambda text: bind(parts(text), shaped))
    zero = F.when(F.call_function("format_number", x.cast("double"), F.lit("0")).startswith("-"), "-0").otherwise("0")
    return F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf").when(x == 0, zero).otherwise(finite)


def literal(c: Column, kind: T.DataType) -> Column:
    """The literal of a column of type ``kind``, as bytes; never null."""
    quoted = lambda text: F.concat(F.lit("'"), text, F.lit("'"))
    if isinstance(kind, T.BinaryType):
        # One character per byte, so that the escapes work on bytes.
        made = F.encode(quoted(escaped(F.decode(c, "ISO-8859-1"))), "ISO-8859-1")
    else:
        if isinstance(kind, T.BooleanType):
            text = c.cast("int").cast("string")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            text = general_double(c)
        elif isinstance(kind, T.NumericType):
            text = c.cast("string")
        elif isinstance(kind, T.DateType):
            text = quoted(encode_date(c))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            text = quoted(encode_timestamp(c))
        elif isinstance(kind, T.DayTimeIntervalType):
            text = quoted(encode_interval(c))
        elif isinstance(kind, (T.StringType, T.VarcharType, T.CharType, T.NullType)):
            text = quoted(escaped(c.cast("string")))
        else:
            raise TypeError(f"no literal for a column of type {kind.simpleString()}")
        made = F.encode(text, "UTF-8")
    return F.coalesce(F.when(c.isNotNull(), made), F.encode(F.lit("NULL"), "UTF-8"))


def values_tuple(df: DataFrame, columns: Sequence[str]) -> Column:
    """``(a,b,...)`` of a row, as bytes."""
    parts = [F.encode(F.lit("("), "UTF-8")]
    for i, name in enumerate(columns):
        if i:
            parts.append(F.encode(F.lit(","), "UTF-8"))
        parts.append(literal(df[name], df.schema[name].dataType))
    return F.concat(*parts, F.encode(F.lit(")"), "UTF-8"))
