"""Result sets typed by their descriptors.

A result set arrives as raw cells (bytes, or null) and one descriptor per column
(name, type code, flags, scale, charset number); the types are data, not code.

* ``decode_cells`` types a long table of cells of many result sets in one pass:
  every cell becomes a ``VARIANT`` of the type that its descriptor says, or
  keeps its bytes in ``reject``.
* ``typed_table`` gives one result set as a table whose schema is made from
  the descriptors: one typed column each, rejects in a map.

The rules for single values are those of ``functions.decode``.  Text of a binary
charset stays bytes; JSON is always text of the connection; unsigned 64-bit
integers are decimals; a TIME in a variant is its signed microseconds, as
variants know no interval.  A type code that nobody knows is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import decode
from daybook.operators.surface import unique_names

# The protocol's type codes, flags and charset numbers.
DECIMAL, TINY, SHORT, LONG, FLOAT, DOUBLE, NULL, TIMESTAMP, LONGLONG, INT24, DATE, TIME, DATETIME, YEAR, NEWDATE, VARCHAR, BIT = range(17)
JSON, NEWDECIMAL, ENUM, SET, TINY_BLOB, MEDIUM_BLOB, LONG_BLOB, BLOB, VAR_STRING, STRING, GEOMETRY = range(245, 256)
UNSIGNED = 32
BINARY_CHARSET = 63

INTEGERS = {TINY: "tinyint", SHORT: "smallint", INT24: "int", LONG: "int", LONGLONG: "bigint", YEAR: "int"}
#: The next wider type holds what an unsigned column can.
WIDER = {"tinyint": "smallint", "smallint": "int", "int": "bigint", "bigint": "decimal(20,0)"}
FLOATS = {FLOAT: "float", DOUBLE: "double"}
DECIMALS = (DECIMAL, NEWDECIMAL)
DATES = (DATE, NEWDATE)
BYTES = (BIT, GEOMETRY)
TEXTS = (TINY_BLOB, MEDIUM_BLOB, LONG_BLOB, BLOB, VAR_STRING, STRING, VARCHAR)

CELLS = "result string, row long, position int, content binary"
DESCRIPTORS = "result string, position int, table_name string, name string, type_code int, flags int, scale int, charset int"


def _text(content: Column) -> Column:
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text)


def _whole(text: Column) -> Column:
    return F.when(text.rlike(decode.INT_TEXT), F.trim(text))


def spark_type(type_code: int, flags: int = 0, scale: int = 0, charset: int = 33) -> T.DataType:
    """The column type of a descriptor."""
    if type_code in INTEGERS:
        name = INTEGERS[type_code]
        name = WIDER[name] if flags & UNSIGNED else name
    elif type_code in DECIMALS:
        name = f"decimal(38,{min(max(scale, 0), 38)})"
    elif type_code in TEXTS:
        name = "binary" if charset == BINARY_CHARSET else "string"
    else:
        name = {
            **FLOATS, **dict.fromkeys(DATES, "date"), **dict.fromkeys((TIMESTAMP, DATETIME), "timestamp_ntz"), TIME: "interval day to second",
            SET: "array<string>", NULL: "void", **dict.fromkeys(BYTES, "binary"),
        }.get(type_code, "string")
    return T.NullType() if name == "void" else T.DataType.fromDDL(name)


def typed(content: Column, type_code: int, flags: int = 0, scale: int = 0, charset: int = 33) -> Column:
    """The typed value of raw bytes, null where they do not parse."""
    return _typed(content, _text(content), type_code, flags, scale, charset)


def _typed(content: Column, text: Column, type_code: int, flags: int = 0, scale: int = 0, charset: int = 33) -> Column:
    kind = spark_type(type_code, flags, scale, charset)
    if type_code in INTEGERS:
        value = _whole(text).try_cast("decimal(38,0)").try_cast(kind)
        return F.when(value >= 0, value) if flags & UNSIGNED else value
    if type_code in FLOATS:
        return decode.decode_numeric(text)["as_float"].cast(kind)
    if type_code in DECIMALS:
        return decode.decode_numeric(text, 38, kind.scale)["as_decimal"]
    if type_code in DATES:
        return decode.date_value(text)
    if type_code == DATETIME:
        return decode.datetime_value(text)
    if type_code == TIMESTAMP:
        return decode.decode_compact_timestamp(text)["value"]
    if type_code == TIME:
        return decode.decode_time_interval(text)["value"]
    if type_code == SET:
        return decode.decode_set(text)
    if type_code == NULL:
        return F.lit(None)
    return content if isinstance(kind, T.BinaryType) else text


def decode_cells(cells: DataFrame, descriptors: DataFrame) -> DataFrame:
    """One row per cell: ``result``, ``row``, ``position``, ``name``,
    ``type_code``, ``value`` (variant) and ``reject`` (the bytes of a cell that
    is not null but has no value).  Cells without a descriptor are text named by
    their position."""
    known = descriptors.select("result", "position", "name", "type_code", "flags", "scale", "charset")
    code, content, text, exact = F.col("type_code"), F.col("content"), F.col("_text"), F.col("_exact")
    # The text and its decimal reading are columns of their own: inside the rules
    # below, each use would compute them again.
    rows = cells.join(known, ["result", "position"], "left").withColumn("_text", _text(content))
    rows = rows.withColumn("_exact", F.when(code.isin(*DECIMALS), decode.decode_numeric(text)["as_decimal"]))
    unsigned = F.col("flags").bitwiseAND(UNSIGNED) != 0
    whole = _whole(text)
    bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}

    def integers() -> Column:
        """Within the type's range, as a 64-bit integer or, unsigned, a decimal."""
        out, number = F.lit(None).cast("variant"), whole.try_cast("decimal(20,0)")
        for c, name in INTEGERS.items():
            n = bits[name]
            low, high = F.when(unsigned, F.lit(0)).otherwise(F.lit(-(2 ** (n - 1)))), F.when(unsigned, F.lit(str(2**n - 1)).cast("decimal(20,0)")).otherwise(F.lit(str(2 ** (n - 1) - 1)).cast("decimal(20,0)"))
            fits = number.between(low.cast("decimal(20,0)"), high)
            small = number.try_cast("bigint")
            out = F.when((code == c) & fits, F.coalesce(small.cast("variant"), number.cast("variant"))).otherwise(out)
        return out

    def scaled() -> Column:
        at_scale = F.when(F.bround(exact, 0) == exact, True)
        # A fraction longer than the column's scale cannot be one of its values.
        digits = F.length(F.regexp_replace(F.regexp_extract(exact.cast("string"), r"\.(\d*)$", 1), "0+$", ""))
        return F.when(F.coalesce(at_scale, digits <= F.greatest(F.col("scale"), F.lit(0))), exact.cast("variant"))

    value = (
        F.when(code.isin(*INTEGERS), integers())
        .when(code == FLOAT, _typed(content, text, FLOAT).cast("variant"))
        .when(code == DOUBLE, _typed(content, text, DOUBLE).cast("variant"))
        .when(code.isin(*DECIMALS), scaled())
        .when(code.isin(*DATES), _typed(content, text, DATE).cast("variant"))
        .when(code == DATETIME, _typed(content, text, DATETIME).cast("variant"))
        .when(code == TIMESTAMP, _typed(content, text, TIMESTAMP).cast("variant"))
        .when(code == TIME, decode.interval_micros(_typed(content, text, TIME)).cast("variant"))
        .when(code == SET, _typed(content, text, SET).cast("variant"))
        .when(code == JSON, F.try_parse_json(text))
        .when(code == NULL, F.lit(None).cast("variant"))
        .when(code.isin(*BYTES) | (code.isin(*TEXTS) & (F.col("charset") == BINARY_CHARSET)), content.cast("variant"))
        .otherwise(text.cast("variant"))
    )
    made = rows.select("result", "row", "position", F.coalesce("name", F.col("position").cast("string")).alias("name"), "type_code", value.alias("value"), "content")
    return made.select(*made.columns[:-1], F.when(F.col("value").isNull() & (code.isNull() | (code != NULL)), content).alias("reject"))


def typed_table(cells: DataFrame, descriptors: DataFrame, result: str) -> DataFrame:
    """One row per ``row`` of a result set: ``row``, the typed columns in
    their order (a repeated name becomes ``table.name``) and ``rejects`` (name
    to bytes of the cells that did not parse)."""
    # One descriptor per column of the result: a bounded list.
    fields = descriptors.where(F.col("result") == result).orderBy("position").collect()
    names = unique_names([f["name"] for f in fields], [f["table_name"] for f in fields])
    raw = [F.max(F.when(F.col("position") == f["position"], F.col("content"))).alias(f"c{i}") for i, f in enumerate(fields)]
    wide = cells.where(F.col("result") == result).groupBy("row").agg(*(raw or [F.lit(1).alias("c")]))
    columns, rejects = [F.col("row")], []
    for i, (name, f) in enumerate(zip(names, fields, strict=True)):
        value = typed(F.col(f"c{i}"), f["type_code"], f["flags"] or 0, f["scale"] or 0, 33 if f["charset"] is None else f["charset"])
        columns.append(value.alias(name))
        bad = F.lit(False) if f["type_code"] == NULL else value.isNull()
        rejects.append(F.struct(F.lit(name).alias("key"), F.when(bad, F.col(f"c{i}")).alias("value")))
    held = F.filter(F.array(*rejects), lambda r: r["value"].isNotNull()) if rejects else F.array().cast("array<struct<key:string,value:binary>>")
    return wide.select(*columns, F.map_from_entries(held).alias("rejects"))
