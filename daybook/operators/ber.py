"""Nested tag-length-value bytes as rows, and column builders that make them.

``ber_explode`` takes the values apart level by level: every task splits its
values into their parts, and the constructed parts are the values of the next
level.  A level is one narrow job over what the level before holds, written to
the shared folder; there are as many as the data is deep, and no shuffle.

Defined results: a null or empty value has no parts; repeated ids give their
rows again; a part that says it is longer than what holds it, or whose header
ends early, is one row ``truncated``, and one of indefinite length a row
``indefinite``: what follows it on its level cannot be found and has no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.protect import bind
from daybook.session import scratch_path

UNIVERSAL, CONTEXT = 0, 2
BOOLEAN, INTEGER, OCTETS, SEQUENCE = 1, 2, 4, 16
STEP_BYTES = 4 << 20  # bytes of values taken apart at once inside a task

PART = T.StructType([
    T.StructField("path", T.ArrayType(T.IntegerType())), T.StructField("class", T.IntegerType()), T.StructField("constructed", T.BooleanType()),
    T.StructField("tag", T.LongType()), T.StructField("size", T.LongType()), T.StructField("value", T.BinaryType()), T.StructField("status", T.StringType()),
])


def parts(data: bytes):
    """(class, constructed, tag, size, value, status) of each part in order."""
    at, end = 0, len(data)
    while at < end:
        first, at = data[at], at + 1
        kind, tag, status = (first >> 6, bool(first & 32)), first & 31, "ok"
        if tag == 31:
            tag, more = 0, True
            while more and at < end:
                tag, more, at = tag << 7 | data[at] & 127, data[at] > 127, at + 1
            if more or tag >> 63:
                yield *kind, None, None, None, "truncated"
                return
        if at == end:
            yield *kind, tag, None, None, "truncated"
            return
        size, at = data[at], at + 1
        if size == 128:
            yield *kind, tag, None, None, "indefinite"
            return
        if size > 128:
            digits = data[at : at + size - 128]
            at, size = at + len(digits), int.from_bytes(digits, "big") if len(digits) == size - 128 else end + 1
        if size > end - at:
            yield *kind, tag, None, None, "truncated"
            return
        yield *kind, tag, size, data[at : at + size], status
        at += size


def _split(batches):
    for batch in batches:
        schema = pa.schema([
            batch.schema.field(0), ("path", pa.list_(pa.int32())), ("class", pa.int32()), ("constructed", pa.bool_()),
            ("tag", pa.int64()), ("size", pa.int64()), ("value", pa.binary()), ("status", pa.string()),
        ])
        rows, size = [], 0
        for r in range(batch.num_rows):
            path, data = batch.column(1)[r].as_py(), batch.column(2)[r].as_py() or b""
            rows += [(r, [*path, n], *p) for n, p in enumerate(parts(data), 1)]
            size += len(data)
            if rows and (size > STEP_BYTES or r == batch.num_rows - 1):
                of, *columns = zip(*rows, strict=True)
                made = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), *made], schema=schema)
                rows, size = [], 0


def ber_explode(rows: DataFrame, id_col: str, data_col: str) -> DataFrame:
    """One row per part: ``id``, ``path`` (place in its holder, from the
    outermost on, each from 1), ``class``, ``constructed``, ``tag``, ``size``,
    ``value`` (null if constructed) and ``status``."""
    spark = rows.sparkSession
    level = rows.select(rows[id_col].alias("id"), F.array().cast("array<int>").alias("path"), rows[data_col].alias("value"))
    schema = T.StructType([T.StructField("id", level.schema["id"].dataType), *PART.fields])
    out = None
    while out is None or not level.isEmpty():
        path = scratch_path(spark, "ber-level")
        level.mapInArrow(_split, schema).write.parquet(path)
        split = spark.read.schema(schema).parquet(path)
        out = split if out is None else out.unionByName(split)
        level = split.where(F.col("constructed") & (F.col("size") > 0)).select("id", "path", "value")
    return out.withColumn("value", F.when(~F.col("constructed"), F.col("value")))


def _header(kind: int, constructed: bool, tag: int) -> bytes:
    first = kind << 6 | constructed << 5
    if tag < 31:
        return bytes([first | tag])
    digits = [tag >> 7 * i & 127 for i in range(max(1, -(-tag.bit_length() // 7)))]
    return bytes([first | 31, *(d | 128 for d in digits[:0:-1]), digits[0]])


def _big_endian(n: Column) -> Column:
    return F.unhex(F.lpad(F.hex(n), 16, "0"))


def part(content: Column, tag: int, kind: int = UNIVERSAL, constructed: bool = False) -> Column:
    """Bytes with their tag and length; null stays null."""

    def with_header(c: Column) -> Column:
        n = F.octet_length(c).cast("bigint")
        long_form = [F.when(n < 256**k, F.concat(F.lit(bytes([128 + k])), F.substring(_big_endian(n), 9 - k, k))) for k in (1, 2, 3, 4)]
        size = F.when(n < 128, F.substring(_big_endian(n), 8, 1)).otherwise(F.coalesce(*long_form))
        return F.concat(F.lit(_header(kind, constructed, tag)), size, c)

    # Bound once: nested parts would otherwise repeat their content's tree.
    return bind(content, with_header)


def integer(n: Column) -> Column:
    """A bigint as the fewest bytes of two's complement."""
    n = n.cast("bigint")
    short = [F.when(n.between(-(1 << 8 * k - 1), (1 << 8 * k - 1) - 1), F.substring(_big_endian(n), 9 - k, k)) for k in range(1, 8)]
    return part(F.coalesce(*short, _big_endian(n)), INTEGER)


def boolean(b: Column) -> Column:
    return part(F.when(b, F.lit(b"\xff")).when(~b, F.lit(b"\x00")), BOOLEAN)


def sequence(*members: Column) -> Column:
    return part(F.concat(*members), SEQUENCE, constructed=True)


def integer_of(value: Column) -> Column:
    """The bigint of an integer's bytes; null if it has none or more than eight."""
    sign = F.when(F.hex(value).rlike("^[89A-F]"), "F").otherwise("0")
    return F.when(F.octet_length(value).between(1, 8), F.conv(F.lpad(F.hex(value), 16, sign), 16, -10).cast("bigint"))
