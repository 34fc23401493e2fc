"""Result sets typed by descriptors: every type, rejects, schemas from data."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from daybook.operators import result_sets as rs

D = decimal.Decimal
B = rs.BINARY_CHARSET
# (type code, flags, scale, charset, Spark type, {cell: value, None for a reject})
CASES = [
    (rs.TINY, 0, 0, B, "tinyint", {b"-128": -128, b"127": 127, b"128": None, b" 5 ": 5, b"x": None}),
    (rs.TINY, rs.UNSIGNED, 0, B, "smallint", {b"255": 255, b"-1": None}),
    (rs.SHORT, 0, 0, B, "smallint", {b"-32768": -32768, b"40000": None}),
    (rs.INT24, 0, 0, B, "int", {b"8388607": 8388607}),
    (rs.LONG, 0, 0, B, "int", {b"2147483647": 2147483647, b"2147483648": None, b"1.5": None}),
    (rs.LONG, rs.UNSIGNED, 0, B, "bigint", {b"4294967295": 4294967295}),
    (rs.LONGLONG, 0, 0, B, "bigint", {b"9223372036854775807": 2**63 - 1, b"9223372036854775808": None}),
    (rs.LONGLONG, rs.UNSIGNED, 0, B, "decimal(20,0)", {b"18446744073709551615": D(2**64 - 1), b"-1": None}),
    (rs.YEAR, 0, 0, B, "int", {b"2020": 2020}),
    (rs.FLOAT, 0, 0, B, "float", {b"1.5": 1.5, b"1.5x": None}),
    (rs.DOUBLE, 0, 0, B, "double", {b"-2.5e3": -2500.0, b"": None}),
    (rs.NEWDECIMAL, 0, 2, B, "decimal(38,2)", {b"12.30": D("12.30"), b"1.234": None, b"1e1": D("10.00")}),
    (rs.DECIMAL, 0, 0, B, "decimal(38,0)", {b"7": D(7), b"7.5": None}),
    (rs.DATE, 0, 0, B, "date", {b"2020-02-03": dt.date(2020, 2, 3), b"0000-00-00": None}),
    (rs.NEWDATE, 0, 0, B, "date", {b"2020-02-30": None}),
    (rs.DATETIME, 0, 6, B, "timestamp_ntz", {b"2020-02-03 04:05:06.5": dt.datetime(2020, 2, 3, 4, 5, 6, 500000), b"no": None}),
    (rs.TIMESTAMP, 0, 0, B, "timestamp_ntz", {b"20200203040506": dt.datetime(2020, 2, 3, 4, 5, 6), b"2020": None}),
    (rs.TIME, 0, 6, B, "interval day to second", {b"-25:06:17": -dt.timedelta(hours=25, minutes=6, seconds=17), b"n/a": None}),
    (rs.SET, 0, 0, 45, "array<string>", {b"b,a,b": ["a", "b"], b"": [""]}),
    (rs.BIT, 0, 0, B, "binary", {b"\x05\xff": b"\x05\xff"}),
    (rs.GEOMETRY, 0, 0, B, "binary", {b"\x00": b"\x00"}),
    (rs.BLOB, 0, 0, B, "binary", {b"\xff\xfe": b"\xff\xfe"}),
    (rs.BLOB, 0, 0, 45, "string", {"é".encode(): "é", b"\xff": None}),
    (rs.VAR_STRING, 0, 0, 45, "string", {b"text": "text", b"": ""}),
    (rs.STRING, 0, 0, B, "binary", {b"pad\x00": b"pad\x00"}),
    (rs.VARCHAR, 0, 0, 45, "string", {b"v": "v"}),
    (rs.ENUM, 0, 0, 45, "string", {b"small": "small"}),
    (rs.JSON, 0, 0, B, "string", {b'{"a": [1, 2]}': '{"a": [1, 2]}'}),
    (rs.NULL, 0, 0, B, "void", {}),
    (77, 0, 0, 45, "string", {b"unknown code": "unknown code"}),
]


@pytest.fixture(scope="module")
def inputs(spark):
    cells, descriptors = [], []
    for p, (code, flags, scale, charset, _, values) in enumerate(CASES):
        descriptors.append(("r", p, f"t{p}", f"c{p}", code, flags, scale, charset))
        cells += [("r", k, p, content) for k, content in enumerate([*values, None])]
    cells += [("other", 0, 0, b"x"), ("undescribed", 1, 4, b"text"), ("undescribed", 1, 5, b"\xff")]
    descriptors.append(("other", 0, "t", "c", rs.VAR_STRING, 0, 0, 45))
    return spark.createDataFrame(cells, rs.CELLS), spark.createDataFrame(descriptors, rs.DESCRIPTORS)


def test_schema_comes_from_the_descriptors(spark, inputs):
    made = rs.typed_table(*inputs, "r")
    want = [kind for *_, kind, _ in CASES]
    assert [f.dataType.simpleString() for f in made.schema][1:-1] == want and made.columns == ["row", *[f"c{p}" for p in range(len(CASES))], "rejects"]


def test_typed_columns_and_rejects(inputs):
    got = {r.row: r for r in rs.typed_table(*inputs, "r").collect()}
    for p, (*_, values) in enumerate(CASES):
        for k, (content, value) in enumerate([*values.items(), (None, None)]):
            assert got[k][f"c{p}"] == value, (p, content)
            assert got[k].rejects.get(f"c{p}") == (content if value is None and content is not None else None), (p, content)


def test_variants_and_rejects_in_one_pass(spark, inputs):
    done = rs.decode_cells(*inputs)
    kinds = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "interval day to second": "bigint", "void": "string", "decimal(20,0)": "decimal(20,0)"}
    for p, (code, *_, kind, values) in enumerate(CASES):
        rows = done.where((F.col("result") == "r") & (F.col("position") == p))
        read = F.col("value").cast("string") if code == rs.JSON else F.variant_get("value", "$", kinds.get(kind, kind))
        got = {r.row: (r.v, r.reject) for r in rows.select("row", read.alias("v"), "reject").collect()}
        for k, (content, value) in enumerate([*values.items(), (None, None)]):
            if isinstance(value, dt.timedelta):
                value = value // dt.timedelta(microseconds=1)
            if code == rs.JSON and value:
                value = value.replace(" ", "")
            assert got[k][0] == value and got[k][1] == (content if value is None and content is not None else None), (p, content, got[k])
    loose = {r.position: (r.name, r.v, r.reject) for r in done.where("result = 'undescribed'").select("position", "name", F.col("value").cast("string").alias("v"), "reject").collect()}
    assert loose == {4: ("4", "text", None), 5: ("5", None, b"\xff")}


def test_repeated_names_and_empty_results(spark):
    cells = spark.createDataFrame([("r", 1, 0, b"1"), ("r", 1, 1, b"2"), ("r", 1, 2, b"3"), ("r", 2, 1, b"x")], rs.CELLS)
    d = spark.createDataFrame([("r", i, t, "id", rs.LONG, 0, 0, B) for i, t in enumerate("abb")], rs.DESCRIPTORS)
    made = rs.typed_table(cells, d, "r")
    assert made.columns[:3] == ["row", "id", "b.id"] and len(set(made.columns)) == 5
    assert [tuple(r)[:4] for r in made.orderBy("row").collect()] == [(1, 1, 2, 3), (2, None, None, None)]
    assert rs.typed_table(cells, d, "none").collect() == []
    assert rs.decode_cells(cells.limit(0), d).collect() == []


def test_cells_meet_descriptors_by_broadcast_not_by_pairs(spark, inputs):
    plan = rs.decode_cells(*inputs)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Python" not in plan


def test_cells_are_not_shuffled_to_the_task_of_their_column(spark):
    """The cells of a column would all meet in one task: 13 tasks at any size."""
    from conftest import SF001
    from daybook.plans.client_jobs import q_decode_by_descriptor

    plan = q_decode_by_descriptor(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_the_decimal_reading_is_computed_once(spark):
    cells = spark.createDataFrame([("r", 1, 0, b"1.50"), ("r", 2, 0, b"1.234"), ("r", 3, 0, b"x")], rs.CELLS)
    known = spark.createDataFrame([("r", 0, "t", "c", rs.NEWDECIMAL, 0, 2, B)], rs.DESCRIPTORS)
    done = rs.decode_cells(cells, known)
    assert done._jdf.queryExecution().executedPlan().toString().count("as decimal(38,18)") <= 2
    got = done.select("row", F.try_variant_get("value", "$", "decimal(38,18)").alias("v"), "reject").orderBy("row").collect()
    assert [(r["v"], r["reject"] and bytes(r["reject"])) for r in got] == [(D("1.50"), None), (None, b"1.234"), (None, b"x")]
