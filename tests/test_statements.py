"""Statements against the client's own loop over rows, and literals against
the client's rules."""

import datetime as dt
import decimal
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.functions import literals
from daybook.operators import statements as st


def greedy(sizes, limit, c=0):
    """Open size and number begun after rows of these sizes."""
    begun = 0
    for s in sizes:
        if not c or c + s > limit:
            c, begun = 0, begun + 1
        c += s
    return c, begun


@pytest.mark.parametrize("seed", range(4))
def test_cut_functions_equal_the_loop(seed):
    rng = random.Random(seed)
    for _ in range(150):
        limit = rng.randint(5, 60)
        parts = [[rng.randint(1, rng.choice([3, 20, 80])) for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(1, 5))]
        f = st.composed([st.cut_function(np.array(p, np.int64), limit) for p in parts])
        for c in range(limit + 30):
            assert f(c) == greedy(sum(parts, []), limit, c)


def loop(rows, prefix, postfix, most):
    """The client's loop: close before the row that makes it too long."""
    out, sql, n = [], None, 0
    for v in rows:
        if sql is not None and len(sql) + len(v) + len(postfix) + 1 > most:
            out.append((n, sql + postfix))
            sql = None
        sql, n = (prefix + v, 1) if sql is None else (sql + b"," + v, n + 1)
    return out + ([(n, sql + postfix)] if sql is not None else [])


@pytest.mark.parametrize("most,partitions", [(200, 7), (1000, 3), (5000, 200), (10**6, 8), (1, 5)])
def test_statements_equal_the_loop(spark, most, partitions):
    rng = random.Random(most)
    rows = [(rng.randint(0, 300), "x'" * rng.choice([0, 1, 5, 40])) for _ in range(700)] + [(50, "a")] * 60
    df = spark.createDataFrame(rows, "k long, t string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = [(r.statement, r.n_rows, r.n_bytes, bytes(r.sql)) for r in st.insert_statements(df, "t", ["k", "t"], ["k"], postfix=" /* é */", max_bytes=most).orderBy("statement").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    tuples = [v for _, v in sorted((k, b"(%d,'%s')" % (k, t.replace("'", "\\'").encode())) for k, t in rows)]
    want = loop(tuples, b"INSERT INTO t (k, t) VALUES ", " /* é */".encode(), most)
    assert got == [(i, n, len(s), s) for i, (n, s) in enumerate(want)]


def test_empty_table(spark):
    assert st.insert_statements(spark.createDataFrame([], "k long"), "t", ["k"], ["k"]).collect() == []


def test_doubles_have_fifteen_digits(spark):
    rng = random.Random(2)
    xs = [0.0, -0.0, 1.0, -1.5, 1e15, 1e14, 123456789012345678.0, 1e-4, 1e-5, 0.1 + 0.2, 1e300, -2.5e-300, 1 / 3, 100.0, float("nan"), float("inf"), float("-inf"), 2.3e-308, 1.7976931348623157e308]
    xs += [rng.uniform(-1, 1) * 10 ** rng.randint(-20, 20) for _ in range(300)]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").select("i", literals.general_double(F.col("x")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == ["%.15g" % x for x in xs]


def test_literals_of_all_types(spark):
    d = decimal.Decimal
    row = (True, -3, d("12.30"), 'a\\b\0\n\r\x1a"\'é', b"\x00\xff'\\z", dt.date(2020, 2, 3), dt.datetime(2020, 2, 3, 4, 5, 6), dt.datetime(2020, 2, 3, 4, 5, 6, 70), -dt.timedelta(hours=30, seconds=1), 2.5)
    kinds = "a boolean, b int, c decimal(9,2), d string, e binary, f date, g timestamp_ntz, h timestamp_ntz, i interval day to second, j float"
    df = spark.createDataFrame([row, (None,) * 10], kinds)
    got = [bytes(r[0]) for r in df.select(literals.values_tuple(df, df.columns)).collect()]
    want = b"(1,-3,12.30,'a\\\\b\\0\\n\\r\\Z\\\"\\'" + "é".encode() + b"','\\0\xff\\'\\\\z','2020-02-03','2020-02-03 04:05:06','2020-02-03 04:05:06.000070','-31:59:59',2.5)"
    assert got == [want, b"(" + b",".join([b"NULL"] * 10) + b")"]
    with pytest.raises(TypeError, match="no literal"):
        literals.literal(F.col("x"), spark.createDataFrame([], "x map<int,int>").schema["x"].dataType)
