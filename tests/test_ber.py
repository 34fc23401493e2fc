"""Tag-length-value bytes against a recursive reading and a plain writer."""

import random

from pyspark.sql import functions as F

from daybook.operators import ber


def tlv(tag, content, kind=0, constructed=False):
    head = [kind << 6 | constructed << 5 | min(tag, 31)]
    if tag >= 31:
        digits = [tag % 128]
        while tag >= 128:
            tag //= 128
            digits.append(tag % 128 + 128)
        head += digits[::-1]
    n = len(content)
    size = [n] if n < 128 else [128 + (n.bit_length() + 7) // 8, *n.to_bytes((n.bit_length() + 7) // 8, "big")]
    return bytes(head + size) + content


def nested(rng, path, rows, depth):
    out = b""
    for i in range(1, rng.randint(0, 4) + 1):
        at, tag, kind = (*path, i), rng.choice([1, 2, 4, 30, 31, 127, 128, 70000]), rng.randint(0, 3)
        inner = depth > 0 and rng.random() < 0.6
        content = nested(rng, at, rows, depth - 1) if inner else rng.randbytes(rng.choice([0, 1, 5, 127, 128, 300, 70000]))
        rows.add((at, kind, inner, tag, len(content), None if inner else content, "ok"))
        out += tlv(tag, content, kind, inner)
    return out


def exploded(spark, values):
    df = spark.createDataFrame(list(values), "id string, data binary").withColumn("path", F.lit("clash"))
    rows = [(r.id, tuple(r.path), r["class"], r.constructed, r.tag, r.size, None if r.value is None else bytes(r.value), r.status) for r in ber.ber_explode(df, "id", "data").collect()]
    return sorted(rows, key=str)


def test_random_trees(spark):
    rng, values, want = random.Random(3), [], []
    for i in range(60):
        rows = set()
        values.append((str(i), nested(rng, (), rows, 5)))
        want += [(str(i), *r) for r in rows]
    assert exploded(spark, values) == sorted(want, key=str)


def test_broken_values(spark):
    deep = tlv(4, b"x")
    for _ in range(12):
        deep = tlv(16, deep, constructed=True)
    good = tlv(2, b"\x05")
    got = exploded(spark, [
        ("null", None), ("empty", b""), ("cut", good + tlv(4, b"abc")[:-1]), ("tag", b"\x1f\x81"), ("bare", b"\x04"), ("length", b"\x04\x82\x01"),
        ("endless", b"\x30\x80" + good + b"\0\0"), ("inside", tlv(16, good + b"\x04\x09x", constructed=True) + good), (None, good), (None, good), ("deep", deep),
    ])
    rest = sorted((r for r in got if r[0] != "deep"), key=str)
    five = (0, False, 2, 1, b"\x05", "ok")
    assert rest == sorted([
        ("cut", (1,), *five), ("cut", (2,), 0, False, 4, None, None, "truncated"), ("tag", (1,), 0, False, None, None, None, "truncated"),
        ("bare", (1,), 0, False, 4, None, None, "truncated"), ("length", (1,), 0, False, 4, None, None, "truncated"), ("endless", (1,), 0, True, 16, None, None, "indefinite"),
        ("inside", (1,), 0, True, 16, 6, None, "ok"), ("inside", (1, 1), *five), ("inside", (1, 2), 0, False, 4, None, None, "truncated"), ("inside", (2,), *five),
        (None, (1,), *five), (None, (1,), *five),
    ], key=str)
    assert [len(r[1]) for r in got if r[0] == "deep" and r[6] == b"x"] == [13]
    assert exploded(spark, []) == []


def test_columns_write_what_the_plain_writer_does(spark):
    numbers = [0, 1, -1, 127, 128, -128, -129, 32767, 32768, -(2**31), 2**40, 2**63 - 1, -(2**63), None]
    rows = spark.createDataFrame([(n, None if n is None else b"z" * (abs(n) % 70_000)) for n in numbers], "n long, data binary")
    made = rows.select("n", "data", ber.integer(F.col("n")).alias("i"), ber.part(F.col("data"), 200, ber.CONTEXT).alias("p"), ber.sequence(ber.integer(F.col("n")), ber.boolean(F.col("n") > 0)).alias("s"))
    back = made.withColumn("back", ber.integer_of(F.expr("substring(i, 3)")))
    for r in back.collect():
        if r.n is None:
            assert r.i is r.p is r.s is r.back is None
            continue
        size = next(k for k in range(1, 9) if -(1 << 8 * k - 1) <= r.n < 1 << 8 * k - 1)
        plain = tlv(2, r.n.to_bytes(size, "big", signed=True))
        assert (bytes(r.i), bytes(r.p), r.back) == (plain, tlv(200, bytes(r.data), 2), r.n)
        assert bytes(r.s) == tlv(16, plain + tlv(1, b"\xff" if r.n > 0 else b"\0"), constructed=True)
