"""Vector codes against Lloyd's rounds in plain integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from daybook.llm import vectorcodes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, id string, x string, code string, part int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", 1) for r in rows], SCHEMA)


def brute(rows, parts, entries, rounds, scale=256):
    kept = [(i, [math.floor(scale * c) for c in v], lab) for i, v, lab in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(order[0][1]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in order[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: [min(range(len(b)), key=lambda k: (dist(part, b[k]), k)) for part, b in zip(cut(v), books, strict=True)]
    for _ in range(rounds):
        at = [(near(v), cut(v)) for _, v, _ in kept]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for a, c in at if a[p] == k]
                if mine:
                    books[p][k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    out = []
    for i, v, lab in kept:
        a = near(v)
        out.append((i, lab, "".join(f"{k:02x}" for k in a), sum(dist(c, books[p][k]) for p, (c, k) in enumerate(zip(cut(v), a, strict=True)))))
    return out, books


def key(rows):
    return sorted(rows, key=str)


def test_rounds_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(c) for c in rng.normal(size=8).round(2)], int(i % 3) if i % 5 else None) for i in rng.permutation(300)]
    rows += [(7, rows[0][1], 9), (None, rows[1][1], None)] + [(1000 + i, [0.5] * 8, 4) for i in range(150)]  # a crowded entry
    for members in (200_000, 20):
        monkeypatch.setattr(vc, "MEMBERS", members)
        coded, books = vc.compress(vectors_of(spark, rows), parts=4, entries=16, rounds=3)
        want, want_books = brute(rows, 4, 16, 3)
        assert books.tolist() == want_books
        assert key((r.id, r.label, r.code, r.error) for r in coded.collect()) == key(want)


def test_migrants_alone_are_shuffled(spark):
    """After the first round no exchange carries members that stay."""
    df = spark.createDataFrame([(0, 1, 0, [1, 2], False), (0, 1, 0, [5, 5], True)], vc._MEMBER)
    stay = df.where(~F.col("moved"))
    assert "Exchange" not in stay._jdf.queryExecution().executedPlan().toString()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None, 1), (1, [], 1), (2, [nan] * 4, 1), (3, [1.0, None, 0.0, 0.0], 1), (4, [inf] * 4, 1), (5, [1.0, 2.0, 3.0], 1), (6, [-0.001, 0.0, 1e30, -1e30], None), (6, [-0.001, 0.0, 1e30, -1e30], None)]
    coded, books = vc.compress(vectors_of(spark, rows), parts=2)
    got = coded.collect()
    assert [(r.id, r.label, r.code, r.error) for r in got] == [(6, None, "0000", 0)] * 2
    assert books[0][0].tolist() == [-1, 0] and books[1][0].tolist() == [256 << 20, -(256 << 20)]
    empty, books = vc.compress(vectors_of(spark, []))
    assert books is None and empty.collect() == []


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()][:150]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(folder := vc.written(spark.range(1), "x").inputFiles()[0].rsplit("/", 1)[0] + "-in/embeddings.parquet")
    got = vc.op11_vectorcodes(spark, folder.rsplit("/", 1)[0]).collect()
    want, books = brute(rows, 16, 64, 2)
    assert key((r.vec_id, r.code, r.error) for r in got) == key((i, c, e) for i, _, c, e in want)
    sums = {}
    for _, lab, _, e in want:
        sums[lab] = sums.get(lab, 0) + e
    labels = {i: lab for i, lab, _, _ in want}
    assert all(r.label_error == sums[labels[r.vec_id]] for r in got)
    text = ",".join(str(c) for b in books for e in b for c in e)
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(text.encode()).hexdigest()}


@pytest.mark.parametrize("n", [1, 3])
def test_fewer_vectors_than_entries(spark, n):
    rows = [(i, [float(i), 0.0], 0) for i in range(n)]
    coded, books = vc.compress(vectors_of(spark, rows), parts=2)
    assert books.shape == (2, n, 1) and all(r.error == 0 for r in coded.collect())
