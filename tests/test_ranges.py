"""Read plans against a map of wanted bytes."""

import random

import pytest

from daybook.operators import ranges as rg


def brute(rows, request):
    """Requests of the stretches of a byte map."""
    files = {}
    for file, offset, size in rows:
        if file is not None and offset is not None and size is not None and offset >= 0 and size > 0:
            files.setdefault(file, set()).update(range(offset, offset + size))
    out = []
    for file, wanted in files.items():
        for first in sorted(b for b in wanted if b - 1 not in wanted):
            stop = first
            while stop in wanted:
                stop += 1
            out += [(file, at, min(request, stop - at)) for at in range(first, stop, request)]
    return sorted(out)


def made(spark, rows, request, segment):
    df = spark.createDataFrame(rows, "file string, offset long, size long")
    return sorted(tuple(r) for r in rg.range_read_plan(df, request, segment).select("file", "offset", "length").collect())


@pytest.mark.parametrize("request_,segment", [(7, 50), (32, 10), (100, 64), (5, 1000)])
def test_equals_a_byte_map(spark, request_, segment):
    rng = random.Random(segment)
    # A hot file with most ranges, one that is wanted whole in small pieces.
    rows = [("hot", rng.randint(0, 1500), rng.choice([0, 1, 3, 10, 120])) for _ in range(150)]
    rows += [(f"f{rng.randint(0, 9)}", rng.randint(0, 400), rng.randint(1, 60)) for _ in range(60)]
    rows += [("whole", i * 4, 4) for i in range(120)] + [("one", 3, 777)] + [("same", 9, 9)] * 40
    rows += [(None, 1, 1), ("n", None, 5), ("n", 5, None), ("n", -5, 10), ("n", 5, 0), ("n", 5, -3)]
    assert made(spark, rows, request_, segment) == brute(rows, request_)


def test_no_byte_twice_and_none_missing_at_the_real_size(spark):
    rows = [("a", 0, 100 << 20), ("a", (100 << 20) + 1, 10), ("b", (8 << 20) - 1, 2), ("b", 8 << 20, 40_000)]
    got = made(spark, rows, rg.REQUEST_BYTES, rg.SEGMENT_BYTES)
    a = [r for r in got if r[0] == "a"]
    assert [r[1] for r in a[:-1]] == list(range(0, 100 << 20, 32_768)) and {r[2] for r in a[:-1]} == {32_768}
    assert a[-1] == ("a", (100 << 20) + 1, 10)
    assert [r for r in got if r[0] == "b"] == [("b", (8 << 20) - 1, 32_768), ("b", (8 << 20) + 32_767, 7_233)]
    assert made(spark, [("x", 5, 0)], 10, 10) == []


def test_hot_file_is_dealt_out_by_segment(spark):
    df = spark.createDataFrame([("hot", i, 1) for i in range(10)], "file string, offset long, size long")
    plan = rg.coalesced(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan
    windows = [line for line in plan.split("\n") if line.strip(" :+-").startswith("Window")]
    # Only the border islands, two a segment at most, are ordered by file alone.
    assert sum("segment" in w.split("],")[1] for w in windows) >= 1
