"""Links against a walk from link to link."""

import posixpath
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import links as lk


def brute(links, files):
    table = {}
    for p, t in links:
        if p is not None and t is not None:
            p, at = norm(p), norm(t if t.startswith("/") else p_folder(p) + t)
            table[p] = min(at, table.get(p, at))
    files, out = {norm(f) for f in files if f is not None}, set()
    for p, t in table.items():
        at, hops = t, 1
        while at in table and hops <= len(table):
            at, hops = table[at], hops + 1
        out.add((p, t, None, None, "cycle") if at in table else (p, t, at, hops, "ok" if at in files else "broken"))
    return out


def p_folder(p):
    return p[: p.rfind("/") + 1]


def norm(p):
    return "/" + posixpath.normpath("/" + p).strip("/")


def made(spark, links, files):
    got = lk.resolve_links(spark.createDataFrame(links, "path string, target string"), spark.createDataFrame([(f,) for f in files], "path string")).collect()
    rows = {tuple(r) for r in got}
    assert len(rows) == len(got)
    return rows


def test_paths_are_normalised(spark):
    cases = ["/a/b", "/a/./b//c/", "/a/../../b", "/", "/..", "/a/b/../..", "//x", "/a b/é/..c", ""]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(cases)), "i int, p string").orderBy("i").select(lk.normalised(F.col("p"))).collect()]
    assert got == [norm(c) for c in cases]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_links_equal_the_walk(spark, seed):
    rng = random.Random(seed)
    name = lambda: rng.choice(["/", "/d/", "/d/e/"]) + f"l{rng.randint(0, 60)}"
    links = [(name(), rng.choice([name(), f"l{rng.randint(0, 60)}", f"../l{rng.randint(0, 60)}", "./f1", "/d/f2", "/gone", "..", "."])) for _ in range(150)]
    links += [(None, "/x"), ("/y", None), ("/self", "self"), ("/d//dup", "/f1"), ("/d/dup", "/a"), ("/empty", "")]
    assert made(spark, links, ["/f1", "/d/f1", "/d/f2", "/d/e/f1", None, "/", "/d"]) == brute(links, ["/f1", "/d/f1", "/d/f2", "/d/e/f1", None, "/", "/d"])


def test_long_chains_long_cycles_and_a_crowded_target(spark):
    links = [(f"/c/{i}", f"{i + 1}") for i in range(1000)] + [(f"/r/{i}", f"/r/{(i + 1) % 300}") for i in range(300)]
    links += [(f"/to/{i}", "/c/0") for i in range(700)] + [("/into", "/r/5")]
    got = {r[0]: r for r in made(spark, links, ["/c/1000"])}
    assert got["/c/0"][2:] == ("/c/1000", 1000, "ok") and got["/to/9"][2:] == ("/c/1000", 1001, "ok")
    assert got["/into"][2:] == (None, None, "cycle") and got["/r/299"][4] == "cycle" and set(got.values()) == brute(links, ["/c/1000"])


def test_empty(spark):
    assert made(spark, [], ["/a"]) == set()
