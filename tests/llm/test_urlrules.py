"""URL rules against enumeration of all token sets."""

import itertools
import math
import random

from daybook.llm import urlrules as ur


def pages_of(spark, urls):
    return spark.createDataFrame([(i, u, "html", "clash") for i, u in enumerate(urls)], "page_id long, url string, html string, verdict string")


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_host_path_and_stated_rules(spark):
    cases = {
        "http://Sub.Example.NET/en/x?q=/de/": ("sub.example.net", "/en/x", "example.net/en/", "allow"),
        "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "https://a.example.com/de/1#f": ("a.example.com", "/de/1", "example.com/de/", "block"),
        "https://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"),
        "https://x.net": ("x.net", "", None, "allow"),
        "https://x.net?y=/a": ("x.net", "", None, "allow"),
        "//x.net/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "a://ÄB.net/\n/p://q": ("Äb.net", "/\n/p://q", "net/", "block"),
    }
    got = ur.judge(pages_of(spark, [*cases, None]), labels_of(spark, [])).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [*cases.values(), ("", "", None, "allow")]


def test_tokens(spark):
    (r,) = pages_of(spark, ["HTTPS://blog.Spam7.example.com/en/12/a1.html?page=2&ref=x#top"]).select(ur.tokens(ur.F.col("url")).alias("t")).collect()
    assert r.t == sorted(["scheme:https", "host:blog", "host:spam#", "host:example", "host:com", "path:en", "path:#", "path:a#", "path:html", "query:page=#", "query:ref=x", "part:top"])


def test_learnt_rules_equal_enumeration(spark):
    rng = random.Random(1)
    urls = [f"http://{rng.choice(['a', 'b', 'c'])}.{rng.choice(['x', 'y'])}.biz/{rng.choice(['p', 'q', 'r'])}/{rng.choice(['u', 'v'])}" for _ in range(400)]
    bad = [int("//b." in u and "/q/" in u) if rng.random() < 0.9 else rng.randint(0, 1) for u in urls]
    pages, labels = pages_of(spark, urls), labels_of(spark, [(i, 1 - b, 0) for i, b in enumerate(bad[:300])])
    have = [set(r.t) for r in pages.select(ur.tokens(ur.F.col("url")).alias("t")).collect()]
    least = max(math.ceil(0.02 * 300), 5)
    sets = {}
    for t, b in zip(have[:300], bad, strict=False):
        for n in (1, 2, 3):
            for c in itertools.combinations(sorted(t), n):
                x = sets.setdefault(c, [0, 0])
                x[0] += b
                x[1] += 1
    rules = {c: (b / n, b) for c, (b, n) in sets.items() if b >= least and b / n >= 0.6}
    assert rules
    want = []
    for t in have:
        fits = sorted((-conf, -sup, len(c), " ".join(c)) for c, (conf, sup) in rules.items() if set(c) <= t)
        want.append((fits[0][3], -fits[0][0]) if fits else (None, None))
    got = ur.judge(pages, labels, min_support=0.02).orderBy("page_id").collect()
    assert [(r.learnt, r.confidence) for r in got] == want
    assert [r.verdict for r in got] == ["block" if w else "allow" for w, _ in want]


def test_edges(spark):
    urls = [None, "", "http://", "http://a/", "http://a/", "x" * 100_000, "http://a/" + "b/" * 30_000]
    labels = labels_of(spark, [(0, 0, 1), (3, None, None), (3, 0, None), (4, 1, 1), (4, 1, 1), (99, 0, 0), (None, 0, 1)])
    got = ur.judge(pages_of(spark, urls), labels, min_pages=1).orderBy("page_id").collect()
    assert len(got) == len(urls) and [r.verdict for r in got][3:5] == ["block", "block"] and got[0].verdict == "allow"
    assert ur.judge(pages_of(spark, []), labels).collect() == []


def test_rules_of_all_sizes_equal_enumeration(spark):
    rng = random.Random(4)
    # Only four or five tokens together tell: three of them are never enough.
    urls = [f"http://{rng.choice(['a', 'b'])}.{rng.choice(['x', 'y'])}.biz/{rng.choice(['p', 'q'])}/{rng.choice(['u', 'v'])}" for _ in range(600)]
    bad = [int("//b.x." in u and "/q/v" in u) if rng.random() < 0.95 else rng.randint(0, 1) for u in urls]
    pages, labels = pages_of(spark, urls), labels_of(spark, [(i, 1 - b, 0) for i, b in enumerate(bad)])
    have = [set(r.t) for r in pages.select(ur.tokens(ur.F.col("url")).alias("t")).collect()]
    sets = {}
    for t, b in zip(have, bad, strict=True):
        for n in range(1, len(t) + 1):
            for c in itertools.combinations(sorted(t), n):
                x = sets.setdefault(c, [0, 0])
                x[0] += b
                x[1] += 1
    rules = {c: (b / n, b) for c, (b, n) in sets.items() if b >= 12 and b / n >= 0.6}
    assert rules and min(map(len, rules)) == 4
    want = []
    for t in have:
        fits = sorted((-conf, -sup, len(c), " ".join(c)) for c, (conf, sup) in rules.items() if set(c) <= t)
        want.append((fits[0][3], -fits[0][0], "block") if fits else (None, None, "allow"))
    got = ur.judge(pages, labels, min_support=0.02).orderBy("page_id").collect()
    assert [(r.learnt, r.confidence, r.verdict) for r in got] == want


def test_long_shared_url(spark):
    """A URL of 40 tokens on 1 % of the labelled pages adds one group, not 2^40 sets."""
    long = "http://a.spam.biz/" + "/".join(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6))
    urls = [f"http://{'abc'[i % 3]}.{'xy'[i % 2]}.biz/p" for i in range(990)] + [long] * 10
    pages = pages_of(spark, [*urls, "http://z/waa", "http://z/wff/q", "http://z/none"])
    got = {r.page_id: r for r in ur.judge(pages, labels_of(spark, [(i, int(i < 990), 0) for i in range(1000)])).collect()}
    assert all(got[i].verdict == "block" and got[i].learnt == "host:spam" and got[i].confidence == 1.0 for i in range(990, 1000))
    assert [(got[i].verdict, got[i].learnt) for i in (0, 1000, 1001, 1002)] == [("allow", None), ("block", "path:waa"), ("block", "path:wff"), ("allow", None)]
