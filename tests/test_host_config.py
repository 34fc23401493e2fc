"""Host configuration against nested loops over hosts and blocks."""

import fnmatch
import random

from daybook.operators import host_config as hc

PATTERNS, OPTIONS = "block long, pattern string, negated boolean", "block long, position int, key string, value string"
LOCAL = {"%u": "me", "%d": "/home/me"}


def brute(hosts, patterns, options):
    out = {}
    blocks = sorted({b for b, _, _ in patterns})
    for host in {h for h in hosts if h is not None}:
        found = {}
        for block in blocks:
            fits = {neg for b, p, neg in patterns if b == block and fnmatch.fnmatchcase(host, p)}
            if fits != {False}:
                continue
            mine = {}
            for _, _, key, value in sorted((o for o in options if o[0] == block), key=lambda o: o[1]):
                key = key.lower()
                value = None if key == "proxycommand" and value.lower() == "none" else value
                if key in hc.ADDED_UP + hc.LISTED:
                    mine.setdefault(key, []).append(value)
                else:
                    mine.setdefault(key, [value])
            for key, values in mine.items():
                if key not in found:
                    found[key] = list(dict.fromkeys(values)) if key in hc.ADDED_UP else values
                elif key in hc.ADDED_UP:
                    found[key] = list(dict.fromkeys(found[key] + values))
        name = found.pop("hostname", [host])[0].replace("%h", host)
        stands = {"%d": "/home/me", "%h": name, "%L": "localhost", "%l": "localhost", "%n": host, "%p": found.get("port", ["22"])[0], "%r": found.get("user", ["me"])[0], "%u": "me", "~": "/home/me"}
        for key, values in found.items():
            for token, text in stands.items():
                if token in hc.TOKENS.get(key, ()):
                    values = [v if v is None else v.replace(token, text) for v in values]
            out[host, key] = values
        out[host, "hostname"] = [name]
    return out


def made(spark, hosts, patterns, options):
    df = hc.host_config_lookup(spark.createDataFrame([(h,) for h in hosts], "host string"), spark.createDataFrame(patterns, PATTERNS), spark.createDataFrame(options, OPTIONS), LOCAL)
    rows = df.collect()
    assert len({(r.host, r.key) for r in rows}) == len(rows)
    return {(r.host, r.key): r["values"] for r in rows}


def test_random_rules_equal_nested_loops(spark):
    rng = random.Random(8)
    part = lambda: rng.choice(["a", "db", "web1", "x-y", "example", "com", "org", "(b", "+"])
    hosts = [".".join(part() for _ in range(rng.randint(1, 4))) for _ in range(60)] + ["", "db", "Db.com", "a[b.com", None, None, "a", "a"]
    wild = lambda: rng.choice(["*", "?", "*.", "db*", "*b", "[a-d]b", "[!x]*", "web?", "*.com", "*e.com", "*.example.com", "a", "a.db", "a[b*", "*y*", part() + ".*", "*." + part(), part()])
    patterns = [(b, wild() + rng.choice(["", "", "." + part()]), rng.random() < 0.2) for b in range(40) for _ in range(rng.randint(1, 4))]
    keys = ["User", "port", "IdentityFile", "ProxyCommand", "LocalForward", "HostName", "ControlPath", "user"]
    value = lambda: rng.choice(["none", "v%h", "%p-%r", "~/k", "%d%u%l", "1", "2", "%n"])
    options = [(b, i, k, "80" if k == "port" else value()) for b in range(40) for i, k in enumerate(rng.sample(keys, rng.randint(0, 6)) + ["identityfile"])]
    assert made(spark, hosts, patterns, options) == brute(hosts, patterns, options)


def test_first_value_wins_and_lists(spark):
    patterns = [(1, "*.a.org", False), (1, "bad.*", True), (2, "*", False), (3, "www.a.org", False)]
    options = [(1, 0, "Port", "1"), (1, 1, "port", "2"), (2, 0, "PORT", "3"), (2, 1, "IdentityFile", "~/x"), (3, 0, "identityfile", "%d/y"), (3, 1, "identityfile", "~/x"), (2, 2, "LocalForward", "p"), (2, 3, "LocalForward", "q"), (3, 2, "localforward", "r")]
    got = made(spark, ["www.a.org", "bad.a.org"], patterns, options)
    assert got["www.a.org", "port"] == ["1"] and got["bad.a.org", "port"] == ["3"]
    assert got["www.a.org", "identityfile"] == ["/home/me/x", "/home/me/y"]
    assert got["www.a.org", "localforward"] == ["p", "q"] and got["www.a.org", "hostname"] == ["www.a.org"]


def test_empty_inputs(spark):
    assert made(spark, ["h", None], [], []) == {("h", "hostname"): ["h"]}
    assert made(spark, [], [(1, "*", False)], [(1, 0, "user", "x")]) == {}


def test_patterns_are_found_by_index(spark):
    hosts, patterns = spark.createDataFrame([("a.b",)], "host string"), spark.createDataFrame([(1, "*.b", False)], PATTERNS)
    plan = hc.applying_blocks(hosts, patterns)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
