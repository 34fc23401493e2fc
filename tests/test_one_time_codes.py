"""One-time codes against published vectors, and attempts judged one after another."""

import hmac
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import one_time_codes as otc

SECRET = b"12345678901234567890"
# Published test values (RFC 4226, appendix D; RFC 6238, appendix B): fixed.
HOTP = ["755224", "287082", "359152", "969429", "338314", "254676", "287922", "162583", "399871", "520489"]
TOTP = {
    "sha1": {59: "94287082", 1111111109: "07081804", 1111111111: "14050471", 1234567890: "89005924", 2000000000: "69279037", 20000000000: "65353130"},
    "sha256": {59: "46119246", 1111111109: "68084774", 1111111111: "67062674", 1234567890: "91819424", 2000000000: "90698825", 20000000000: "77737706"},
    "sha512": {59: "90693936", 1111111109: "25091201", 1111111111: "99943326", 1234567890: "93441116", 2000000000: "38618901", 20000000000: "47863826"},
}
LENGTHS = {"sha1": 20, "sha256": 32, "sha512": 64}


def test_counter_codes(spark):
    df = spark.range(10).withColumn("k", F.lit(SECRET)).orderBy("id")
    assert [r[0] for r in df.select(otc.hotp(F.col("k"), F.col("id"))).collect()] == HOTP


@pytest.mark.parametrize("algo", sorted(TOTP))
def test_time_codes(spark, algo):
    secret = (SECRET * 4)[: LENGTHS[algo]]
    df = spark.createDataFrame([(s, c, secret) for s, c in TOTP[algo].items()], "s long, c string, k binary")
    assert df.where(otc.totp(F.col("k"), F.col("s"), 8, algo) == F.col("c")).count() == len(TOTP[algo])


def test_wrong_parameters():
    with pytest.raises(ValueError):
        otc.hotp(F.lit(SECRET), F.lit(1), digits=5)
    with pytest.raises(ValueError):
        otc.hotp(F.lit(SECRET), F.lit(1), algo="md5")


def plain(secret, counter, digits=6):
    mac = hmac.new(secret, (counter & (1 << 64) - 1).to_bytes(8, "big"), "sha1").digest()
    at = mac[-1] & 15
    return str((int.from_bytes(mac[at : at + 4], "big") & 0x7FFFFFFF) % 10**digits).zfill(digits)


def brute(rows, drift):
    used, out = set(), {}
    for user, seconds, attempt, secret, code in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2])):
        step = None
        if None not in (seconds, secret, code):
            near = sorted(range(-drift, drift + 1), key=lambda d: (abs(d), d))
            step = next((seconds // 30 + d for d in near if plain(secret, seconds // 30 + d) == code), None)
        out[attempt] = (step, "refused" if step is None else "replayed" if (user, step) in used else "accepted")
        if step is not None:
            used.add((user, step))
    return out


SCHEMA = "user string, seconds long, attempt long, secret binary, code string"


def judged(spark, rows, **kw):
    got = otc.totp_verify(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    assert len(got) == len(rows)
    return {r.attempt: (r.step, r.status) for r in got}


@pytest.mark.parametrize("drift", [0, 1, 2])
def test_attempts_equal_a_walk(spark, drift):
    rng = random.Random(drift)
    secrets = {u: rng.randbytes(20) for u in ("a", "b", None)}
    rows = []
    for i in range(600):
        user, seconds = rng.choice(["a", "a", "b", None]), rng.randint(0, 900)
        code = plain(secrets[user], seconds // 30 + rng.randint(-3, 3))
        rows.append((user, seconds, i, secrets[user], rng.choice([code, code, code, code[:-1], None, "000000"])))
    rows += [("a", None, 1000, secrets["a"], "123456"), ("a", 5, 1001, None, "123456"), ("a", 5, 1002, b"", plain(b"", 0))]
    got = judged(spark, rows, drift=drift)
    assert got == brute(rows, drift)
    assert {s for _, s in got.values()} == {"accepted", "replayed", "refused"}


def test_a_flood_at_one_step(spark):
    code = plain(SECRET, 7)
    got = judged(spark, [("u", 210 + i % 30, i, SECRET, code) for i in range(3000)])
    assert [a for a, (_, s) in got.items() if s == "accepted"] == [0]
    assert {s for _, s in got.values()} == {"accepted", "replayed"}


def test_clashing_names_and_no_rows(spark):
    df = spark.createDataFrame([("u", 0, 1, SECRET, HOTP[0], "x", "y")], SCHEMA + ", step string, status string")
    out = otc.totp_verify(df)
    assert out.columns == ["user", "seconds", "attempt", "code", "step", "status"]
    assert out.first()[-2:] == (0, "accepted")
    assert judged(spark, []) == {}
