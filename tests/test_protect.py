"""Column protection against Python's hashlib/hmac and the published token example."""

import base64
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from daybook.functions import protect as pr

# Published example of the token format: key, time, IV, message and token.
SPEC_KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="
SPEC_TIME = 499162800
SPEC_IV = bytes(range(16))
SPEC_TOKEN = "gAAAAAAdwJ6wAAECAwQFBgcICQoLDA0ODy021cpGVWKZ_eEwCGM4BLLF_5CV9dOPmrhuVUPgJobwOz7JcbmrR64jVmpU4IwqDA=="
OTHER_KEY = base64.urlsafe_b64encode(bytes(32)).decode()
TEXTS = ["", "hello", "ünïcödé ✓", "x" * 1000]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "v string")


@pytest.mark.parametrize("algo", pr.DIGESTS)
def test_digests_equal_hashlib(texts, algo):
    got = [r[0] for r in texts.select(pr.digest_column(F.col("v"), algo)).collect()]
    assert got == [hashlib.new(algo, t.encode()).hexdigest() for t in TEXTS]
    b64 = [r[0] for r in texts.select(pr.digest_column(F.col("v"), algo, "base64")).collect()]
    assert b64 == [base64.b64encode(hashlib.new(algo, t.encode()).digest()).decode() for t in TEXTS]


@pytest.mark.parametrize("key", [b"k", b"secret-key", b"x" * 64, b"y" * 100])
def test_hmac_equals_python(texts, key):
    got = [r[0] for r in texts.select(pr.hmac_column(F.col("v"), key)).collect()]
    assert got == [hmac.new(key, t.encode(), hashlib.sha256).hexdigest() for t in TEXTS]


def test_token_matches_published_example(spark):
    df = spark.createDataFrame([("hello",)], "v string")
    tok = df.select(pr.token_encrypt(F.col("v"), SPEC_KEY, F.lit(SPEC_TIME), F.lit(SPEC_IV))).first()[0]
    assert tok == SPEC_TOKEN


def test_token_checks(spark):
    df = spark.createDataFrame([(SPEC_TOKEN,), ("not a token",), (SPEC_TOKEN[:-4] + "AAA=",)], "t string")

    def run(key, ttl=None, now=None):
        d = pr.token_decrypt(F.col("t"), key, ttl, None if now is None else F.lit(now))
        return [(r.d.value, r.d.reason) for r in df.select(d.alias("d")).collect()]

    assert run(SPEC_KEY) == [(b"hello", None), (None, "malformed"), (None, "bad_signature")]
    assert run(OTHER_KEY)[0] == (None, "bad_signature")
    assert run(SPEC_KEY, ttl=60, now=SPEC_TIME + 60)[0] == (b"hello", None)
    assert run(SPEC_KEY, ttl=60, now=SPEC_TIME + 61)[0] == (None, "expired")
    assert run(SPEC_KEY, ttl=60, now=SPEC_TIME - 61)[0] == (None, "future")
    assert run(SPEC_KEY, ttl=60, now=SPEC_TIME - 60)[0] == (b"hello", None)
    ts = [r[0] for r in df.select(pr.token_timestamp(F.col("t"), SPEC_KEY)).collect()]
    assert ts == [SPEC_TIME, None, None]


def test_random_iv_tokens_are_consistent_under_filters(spark):
    """The IV is drawn once per row even when the token feeds several
    expressions and a pushed-down filter."""
    df = spark.range(2000).select(F.col("id").cast("string").alias("v"))
    t = df.select("v", pr.token_encrypt(F.col("v"), SPEC_KEY, F.lit(SPEC_TIME)).alias("t"))
    d = t.select("v", pr.token_decrypt(F.col("t"), SPEC_KEY).alias("d"))
    assert d.where(F.col("d.reason").isNotNull()).count() == 0
    assert d.where(F.col("d.value").cast("string") == F.col("v")).count() == 2000
    r = t.select("v", pr.token_rotate(F.col("t"), [OTHER_KEY, SPEC_KEY]).alias("r"))
    back = r.select("v", pr.token_decrypt(F.col("r"), OTHER_KEY).alias("d"))
    assert back.where((F.col("d.value").cast("string") == F.col("v")) & (F.col("d.seconds") == SPEC_TIME)).count() == 2000


def test_aes_gcm(spark):
    key = bytes(range(32))
    df = spark.createDataFrame([("secret",)], "v string")
    sealed = pr.aes_gcm_encrypt(F.encode("v", "UTF-8"), key, b"aad", iv=F.lit(bytes(12)))
    r = df.select(
        pr.aes_gcm_decrypt(sealed, key, b"aad").cast("string").alias("ok"),
        pr.aes_gcm_decrypt(sealed, key, b"bad").alias("bad"),
        F.length(pr.aes_gcm_ciphertext(sealed)).alias("n"),
        F.substring(sealed, 1, 12).alias("iv"),
    ).first()
    assert (r.ok, r.bad, r.n, bytes(r.iv)) == ("secret", None, 6 + 16, bytes(12))
