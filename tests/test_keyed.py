"""Keyed functions against published vectors, Python's hmac and plain restatements."""

import hashlib
import hmac
import random

import pytest
from pyspark.sql import functions as F

from daybook.functions import keyed as kd

RNG = random.Random(5)
KEYS = [b"k", b"", RNG.randbytes(20), RNG.randbytes(64), RNG.randbytes(65), RNG.randbytes(128), RNG.randbytes(200)]
DATA = [b"", b"a", RNG.randbytes(15), RNG.randbytes(16), RNG.randbytes(17), RNG.randbytes(64), RNG.randbytes(5000)]


def one(spark, column, **values):
    schema = ", ".join(f"{k} binary" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("out")).first()[0]


def as_bytes(value):
    return None if value is None else bytes(value)


@pytest.mark.parametrize("algo", sorted(kd.DIGEST_BYTES))
def test_hmac_by_key_equals_python(spark, algo):
    rows = [(k, d) for k in KEYS for d in DATA]
    df = spark.createDataFrame(rows, "k binary, d binary").select("k", "d", kd.hmac_by_key(F.col("d"), F.col("k"), algo).alias("m"))
    for k, d, m in df.collect():
        assert bytes(m) == hmac.new(bytes(k), bytes(d), algo).digest()


# Published test cases (RFC 5869, cases 1 to 3 and 4): fixed values.
HKDF = [
    ("sha256", "0b" * 22, "000102030405060708090a0b0c", "f0f1f2f3f4f5f6f7f8f9", 42,
     "3cb25f25faacd57a90434f64d0362f2a2d2d0a90cf1a5a4c5db02d56ecc4c5bf34007208d5b887185865"),
    ("sha256", bytes(range(80)).hex(), bytes(range(0x60, 0xB0)).hex(), bytes(range(0xB0, 0x100)).hex(), 82,
     "b11e398dc80327a1c8e7f78c596a49344f012eda2d4efad8a050cc4c19afa97c59045a99cac7827271cb41c65e590e09da3275600c2f09b8367793a9aca3db71cc30c58179ec3e87c14c01d5c1f3434f1d87"),
    ("sha256", "0b" * 22, None, "", 42, "8da4e775a563c18f715f802a063c5a31b8a11f5c5ee1879ec3454e5f3c738d2d9d201395faa4b61a96c8"),
    ("sha1", "0b" * 11, "000102030405060708090a0b0c", "f0f1f2f3f4f5f6f7f8f9", 42,
     "085a01ea1b10f36933068b56efa5ad81a4f14b822f5b091568a9cdd4f155fda2c22e422478d305f3f896"),
]


@pytest.mark.parametrize("algo,material,salt,info,length,expected", HKDF)
def test_hkdf_vectors(spark, algo, material, salt, info, length, expected):
    salted = None if salt is None else F.col("s")
    made = kd.hkdf_column(F.col("m"), salted, F.col("i"), length, algo)
    got = one(spark, made, m=bytes.fromhex(material), s=bytes.fromhex(salt or ""), i=bytes.fromhex(info))
    assert bytes(got).hex() == expected


def plain_hkdf(material, salt, info, length, algo):
    key, out, last = hmac.new(salt, material, algo).digest(), b"", b""
    for i in range(1, 256):
        if len(out) >= length:
            break
        last = hmac.new(key, last + info + bytes([i]), algo).digest()
        out += last
    return out[:length]


@pytest.mark.parametrize("algo,length", [("sha256", 1), ("sha256", 32), ("sha256", 255 * 32), ("sha512", 130), ("sha1", 41)])
def test_derived_keys_per_row(spark, algo, length):
    rows = [(RNG.randbytes(n), RNG.randbytes(n * 3 % 70), RNG.randbytes(n % 9)) for n in (0, 1, 33, 64, 1000)]
    df = spark.createDataFrame(rows + [(None, b"s", b"i"), (b"m", None, b"i"), (b"m", b"s", None)], "m binary, s binary, i binary")
    m, s, i = F.col("m"), F.col("s"), F.col("i")
    got = df.select("m", "s", "i", kd.hkdf_column(m, s, i, length, algo), kd.concat_kdf(m, i, length, algo)).collect()
    for m, s, i, key, single in got:
        if m is None or s is None or i is None:
            assert key is None
            continue
        m, s, i = bytes(m), bytes(s), bytes(i)
        assert bytes(key) == plain_hkdf(m, s, i, length, algo)
        size = kd.DIGEST_BYTES[algo]
        blocks = [hashlib.new(algo, c.to_bytes(4, "big") + m + i).digest() for c in range(1, -(-length // size) + 1)]
        assert bytes(single) == b"".join(blocks)[:length]


@pytest.mark.parametrize("length", [0, 255 * 32 + 1])
def test_lengths_out_of_range(length):
    with pytest.raises(ValueError):
        kd.hkdf_expand(F.lit(b"k"), F.lit(b""), length)


# Published test cases of AES-CMAC (RFC 4493; SP 800-38B for 24 and 32 bytes): fixed values.
MESSAGE = bytes.fromhex(
    "6bc1bee22e409f96e93d7e117393172aae2d8a571e03ac9c9eb76fac45af8e5130c81c46a35ce411e5fbc1191a0a52eff69f2445df4f9b17ad2b417be66c3710"
)
CMAC = [
    ("2b7e151628aed2a6abf7158809cf4f3c", 0, "bb1d6929e95937287fa37d129b756746"),
    ("2b7e151628aed2a6abf7158809cf4f3c", 16, "070a16b46b4d4144f79bdd9dd04a287c"),
    ("2b7e151628aed2a6abf7158809cf4f3c", 40, "dfa66747de9ae63030ca32611497c827"),
    ("2b7e151628aed2a6abf7158809cf4f3c", 64, "51f0bebf7e3b9d92fc49741779363cfe"),
    ("8e73b0f7da0e6452c810f32b809079e562f8ead2522c6b7b", 0, "d17ddf46adaacde531cac483de7a9367"),
    ("603deb1015ca71be2b73aef0857d77811f352c073b6108d72d9810a30914dff4", 0, "028962f61b7bf89efc6b551f4667d983"),
]


@pytest.mark.parametrize("key,length,expected", CMAC)
def test_cmac_vectors(spark, key, length, expected):
    got = one(spark, kd.cmac_column(F.col("d"), F.col("k")), d=MESSAGE[:length], k=bytes.fromhex(key))
    assert bytes(got).hex() == expected


def chained_cmac(spark, rows):
    """Block after block, each with its own call of the cipher."""
    cipher = lambda pairs: [
        bytes(r[0])[:16]
        for r in spark.createDataFrame([(i, b, k) for i, (b, k) in enumerate(pairs)], "i int, b binary, k binary")
        .orderBy("i").select(F.aes_encrypt("b", "k", F.lit("ECB"), F.lit("PKCS"))).collect()
    ]
    xor = lambda a, b: bytes(x ^ y for x, y in zip(a, b))

    def double(b):
        n = int.from_bytes(b, "big") << 1
        return ((n ^ 0x87) & ((1 << 128) - 1) if n >> 128 else n).to_bytes(16, "big")

    zeros = cipher([(bytes(16), k) for _, k in rows])
    chains = []
    for (d, _), z in zip(rows, zeros):
        k1 = double(z)
        blocks = [d[i : i + 16] for i in range(0, len(d), 16)] or [b""]
        blocks[-1] = xor(blocks[-1], k1) if len(blocks[-1]) == 16 else xor((blocks[-1] + b"\x80").ljust(16, b"\0"), double(k1))
        chains.append(blocks)
    state = [bytes(16)] * len(rows)
    for i in range(max(map(len, chains))):
        live = [j for j, c in enumerate(chains) if i < len(c)]
        for j, out in zip(live, cipher([(xor(state[j], chains[j][i]), rows[j][1]) for j in live])):
            state[j] = out
    return state


def test_cmac_equals_the_chain(spark):
    rows = [(RNG.randbytes(n), RNG.randbytes(size)) for n in (0, 1, 15, 16, 17, 31, 32, 33, 100) for size in (16, 24, 32)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d binary, k binary").orderBy("i")
    got = [bytes(r[0]) for r in df.select(kd.cmac_column(F.col("d"), F.col("k"))).collect()]
    assert got == chained_cmac(spark, rows)


def test_cmac_nulls_and_forgeries(spark):
    df = spark.createDataFrame([(None, b"k" * 16), (b"d", None)], "d binary, k binary")
    assert [r[0] for r in df.select(kd.cmac_column(F.col("d"), F.col("k"))).collect()] == [None, None]
    d, k = F.col("d"), F.col("k")
    mac = kd.cmac_column(d, k)
    checks = F.array(kd.cmac_verify(d, k, mac), kd.cmac_verify(F.concat(d, F.lit(b"\0")), k, mac), kd.cmac_verify(d, F.reverse(k.cast("string")).cast("binary"), mac))
    assert one(spark, checks, d=b"x" * 31, k=b"0123456789abcdef") == [True, False, False]


M64 = (1 << 64) - 1


def plain_siphash(data, key, c=2, d=4):
    rot = lambda x, n: ((x << n) | (x >> (64 - n))) & M64
    k0, k1 = (int.from_bytes(key[i : i + 8], "little") for i in (0, 8))
    v = [k ^ s for k, s in zip((k0, k1, k0, k1), kd.SIP_START)]

    def turn(times):
        for _ in range(times):
            v[0] = (v[0] + v[1]) & M64
            v[1] = rot(v[1], 13) ^ v[0]
            v[0] = rot(v[0], 32)
            v[2] = (v[2] + v[3]) & M64
            v[3] = rot(v[3], 16) ^ v[2]
            v[0] = (v[0] + v[3]) & M64
            v[3] = rot(v[3], 21) ^ v[0]
            v[2] = (v[2] + v[1]) & M64
            v[1] = rot(v[1], 17) ^ v[2]
            v[2] = rot(v[2], 32)

    data += bytes(7 - len(data) % 8) + bytes([len(data) & 255])
    for i in range(0, len(data), 8):
        m = int.from_bytes(data[i : i + 8], "little")
        v[3] ^= m
        turn(c)
        v[0] ^= m
    v[2] ^= 255
    turn(d)
    return v[0] ^ v[1] ^ v[2] ^ v[3]


def test_siphash_published_vectors(spark):
    """Appendix of the paper: the bytes 0 to 14 under the key 0 to 15."""
    got = one(spark, kd.siphash_column(F.col("d"), F.col("k")), d=bytes(range(15)), k=bytes(range(16)))
    assert got & M64 == 0xA129CA6149BE45E5
    assert plain_siphash(bytes(range(15)), bytes(range(16))) == 0xA129CA6149BE45E5


@pytest.mark.parametrize("c,d", [(2, 4), (1, 3)])
def test_siphash_equals_plain(spark, c, d):
    rows = [(RNG.randbytes(n), RNG.randbytes(16)) for n in [*range(26), 255, 256, 257, 20_000]]
    df = spark.createDataFrame(rows + [(None, b"k" * 16), (b"d", None)], "d binary, k binary")
    for data, key, got in df.select("d", "k", kd.siphash_column(F.col("d"), F.col("k"), c, d)).collect():
        if data is None or key is None:
            assert got is None
        else:
            assert got & M64 == plain_siphash(bytes(data), bytes(key), c, d)


def test_siphash_binds_without_arrays_or_patterns(spark):
    """What a word's rounds reuse is bound without an array around it, and words
    are read without patterns over the text."""
    df = spark.createDataFrame([(b"d", b"k" * 16)], "d binary, k binary")
    plan = df.select(kd.siphash_column(F.col("d"), F.col("k")))._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan
    assert "transform(" not in plan and "regexp" not in plan


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_siphash_every_byte_and_sign(spark, ansi):
    rows = [(bytes(range(256)), bytes(range(240, 256))), (b"\xff" * 64, b"\0" * 16), (b"\x80" * 33, b"\xff" * 16), ("aé漢😀\0".encode() * 9, b"\x7f" * 16)]
    numbers = [0, 1, -1, (1 << 63) - 1, -(1 << 63), 1 << 62, -(1 << 62) - 1]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame(rows, "d binary, k binary")
        hashes = df.select("d", "k", kd.siphash_column(F.col("d"), F.col("k"))).collect()
        pairs = spark.createDataFrame([(a, b) for a in numbers for b in numbers], "a bigint, b bigint")
        sums = pairs.select("a", "b", kd.add64(F.col("a"), F.col("b"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert all(got & M64 == plain_siphash(bytes(d), bytes(k)) for d, k, got in hashes)
    assert all(got & M64 == (a + b) & M64 for a, b, got in sums)


def test_siphash_key_length(spark):
    with pytest.raises(Exception, match="16 bytes"):
        one(spark, kd.siphash_column(F.col("d"), F.col("k")), d=b"d", k=b"short")


def test_nothing_runs_in_python(spark):
    df = spark.createDataFrame([(b"d", b"k" * 16)], "d binary, k binary")
    d, k = F.col("d"), F.col("k")
    plan = df.select(kd.hkdf_column(d, k, d, 50), kd.cmac_column(d, k), kd.siphash_column(d, k))._jdf.queryExecution().toString()
    assert "Python" not in plan.replace("PythonRDD", "").replace("applySchemaToPythonRDD", "")
