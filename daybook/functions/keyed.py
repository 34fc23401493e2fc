"""Keyed functions whose key may be a column: HMAC, derived keys, block-cipher
MACs and SipHash.

Everything is a native Spark expression on binary columns.  Words of 64 bits are
``bigint``; sums modulo 2^64 never overflow one (ANSI mode would raise).  A value that an expression uses more than once is bound to a lambda
variable (``protect.bind``; ``let`` inside a loop): Catalyst would copy it into each use.

Defined results: NULL data or a NULL key gives NULL, an empty text is no bytes,
a key of a wrong length is an error where the length is fixed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.protect import bind, digest_hex

# Bytes of a digest and of its block.
DIGEST_BYTES = {"sha1": 20, "sha224": 28, "sha256": 32, "sha384": 48, "sha512": 64}
BLOCK_BYTES = {"sha1": 64, "sha224": 64, "sha256": 64, "sha384": 128, "sha512": 128}
INNER, OUTER = 0x3636363636363636, 0x5C5C5C5C5C5C5C5C
MOST_BLOCKS = 255  # of a key expanded by HMAC
AES_BLOCK = 16


def _known(algo: str) -> int:
    if algo not in DIGEST_BYTES:
        raise ValueError(f"unsupported digest {algo!r}")
    return DIGEST_BYTES[algo]


def digest(data: Column, algo: str) -> Column:
    return F.unhex(digest_hex(data, algo))


# ---- words ------------------------------------------------------------------
def word(hex_digits: Column) -> Column:
    """16 hex digits as a signed 64-bit word."""
    return F.conv(hex_digits, 16, -10).cast("bigint")


def words(data: Column, n: int) -> list[Column]:
    """The first ``n`` big-endian words of binary data."""
    return [word(F.hex(F.substring(data, 8 * i + 1, 8))) for i in range(n)]


def word_hex(w: Column) -> Column:
    return F.lpad(F.hex(w), 16, "0")


def joined(ws: list[Column]) -> Column:
    return F.unhex(F.concat(*[word_hex(w) for w in ws]))


def _signed(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("bigint")


def add64(a: Column, b: Column) -> Column:
    """Sum modulo 2^64.  Numbers of different signs cannot overflow; of others one
    changes its sign bit, and so does the sum."""
    top = _signed(1 << 63)
    return F.call_function("if", a.bitwiseXOR(b) < 0, a + b, (a.bitwiseXOR(top) + b).bitwiseXOR(top))


def rotl64(a: Column, by: int) -> Column:
    return F.shiftleft(a, by).bitwiseOR(F.shiftrightunsigned(a, 64 - by))


# ---- HMAC with a key column ---------------------------------------------------
def hmac_pads(key: Column, algo: str = "sha256") -> Column:
    """(inner, outer): the key's block, padded with zeros (a longer key is its
    digest) and combined with either pattern."""
    _known(algo)
    size = BLOCK_BYTES[algo]
    short = F.when(F.octet_length(key) > size, digest(key, algo)).otherwise(key)

    def pads(block: Column) -> Column:
        ws = words(block, size // 8)
        mixed = lambda p: joined([w.bitwiseXOR(F.lit(p).cast("bigint")) for w in ws])
        return F.when(block.isNotNull(), F.struct(mixed(INNER).alias("inner"), mixed(OUTER).alias("outer")))

    return bind(F.rpad(short, F.lit(size), F.lit(b"\0")), pads)


def hmac_of_pads(data: Column, pads: Column, algo: str = "sha256") -> Column:
    return digest(F.concat(pads["outer"], digest(F.concat(pads["inner"], data), algo)), algo)


def hmac_by_key(data: Column, key: Column, algo: str = "sha256") -> Column:
    """HMAC (binary) of binary data under the row's own binary key."""
    return bind(hmac_pads(key, algo), lambda p: hmac_of_pads(data, p, algo))


# ---- derived keys -----------------------------------------------------------------
def _length(length: int, algo: str, most: int) -> int:
    size = _known(algo)
    if not 0 < length <= most * size:
        raise ValueError(f"a key of {algo} has 1 to {most * size} bytes")
    return -(-length // size)


def _byte(i: Column, n: int = 1) -> Column:
    return F.unhex(F.lpad(F.hex(i.cast("bigint")), 2 * n, "0"))


def hkdf_extract(material: Column, salt: Column | None = None, algo: str = "sha256") -> Column:
    """Pseudorandom key of the material; without a salt, zeros stand for it."""
    _known(algo)
    return hmac_by_key(material, F.lit(bytes(DIGEST_BYTES[algo])) if salt is None else salt, algo)


def hkdf_expand(key: Column, info: Column, length: int, algo: str = "sha256") -> Column:
    """``length`` bytes: each block is the MAC of the block before, the info and
    the block's number; a fold carries (last block, all so far)."""
    n = _length(length, algo, MOST_BLOCKS)
    nothing = F.lit(b"")

    def chain(pads: Column) -> Column:
        def step(done: Column, i: Column) -> Column:
            block = hmac_of_pads(F.concat(done["last"], info, _byte(i)), pads, algo)
            return bind(block, lambda b: F.struct(b.alias("last"), F.concat(done["all"], b).alias("all")))

        start = F.struct(nothing.alias("last"), nothing.alias("all"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, step, lambda done: F.substring(done["all"], 1, length))

    return bind(hmac_pads(key, algo), chain)


def hkdf_column(material: Column, salt: Column | None, info: Column, length: int, algo: str = "sha256") -> Column:
    """Key of ``length`` bytes derived from the row's material, salt and info."""
    return hkdf_expand(hkdf_extract(material, salt, algo), info, length, algo)


def concat_kdf(secret: Column, info: Column, length: int, algo: str = "sha256") -> Column:
    """Single-step key: digests of a 32-bit counter, the secret and the info."""
    n = _length(length, algo, (1 << 32) - 1)
    joined_blocks = F.aggregate(
        F.sequence(F.lit(1), F.lit(n)), F.lit(b""), lambda done, i: F.concat(done, digest(F.concat(_byte(i, 4), secret, info), algo))
    )
    return F.substring(joined_blocks, 1, length)


# ---- MAC of a block cipher -----------------------------------------------------------
def _doubled(high: Column, low: Column) -> list[Column]:
    """Twice an element of GF(2^128)."""
    top = F.shiftrightunsigned(high, 63)
    return [F.shiftleft(high, 1).bitwiseOR(F.shiftrightunsigned(low, 63)), F.shiftleft(low, 1).bitwiseXOR(top * F.lit(0x87).cast("bigint"))]


def cmac_subkeys(key: Column) -> Column:
    """(whole, cut): what the last block is combined with, where it is whole and
    where it was padded."""
    twice = lambda b: joined(_doubled(*words(b, 2)))
    zero = F.substring(F.aes_encrypt(F.lit(bytes(AES_BLOCK)), key, F.lit("ECB"), F.lit("PKCS")), 1, AES_BLOCK)
    return bind(bind(zero, twice), lambda k1: F.when(k1.isNotNull(), F.struct(k1.alias("whole"), twice(k1).alias("cut"))))


def cmac_column(data: Column, key: Column) -> Column:
    """AES-CMAC (binary, 16 bytes) of binary data; the key has 16, 24 or 32 bytes.

    The chain over the blocks is one call of the cipher in CBC mode from a zero
    vector: the tag is the last block before the padding's own."""
    n = F.octet_length(data)
    head = F.when(n == 0, 0).otherwise(F.floor((n - 1) / AES_BLOCK).cast("int") * AES_BLOCK)

    def tag(subkeys: Column) -> Column:
        rest = F.substring(data, head + 1, F.lit(AES_BLOCK))
        whole = (n - head) == AES_BLOCK
        block = F.when(whole, rest).otherwise(F.rpad(F.concat(rest, F.lit(b"\x80")), F.lit(AES_BLOCK), F.lit(b"\0")))
        mask = F.when(whole, subkeys["whole"]).otherwise(subkeys["cut"])
        last = bind(F.struct(block.alias("b"), mask.alias("m")), lambda s: joined([a.bitwiseXOR(b) for a, b in zip(words(s["b"], 2), words(s["m"], 2))]))
        chained = F.aes_encrypt(F.concat(F.substring(data, F.lit(1), head), last), key, F.lit("CBC"), F.lit("PKCS"), F.lit(bytes(AES_BLOCK)))
        # The result begins with the vector, so this block is the message's last.
        return F.substring(chained, AES_BLOCK + head + 1, F.lit(AES_BLOCK))

    return bind(cmac_subkeys(key), tag)


def cmac_verify(data: Column, key: Column, mac: Column) -> Column:
    return cmac_column(data, key) == mac


# ---- SipHash ---------------------------------------------------------------------------
# The start of the four words, and how far they turn in the two
# halves of a round.
SIP_START = (0x736F6D6570736575, 0x646F72616E646F6D, 0x6C7967656E657261, 0x7465646279746573)
SIP_HALVES = ((13, 16), (17, 21))


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(v)`` with ``value`` evaluated once, as ``protect.bind``, but without an
    array around it: the start of a fold over nothing is what its end is given."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, fn)


def _state(*ws: Column) -> Column:
    return F.struct(*[w.alias(n) for w, n in zip(ws, "abcd")])


def _half(a: Column, b: Column, c: Column, d: Column, turns: tuple[int, int], then: Callable[..., Column]) -> Column:
    """Half a round: a + b and c + d, the second of each pair turned and mixed.
    (The pairs change partners, so the next half begins with c and b.)  Lambdas are
    interpreted: a variable costs as much as some seven operations."""
    mixed = lambda w, by, total: rotl64(w, by).bitwiseXOR(total)
    return let(add64(a, b), lambda ab: let(add64(c, d), lambda cd: let(mixed(b, turns[0], ab), lambda b1: let(mixed(d, turns[1], cd), lambda d1: then(cd, b1, rotl64(ab, 32), d1)))))


def _rounds(ws: tuple[Column, ...], n: int, then: Callable[..., Column]) -> Column:
    turns = [h for _ in range(n) for h in SIP_HALVES]

    def go(state: tuple[Column, ...], i: int) -> Column:
        return then(*state) if i == len(turns) else _half(*state, turns[i], lambda *t: go(t, i + 1))

    return go(ws, 0)


def _backwards(data: Column) -> Column:
    """The bytes in reverse order."""
    return F.encode(F.reverse(F.decode(data, "ISO-8859-1")), "ISO-8859-1")


def siphash_column(data: Column, key: Column, compression: int = 2, finalization: int = 4) -> Column:
    """SipHash (signed 64-bit) of binary data under a binary key of 16 bytes,
    folded over the data's little-endian words."""
    n = F.octet_length(data)
    # Whole words, the last one filled with zeros and the length modulo 256.
    size = (F.floor(n / 8).cast("int") + 1) * 8
    filled = F.concat(F.rpad(data, size - 1, F.lit(b"\0")), _byte(F.pmod(n, F.lit(256))))
    # Backwards, a little-endian word is a big-endian one, and the first is the last.
    at = lambda back, i: word(F.hex(F.substring(back, i, F.lit(8))))

    def hashed(k: Column, back: Column) -> Column:
        k0, k1 = at(k, F.lit(9)), at(k, F.lit(1))
        start = _state(*(k_.bitwiseXOR(_signed(v)) for k_, v in zip((k0, k1, k0, k1), SIP_START)))

        def step(s: Column, i: Column) -> Column:
            def enter(m: Column) -> Column:
                mixed = lambda a, b, c, d: _state(a.bitwiseXOR(m), b, c, d)
                return let(s["b"], lambda b: let(s["d"].bitwiseXOR(m), lambda d: _rounds((s["a"], b, s["c"], d), compression, mixed)))

            return let(at(back, i), enter)

        def finish(s: Column) -> Column:
            ended = (s["a"], s["b"], s["c"].bitwiseXOR(F.lit(0xFF).cast("bigint")), s["d"])
            return _rounds(ended, finalization, lambda a, b, c, d: a.bitwiseXOR(b).bitwiseXOR(c).bitwiseXOR(d))

        return F.aggregate(F.sequence(F.octet_length(back) - 7, F.lit(1), F.lit(-8)), start, step, finish)

    checked = F.when(F.octet_length(key) == 16, key).when(key.isNull(), F.lit(None).cast("binary")).otherwise(F.raise_error(F.lit("a key has 16 bytes")).cast("binary"))
    return F.when(data.isNotNull() & key.isNotNull(), let(_backwards(checked), lambda k: let(_backwards(filled), lambda back: hashed(k, back))))
