"""Column protection: digests, keyed MACs, AES-GCM and signed tokens.

Everything is a native Spark expression (``md5``, ``sha1``, ``sha2``,
``aes_encrypt`` / ``try_aes_decrypt``, binary ``concat`` / ``substring``), so
whole columns are processed inside executors with no Python per row.  Keys
are parameters; only key preparation (padding, splitting) happens once on the
driver.

Tokens follow the published signed-token layout::

    0x80 | 8-byte big-endian seconds | 16-byte IV | AES-128-CBC(PKCS7) | HMAC-SHA256

URL-safe base64 encoded; the first 16 key bytes sign, the last 16 encrypt.
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Supported digests, the HMAC block size, and the signed-token
# layout (version byte, allowed clock skew in seconds, MAC length).
DIGESTS = ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")
HMAC_BLOCK = 64
TOKEN_VERSION = b"\x80"
MAX_CLOCK_SKEW = 60
MAC_LEN = 32


def _bytes(c: Column, binary: bool = False) -> Column:
    """Text as its UTF-8 bytes (``binary=True``: already bytes)."""
    return c if binary else F.to_binary(c, F.lit("utf-8"))


def digest_hex(value: Column, algo: str) -> Column:
    """Lower-case hex digest of the value's bytes (text as UTF-8)."""
    if algo == "md5":
        return F.md5(value)
    if algo == "sha1":
        return F.sha1(value)
    if algo.startswith("sha") and algo[3:] in ("224", "256", "384", "512"):
        return F.sha2(value, int(algo[3:]))
    raise ValueError(f"unsupported digest {algo!r}")


def digest_column(value: Column, algo: str = "sha256", encoding: str = "hex") -> Column:
    h = digest_hex(value, algo)
    if encoding == "hex":
        return h
    if encoding == "base64":
        return F.base64(F.unhex(h))
    raise ValueError(f"unsupported encoding {encoding!r}")


# ---- HMAC-SHA256 --------------------------------------------------------------
def _pads(key: bytes) -> tuple[bytes, bytes]:
    if len(key) > HMAC_BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(HMAC_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_sha256(data: Column, key: bytes) -> Column:
    """HMAC-SHA256 (binary, 32 bytes) of a binary column:
    ``H(k ^ opad || H(k ^ ipad || data))`` with native ``sha2``."""
    ipad, opad = _pads(key)
    inner = F.unhex(F.sha2(F.concat(F.lit(ipad), data), 256))
    return F.unhex(F.sha2(F.concat(F.lit(opad), inner), 256))


def hmac_column(value: Column, key: bytes) -> Column:
    """Keyed pseudonym: lower-case hex HMAC-SHA256 of the value's bytes."""
    return F.lower(F.hex(hmac_sha256(_bytes(value), key)))


def hmac_verify(value: Column, mac_hex: Column, key: bytes) -> Column:
    return hmac_column(value, key) == F.lower(mac_hex)


# ---- AES-GCM ----------------------------------------------------------------------
GCM_IV_LEN = 12


def aes_gcm_encrypt(value: Column, key: bytes, aad: bytes = b"", iv: Column | None = None) -> Column:
    """``iv | ciphertext | tag``.  Without ``iv`` every row gets a fresh
    random 12-byte IV (Spark's secure random)."""
    if iv is None:
        return F.aes_encrypt(value, F.lit(key), F.lit("GCM"), F.lit("DEFAULT"), F.lit(b""), F.lit(aad))
    return F.aes_encrypt(value, F.lit(key), F.lit("GCM"), F.lit("DEFAULT"), iv, F.lit(aad))


def aes_gcm_ciphertext(blob: Column) -> Column:
    """The ``ciphertext | tag`` part (what a nonce-separate AEAD API returns)."""
    return F.substring(blob, F.lit(GCM_IV_LEN + 1), F.greatest(F.length(blob) - GCM_IV_LEN, F.lit(0)))


def aes_gcm_decrypt(blob: Column, key: bytes, aad: bytes = b"") -> Column:
    """Plain bytes, or NULL when the key, tag or associated data do not match."""
    return F.try_aes_decrypt(blob, F.lit(key), F.lit("GCM"), F.lit("DEFAULT"), F.lit(aad))


# ---- signed tokens ------------------------------------------------------------------
def split_key(key_b64: str) -> tuple[bytes, bytes]:
    key = base64.urlsafe_b64decode(key_b64)
    if len(key) != 32:
        raise ValueError("token key must be 32 url-safe base64-encoded bytes")
    return key[:16], key[16:]


def _b64url(b: Column) -> Column:
    return F.translate(F.regexp_replace(F.base64(b), r"[\r\n]", ""), "+/", "-_")


def _unb64url(s: Column) -> Column:
    return F.try_to_binary(F.translate(s, "-_", "+/"), F.lit("base64"))


def _be64(seconds: Column) -> Column:
    """8-byte big-endian unsigned integer."""
    return F.unhex(F.lpad(F.hex(seconds.cast("bigint")), 16, "0"))


def seal(value: Column, key_b64: str, iv: Column | None = None, binary: bool = False) -> Column:
    """``iv | AES-128-CBC(PKCS7)`` of the value (text as UTF-8, or bytes with
    ``binary``).  Without ``iv`` each row gets a fresh random IV."""
    _, encryption = split_key(key_b64)
    args = [_bytes(value, binary), F.lit(encryption), F.lit("CBC"), F.lit("PKCS")]
    return F.aes_encrypt(*args) if iv is None else F.aes_encrypt(*args, iv)


def bind(value: Column, fn) -> Column:
    """``fn(v)`` with ``value`` evaluated once: the value is bound to a lambda
    variable.  Needed when ``value`` draws random bytes (aes_encrypt's IV) and
    ``fn`` uses it twice; Catalyst may otherwise copy the expression into each
    use (it treats aes_encrypt as deterministic)."""
    return F.get(F.transform(F.array(value), fn), 0)


def token_of_sealed(sealed: Column, key_b64: str, seconds: Column | None = None) -> Column:
    """Token from sealed bytes (``iv | ciphertext``): version, time, sealed
    bytes and the MAC over them, URL-safe base64."""
    signing, _ = split_key(key_b64)
    seconds = seconds if seconds is not None else F.unix_seconds(F.current_timestamp())
    body = F.concat(F.lit(TOKEN_VERSION), _be64(seconds), sealed)
    return bind(body, lambda b: _b64url(F.concat(b, hmac_sha256(b, signing))))


def token_encrypt(
    value: Column, key_b64: str, seconds: Column | None = None, iv: Column | None = None, binary: bool = False
) -> Column:
    """Token of the value (text as UTF-8, or bytes with ``binary``), stamped
    with ``seconds`` (default: the query's current time).  Without ``iv`` each
    row gets a fresh random IV, drawn once per row."""
    return token_of_sealed(seal(value, key_b64, iv, binary), key_b64, seconds)


def with_token(
    df: DataFrame,
    value: Column,
    key_b64: str,
    out: str = "token",
    seconds: Column | None = None,
    iv: Column | None = None,
    binary: bool = False,
) -> DataFrame:
    return df.withColumn(out, token_encrypt(value, key_b64, seconds, iv, binary))


def token_bytes(token: Column) -> Column:
    """Decoded token bytes (NULL when the text is not base64)."""
    return _unb64url(token)


def _parts(token: Column, raw: Column | None = None):
    raw = raw if raw is not None else _unb64url(token)
    n = F.length(raw)
    well_formed = raw.isNotNull() & (n >= 1 + 8 + 16 + 16 + MAC_LEN) & (F.substring(raw, 1, 1) == F.lit(TOKEN_VERSION))
    seconds = F.conv(F.hex(F.substring(raw, 2, 8)), 16, 10).try_cast("decimal(20,0)")
    body = F.substring(raw, 1, n - MAC_LEN)
    mac = F.substring(raw, n - MAC_LEN + 1, MAC_LEN)
    sealed = F.substring(raw, 10, n - 9 - MAC_LEN)
    return well_formed, seconds, body, mac, sealed


def token_decrypt(
    token: Column, key_b64: str, ttl: int | None = None, now: Column | None = None, raw: Column | None = None
) -> Column:
    """struct(value binary, seconds, reason): ``value`` is NULL and ``reason``
    names the first failed check: ``malformed``, ``expired``, ``future``
    (beyond the 60 s clock skew), ``bad_signature``, ``bad_padding``.  Time
    checks apply only with ``ttl``; ``now`` defaults to the query time.

    The decoded bytes and the MAC / decryption results are bound once per
    row: inside the chain of checks Spark could not share them and would
    decode and hash the token once per check."""
    signing, encryption = split_key(key_b64)
    now = now if now is not None else F.unix_seconds(F.current_timestamp())

    def open_bytes(r: Column) -> Column:
        well_formed, seconds, body, mac, sealed = _parts(None, r)
        facts = F.struct(
            F.coalesce(well_formed, F.lit(False)).alias("ok"),
            seconds.alias("seconds"),
            (hmac_sha256(body, signing) == mac).alias("signed"),
            F.try_aes_decrypt(sealed, F.lit(encryption), F.lit("CBC"), F.lit("PKCS")).alias("plain"),
        )

        def verdict(f: Column) -> Column:
            reason = F.when(~f["ok"], F.lit("malformed"))
            if ttl is not None:
                reason = reason.when(f["seconds"] + ttl < now, F.lit("expired")).when(
                    now + MAX_CLOCK_SKEW < f["seconds"], F.lit("future")
                )
            reason = reason.when(~f["signed"], F.lit("bad_signature")).when(f["plain"].isNull(), F.lit("bad_padding"))
            return F.struct(
                F.when(reason.isNull(), f["plain"]).alias("value"),
                F.when(f["ok"], f["seconds"].cast("bigint")).alias("seconds"),
                reason.alias("reason"),
            )

        return bind(facts, verdict)

    return bind(raw if raw is not None else token_bytes(token), open_bytes)


def token_timestamp(token: Column, key_b64: str) -> Column:
    """Creation time (epoch seconds) of a token whose signature verifies."""
    signing, _ = split_key(key_b64)
    well_formed, seconds, body, mac, _ = _parts(token)
    return F.when(well_formed & (hmac_sha256(body, signing) == mac), seconds.cast("bigint"))


RAW = "__raw"


def token_rotate(token: Column, keys_b64: list[str], iv: Column | None = None) -> Column:
    """Re-issue a token under the first key: the first key (in order) that
    verifies and decrypts it wins; its creation time is kept.  NULL when no
    key opens the token."""

    def reissue(raw: Column) -> Column:
        def pick(opened: Column) -> Column:
            tries = [opened[i] for i in range(len(keys_b64))]
            plain = F.coalesce(*[o["value"] for o in tries])
            seconds = F.coalesce(*[F.when(o["value"].isNotNull(), o["seconds"]) for o in tries])
            return F.when(plain.isNotNull(), token_encrypt(plain, keys_b64[0], seconds, iv, binary=True))

        # every key's attempt is evaluated once, then read from the bound array
        return bind(F.array(*[token_decrypt(token, k, raw=raw) for k in keys_b64]), pick)

    return bind(token_bytes(token), reissue)


def with_rotated_token(df: DataFrame, token: Column, keys_b64: list[str], out: str = "token", iv: Column | None = None) -> DataFrame:
    return df.withColumn(out, token_rotate(token, keys_b64, iv))
