"""One-time codes: counter and time based, and their check against replay.

A code is the truncated MAC of a counter; for time based codes the counter is
the number of the time step.  The client library's checks compare one code with
one counter; here a table of attempts is judged: a code is good for its own time
step or one at most ``drift`` steps away, and each step of a user only once, at
its first attempt (RFC 6238, 5.2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import floor_div
from daybook.functions.keyed import hmac_of_pads, hmac_pads, word_hex
from daybook.functions.protect import bind

# Seconds of a step, digits a code may have, usable digests.
STEP_SECONDS = 30
DIGITS = (6, 7, 8)
ALGOS = ("sha1", "sha256", "sha512")


def _code_of_pads(pads: Column, counter: Column, digits: int, algo: str) -> Column:
    if digits not in DIGITS:
        raise ValueError(f"a code has {DIGITS} digits")
    if algo not in ALGOS:
        raise ValueError(f"unsupported digest {algo!r}")

    def cut(mac: Column) -> Column:
        # The last four bits say where the 31 bits begin.
        at = F.conv(F.substring(mac, -1, 1), 16, 10).cast("int")
        bits = F.conv(F.substr(mac, 2 * at + 1, F.lit(8)), 16, 10).cast("bigint")
        return F.lpad((bits.bitwiseAND(F.lit(0x7FFFFFFF)) % (10**digits)).cast("string"), digits, "0")

    return bind(F.hex(hmac_of_pads(F.unhex(word_hex(counter)), pads, algo)), cut)


def hotp(secret: Column, counter: Column, digits: int = 6, algo: str = "sha1") -> Column:
    """Code (text) of a binary secret and a whole counter."""
    return bind(hmac_pads(secret, algo), lambda p: _code_of_pads(p, counter.cast("bigint"), digits, algo))


def totp(secret: Column, seconds: Column, digits: int = 6, algo: str = "sha1", step_seconds: int = STEP_SECONDS) -> Column:
    return hotp(secret, floor_div(seconds, step_seconds), digits, algo)


def totp_verify(
    attempts: DataFrame, *, user: str = "user", seconds: str = "seconds", attempt: str = "attempt", secret: str = "secret", code: str = "code",
    drift: int = 1, digits: int = 6, algo: str = "sha1", step_seconds: int = STEP_SECONDS,
) -> DataFrame:
    """``attempts`` without their secrets, with ``step`` (the one whose code was
    given; the nearest, then the earlier) and ``status``: ``accepted``,
    ``replayed`` (a good code whose step was used before) or ``refused``.

    The first use of a step is a partial aggregate, and it is joined back on the
    attempt itself too, so a flood of attempts at one step meets in no task.

    Defined results: a NULL code, secret or time is refused; a NULL user is one
    user; of attempts at one second the least ``attempt`` is first; rows equal
    in user, time and attempt are one attempt and share their result; columns
    named as the results are replaced; an empty table gives an empty result."""
    drifts = sorted(range(-drift, drift + 1), key=lambda d: (abs(d), d))
    own = floor_div(F.col(seconds), step_seconds)

    def codes(pads: Column) -> Column:
        return F.array(*[_code_of_pads(pads, own + d, digits, algo) for d in drifts])

    place = F.array_position(bind(hmac_pads(F.col(secret), algo), codes), F.col(code))
    step = own + F.get(F.array(*[F.lit(d) for d in drifts]), (F.nullif(place, F.lit(0)) - 1).cast("int"))
    kept = [c for c in attempts.columns if c not in (secret, "step", "status")]
    judged = attempts.select(*[F.col(f"`{c}`") for c in kept], step.cast("bigint").alias("step"))
    firsts = judged.groupBy(user, "step").agg(F.min(F.struct(F.col(seconds).alias("s"), F.col(attempt).alias("a"))).alias("first"))
    firsts = firsts.select(F.col(user).alias("__u"), F.col("step").alias("__n"), F.col("first.s").alias("__s"), F.col("first.a").alias("__a"))
    same = (
        F.col(user).eqNullSafe(F.col("__u")) & F.col("step").eqNullSafe(F.col("__n")) & F.col(seconds).eqNullSafe(F.col("__s")) & F.col(attempt).eqNullSafe(F.col("__a"))
    )
    # (Null-safe throughout: a filter on the step would work out the codes again.)
    status = F.when(F.col("step").isNull(), "refused").when(F.col("__n").isNull(), "replayed").otherwise("accepted")
    return judged.join(firsts, same, "left").select(*[F.col(f"`{c}`") for c in kept], "step", status.alias("status"))
