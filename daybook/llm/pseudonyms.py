"""Format-preserving Feistel pseudonyms, as native expressions.

Candidates are found by one pattern and validated: payment cards by the Luhn
digit, IBANs by their remainder, IPv4 octets, calendar dates 1900-2099, US
social security numbers, phone numbers, e-mail addresses, access keys and
assigned secrets.  A valid value is permuted by a keyed Feistel network within
its own format, and what validated it (check digits, octet range, calendar) is
kept valid: the pseudonym of a card is a card.  The network works on the value
without separators, so a value keeps one pseudonym in all documents and
spellings, and different values of a format keep different ones.

Two networks are used, both with HMAC-SHA-256 round functions:

* strings: halves are alternately shifted, character by character inside its
  alphabet (digits, letters, hex), by a key stream of the other half;
* numbers in a x b (dates 17 x 4297 days, addresses 65536 x 65536, social
  security numbers 88902 x 9999): both parts are alternately added to.

A permutation has fixed points: one value in 73,049 dates, in 2^32 addresses
and so on may be its own pseudonym.

Defined results: a null text stays null with nothing found; an empty text stays
empty; values that fail their check stay as they are; an IBAN of a
country without a known length takes a following word of up to four capitals or
digits with it and so may fail; repeated rows give
repeated results; dates with separators are read day first, month first only if
day first is no date; other columns are kept, columns named as the results are
replaced.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.protect import hmac_sha256
from .common import table

ROUNDS = 8
KEY = b"replace this key in production"

EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
ACCESS = r"(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
SECRET = r"(?i:passwd|password|pwd|secret|token|api_?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_-]{8,}"
#: Length of an IBAN: countries.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    rest = f" ?[A-Z0-9]{{{length % 4}}}" if length % 4 else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{length // 4 - 1}}}{rest}(?![A-Za-z0-9])"


# The country says where an IBAN ends; else it runs on as far as it can.
_IBANS = [_iban_of(n, countries) for n, countries in _IBAN_LENGTHS.items()]
IBAN = "(?:" + "|".join([*_IBANS, r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"]) + ")"
ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
DATE = r"[0-9]{2}(?:/[0-9]{2}/|\.[0-9]{2}\.)[0-9]{4}(?![0-9])"
IPV4 = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
# A number does not run on into an address, a date or a long number after it.
_APART = rf"(?![ .-](?:{IPV4}|{ISO_DATE}|{DATE}|[0-9]{{8}}))"
US_PHONE = r"\+1[ .-]?\(?[2-9][0-9]{2}\)?[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{4}(?![0-9])"
PHONE = rf"\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)[ .-]?)?[0-9](?:{_APART}[ .-]?[0-9]){{5,12}}(?![0-9])"
LOCAL_PHONE = r"(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}(?![0-9])"
CARD = r"(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"

#: In the order in which they are tried at a place of the text.
_KINDS = [
    ("secret", SECRET), ("email", EMAIL), ("access_key", ACCESS), ("iban", IBAN), ("date", ISO_DATE), ("date", DATE),
    ("ipv4", IPV4), ("ssn", SSN), ("phone", US_PHONE), ("phone", PHONE), ("phone", LOCAL_PHONE), ("card", CARD),
]
PATTERN = r"(?<![A-Za-z0-9_+])(?<![0-9][.-])(?:" + "|".join(p for _, p in _KINDS) + ")"
#: Texts without these hold no candidate.
HINT = r"[0-9][ ./()-]?[0-9]|@|(?i:passwd|password|pwd|secret|token|api_?key)|A[KS]IA"

_ALPHABETS = {"9": string.digits, "2": "23456789", "a": string.ascii_lowercase, "A": string.ascii_uppercase, "h": "0123456789abcdef"}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _mac(key: bytes, *parts: Column) -> Column:
    return F.lower(F.hex(hmac_sha256(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"), key)))


def _number(hex15: Column) -> Column:
    return F.conv(hex15, 16, 10).cast("bigint")


def feistel_pair(kind: str, a: Column, size_a: int, b: Column, size_b: int, key: bytes) -> Column:
    """The pair (a, b), 0-based below the sizes, permuted; a struct a, b."""

    def step(acc: Column, i: Column) -> Column:
        left = i % 2 == 0
        f = _number(F.substring(_mac(key, F.lit(kind), i, F.when(left, acc["b"]).otherwise(acc["a"])), 1, 15))
        return _let(f, lambda x: F.struct(
            F.when(left, F.pmod(acc["a"] + F.pmod(x, F.lit(size_a)), F.lit(size_a))).otherwise(acc["a"]).cast("bigint").alias("a"),
            F.when(left, acc["b"]).otherwise(F.pmod(acc["b"] + F.pmod(x, F.lit(size_b)), F.lit(size_b))).cast("bigint").alias("b"),
        ))

    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _shifted(text: Column, mask: Column, stream: Column) -> Column:
    """Every character moved inside its alphabet by four hex digits of the
    stream; characters whose mask names no alphabet stay."""

    def one(j: Column) -> Column:
        by = F.conv(F.substr(stream, j * 4 - 3, F.lit(4)), 16, 10).cast("int")

        def moved(c: Column) -> Column:
            out = c
            for name, letters in _ALPHABETS.items():
                at = F.pmod(F.instr(F.lit(letters), c) - 1 + by, F.lit(len(letters))) + 1
                out = F.when(F.substr(mask, j, F.lit(1)) == name, F.substr(F.lit(letters), at, F.lit(1))).otherwise(out)
            return out

        return _let(F.substr(text, j, F.lit(1)), moved)

    return F.when(F.length(text) == 0, text).otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), ""))


def feistel_text(kind: str, text: Column, mask: Column, key: bytes) -> Column:
    """A string permuted character by character within its mask's alphabets."""

    def network(text: Column, mask: Column) -> Column:
        half = F.floor(F.length(text) / 2).cast("int")
        mask_l, mask_r = F.substr(mask, F.lit(1), half), F.substr(mask, half + 1)

        def step(acc: Column, i: Column) -> Column:
            left = i % 2 == 0
            other = F.when(left, acc["r"]).otherwise(acc["l"])
            n = F.length(F.when(left, acc["l"]).otherwise(acc["r"]))
            digests = F.transform(F.sequence(F.lit(0), F.floor(n / 16).cast("int")), lambda d: _mac(key, F.lit(kind), i, d, other))
            return _let(F.array_join(digests, ""), lambda s: F.struct(
                F.when(left, _shifted(acc["l"], mask_l, s)).otherwise(acc["l"]).alias("l"),
                F.when(left, acc["r"]).otherwise(_shifted(acc["r"], mask_r, s)).alias("r"),
            ))

        start = F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda acc: F.concat(acc["l"], acc["r"]))

    return _let(F.struct(text.alias("t"), mask.alias("m")), lambda x: network(x["t"], x["m"]))


def _classes(text: Column) -> Column:
    return F.translate(text, string.digits + string.ascii_lowercase + string.ascii_uppercase, "9" * 10 + "a" * 26 + "A" * 26)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(shape: Column, symbols: Column, kind: str = "[^0-9]") -> Column:
    """``shape`` with its n-th symbol (what ``kind`` does not match) replaced by
    the n-th of ``symbols``."""

    def one(j: Column) -> Column:
        upto = F.length(F.regexp_replace(F.substr(shape, F.lit(1), j), kind, ""))
        c = F.substr(shape, j, F.lit(1))
        return F.when(c.rlike(kind), c).otherwise(F.substr(symbols, upto, F.lit(1)))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), one), "")


def _sum_over(text: Column, value: Callable[[Column, Column], Column]) -> Column:
    """Sum of value(character, 1-based place from the right)."""
    n = F.length(text)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, j: acc + value(F.substr(text, j, F.lit(1)), n - j + 1).cast("int"))


def _luhn_sum(digits: Column) -> Column:
    def value(c: Column, place: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(place % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(c.cast("int"))

    return _sum_over(digits, value)


def is_card(digits: Column) -> Column:
    return F.length(digits).between(13, 19) & (_luhn_sum(digits) % 10 == 0) & ~digits.rlike("^0+$")


def card(match: Column, key: bytes) -> Column:
    """First digit and length stay; the last digit is recomputed."""

    def new(digits: Column) -> Column:
        body = F.substr(digits, F.lit(2), F.length(digits) - 2)
        moved = F.concat(F.substr(digits, F.lit(1), F.lit(1)), feistel_text("card", body, F.repeat(F.lit("9"), F.length(body)), key))
        return _let(moved, lambda m: F.concat(m, ((10 - _luhn_sum(F.concat(m, F.lit("0"))) % 10) % 10).cast("int").cast("string")))

    return _let(_digits(match), lambda d: F.when(is_card(d), _refill(match, new(d))))


def _mod97(text: Column) -> Column:
    """Remainder of the number that digits and letters (A = 10) spell."""

    def step(acc: Column, j: Column) -> Column:
        c = F.substr(text, j, F.lit(1))
        v = F.instr(F.lit(string.digits + string.ascii_uppercase), c) - 1
        return ((acc * F.when(v > 9, 100).otherwise(10) + v) % 97).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), step)


def iban(match: Column, key: bytes) -> Column:
    """Country stays; the account is permuted, the check digits recomputed."""

    def new(plain: Column) -> Column:
        country, account = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5))
        valid = F.length(plain).between(15, 34) & (_mod97(F.concat(account, F.substr(plain, F.lit(1), F.lit(4)))) == 1)
        moved = feistel_text("iban", account, _classes(account), key)
        made = _let(moved, lambda m: F.concat(country, F.lpad((98 - _mod97(F.concat(m, country, F.lit("00")))).cast("string"), 2, "0"), m))
        return F.when(valid, _refill(match, made, "[^0-9A-Z]"))

    return _let(F.replace(match, F.lit(" "), F.lit("")), new)


def ipv4(match: Column, key: bytes) -> Column:
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    part = F.split(match, "\\.")
    at = [F.element_at(part, i).cast("int") for i in (1, 2, 3, 4)]
    moved = feistel_pair("ipv4", at[0] * 256 + at[1], 65536, at[2] * 256 + at[3], 65536, key)
    text = _let(moved, lambda m: F.concat_ws(".", *[x.cast("int").cast("string") for x in (F.floor(m["a"] / 256), m["a"] % 256, F.floor(m["b"] / 256), m["b"] % 256)]))
    return F.when(match.rlike(f"^{octet}(\\.{octet}){{3}}$"), text)


FIRST_DAY, DAYS = "1900-01-01", (17, 4297)  # 73,049 days up to 2099-12-31


def date(match: Column, key: bytes) -> Column:
    """Any day from 1900 to 2099, in the spelling of the match."""
    sep = F.substr(match, F.lit(3), F.lit(1))
    dotted = F.concat_ws("-", F.substr(match, F.lit(7), F.lit(4)), F.substr(match, F.lit(4), F.lit(2)), F.substr(match, F.lit(1), F.lit(2)))
    month_first = F.concat_ws("-", F.substr(match, F.lit(7), F.lit(4)), F.substr(match, F.lit(1), F.lit(2)), F.substr(match, F.lit(4), F.lit(2)))
    iso = sep.rlike("[0-9]")
    day = lambda text: F.try_to_date(text, "yyyy-MM-dd")
    found = F.struct(
        F.when(iso, day(match)).otherwise(F.coalesce(day(dotted), day(month_first))).alias("d"),
        F.when(iso, F.lit("yyyy-MM-dd")).when(day(dotted).isNotNull(), F.concat(F.lit("dd"), sep, F.lit("MM"), sep, F.lit("yyyy"))).otherwise(F.concat(F.lit("MM"), sep, F.lit("dd"), sep, F.lit("yyyy"))).alias("f"),
    )

    def new(x: Column) -> Column:
        n = F.datediff(x["d"], F.lit(FIRST_DAY).cast("date"))
        moved = feistel_pair("date", F.floor(n / DAYS[1]), DAYS[0], n % DAYS[1], DAYS[1], key)
        fresh = _let(moved, lambda m: F.date_add(F.lit(FIRST_DAY).cast("date"), (m["a"] * DAYS[1] + m["b"]).cast("int")))
        parts = _let(fresh, lambda d: F.struct(F.lpad(F.year(d).cast("string"), 4, "0").alias("y"), F.lpad(F.month(d).cast("string"), 2, "0").alias("m"), F.lpad(F.day(d).cast("string"), 2, "0").alias("d")))
        text = _let(parts, lambda p: F.when(iso, F.concat_ws("-", p["y"], p["m"], p["d"])).when(x["f"].startswith("dd"), F.concat(p["d"], sep, p["m"], sep, p["y"])).otherwise(F.concat(p["m"], sep, p["d"], sep, p["y"])))
        return F.when(n.between(0, DAYS[0] * DAYS[1] - 1), text)

    return _let(found, new)


def ssn(match: Column, key: bytes) -> Column:
    """Area 001-899 without 666, group 01-99, serial 0001-9999."""
    area, group, serial = (F.substr(match, F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    rank = area - F.when(area > 666, 2).otherwise(1)
    moved = feistel_pair("ssn", rank * 99 + group - 1, 898 * 99, serial - 1, 9999, key)

    def text(m: Column) -> Column:
        r = F.floor(m["a"] / 99)
        fresh = r + F.when(r >= 665, 2).otherwise(1)
        return F.concat_ws("-", *[F.lpad(x.cast("int").cast("string"), n, "0") for x, n in ((fresh, 3), (m["a"] % 99 + 1, 2), (m["b"] + 1, 4))])

    return F.when(valid, _let(moved, text))


def phone(match: Column, key: bytes) -> Column:
    """The country code stays (one to three digits before a separator, else
    two); +1 and local numbers of ten digits keep valid leading digits."""

    def new(digits: Column) -> Column:
        plus = match.startswith("+")
        spelt = F.regexp_extract(match, r"^\+([0-9]{1,3})[ .(-]", 1)
        code = F.when(~plus, F.lit("")).when(spelt != "", spelt).otherwise(F.substr(digits, F.lit(1), F.lit(2)))
        return _let(F.struct(code.alias("c"), F.substr(digits, F.length(code) + 1).alias("n")), lambda x: _refill(match, F.concat(
            x["c"],
            feistel_text("phone", x["n"], F.when((~plus | (x["c"] == "1")) & x["n"].rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$"), F.lit("2992999999")).otherwise(F.repeat(F.lit("9"), F.length(x["n"]))), key),
        )))

    return _let(_digits(match), lambda d: F.when(F.length(d).between(7, 15), new(d)))


def email(match: Column, key: bytes) -> Column:
    """The local part, every character within its kind; the domain stays."""
    local = F.substring_index(match, "@", 1)
    return F.concat(feistel_text("email", local, _classes(local), key), F.lit("@"), F.substring_index(match, "@", -1))


def access_key(match: Column, key: bytes) -> Column:
    rest = F.substr(match, F.lit(5))
    return F.concat(F.substr(match, F.lit(1), F.lit(4)), feistel_text("access", rest, _classes(rest), key))


def secret(match: Column, key: bytes) -> Column:
    """What is assigned; lower-case hex stays hex."""
    head = F.regexp_extract(match, r"^[A-Za-z_]+\s*[=:]\s*[\"']?", 0)
    value = F.substr(match, F.length(head) + 1)
    mask = F.when(value.rlike("^[0-9a-f]+$"), F.repeat(F.lit("h"), F.length(value))).otherwise(_classes(value))
    return F.concat(head, feistel_text("secret", value, mask, key))


_RULES = {"secret": secret, "email": email, "access_key": access_key, "iban": iban, "date": date, "ipv4": ipv4, "ssn": ssn, "phone": phone, "card": card}


def _judged(match: Column, key: bytes) -> Column:
    """(kind, text) of a candidate; text is null if it is not valid."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(_KINDS):
        kind = F.when(match.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)

    def new(kind: Column) -> Column:
        text = F.lit(None).cast("string")
        for name, rule in _RULES.items():
            text = F.when(kind == name, rule(match, key)).otherwise(text)
        return _let(text, lambda t: F.struct(F.when(t.isNotNull(), kind).alias("kind"), F.coalesce(t, match).alias("text")))

    return _let(kind, new)


def pseudonymise(docs: DataFrame, *, text_col: str = "text", key: bytes = KEY, out_col: str | None = None, kinds_col: str | None = "kinds") -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` (or in ``out_col``) and, if
    wanted, ``kinds_col``: what was replaced, in the order of the text."""
    text = docs[text_col]
    hinted = F.coalesce(text.rlike(HINT), F.lit(False))
    found = docs.withColumn("__found", F.when(hinted, F.transform(F.regexp_extract_all(text, F.lit(PATTERN), 0), lambda m: _judged(m, key))))
    # The gaps are what the same pattern splits; gap, match, gap, ..., gap.
    gaps = F.split(text, PATTERN, -1)
    whole = F.array_join(F.flatten(F.zip_with(gaps, F.col("__found"), lambda g, m: F.array(g, F.coalesce(m["text"], F.lit(""))))), "")
    out = {out_col or text_col: F.when(F.size(F.coalesce("__found", F.array().cast("array<struct<kind:string,text:string>>"))) > 0, whole).otherwise(text)}
    if kinds_col:
        none = F.array().cast("array<string>")
        out[kinds_col] = F.coalesce(F.transform(F.filter("__found", lambda m: m["kind"].isNotNull()), lambda m: m["kind"]), none)
    return found.withColumns(out).drop("__found")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
