"""Registered queries of the client library's keyed functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import keyed
from daybook.functions.dates import epoch_seconds, floor_div
from daybook.functions.protect import bind
from daybook.operators import ber
from daybook.operators.one_time_codes import hotp, totp_verify
from daybook.session import tune
from daybook.sources.tables import read_table

KEY_BYTES, SINGLE_BYTES = 82, 40


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    tune(spark)
    return read_table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("data"), F.encode(F.coalesce("source", F.lit("")), "UTF-8").alias("source"))


def q_hkdf_column(spark: SparkSession, sf: str) -> DataFrame:
    """A key for every document from its whole text, salted with its source; a
    single-step key; and the MAC of the source under the document's own key."""
    info = F.encode(F.col("doc_id").cast("string"), "UTF-8")
    made = keyed.hkdf_column(F.col("data"), F.col("source"), info, KEY_BYTES)
    low = lambda c: F.lower(F.hex(c))
    both = bind(made, lambda k: F.struct(low(k).alias("derived"), low(keyed.hmac_by_key(F.col("source"), k)).alias("mac")))
    single = low(keyed.concat_kdf(F.col("data"), info, SINGLE_BYTES))
    return _documents(spark, sf).select("doc_id", single.alias("single"), both.alias("both")).select("doc_id", "both.derived", "single", "both.mac")


def _key_of(name: Column) -> Column:
    return F.unhex(F.md5(name))


def q_cmac_column(spark: SparkSession, sf: str) -> DataFrame:
    """The tag of every whole text under its source's key, checked against the
    text, a longer text and another key."""
    data, key = F.col("data"), _key_of(F.col("source"))
    tags = _documents(spark, sf).select("doc_id", "data", key.alias("key"), keyed.cmac_column(data, key).alias("tag"))
    key, tag = F.col("key"), F.col("tag")
    return tags.select(
        "doc_id", F.octet_length(tag).alias("tag_bytes"),
        keyed.cmac_verify(data, key, tag).alias("ok_self"),
        keyed.cmac_verify(F.concat(data, F.lit(b".")), key, tag).alias("ok_longer"),
        keyed.cmac_verify(data, _key_of(key), tag).alias("ok_other_key"),
    )


def q_siphash_column(spark: SparkSession, sf: str) -> DataFrame:
    """The keyed hash of every whole text under its source's key."""
    return _documents(spark, sf).select("doc_id", keyed.siphash_column(F.col("data"), _key_of(F.col("source"))).alias("hash"))


def sign_ins(events: DataFrame) -> DataFrame:
    """Attempts with one-time codes, from events: those of a user and day fall
    into its first minute, with codes of this, the last or the second next
    step, changed ones and missing ones."""
    k, kind = F.col("event_id"), F.col("event_type")
    seconds = floor_div(epoch_seconds(F.col("ts").cast("timestamp_ntz")), 86_400) * 86_400 + k % 60
    rows = events.select(
        F.col("user_id").alias("user"), seconds.alias("seconds"), k.alias("attempt"), kind.alias("kind"),
        F.substring(F.unhex(F.sha2(F.concat(F.lit("secret "), F.col("user_id").cast("string")), 256)), 1, 20).alias("secret"),
    )
    off = F.when(F.col("kind") == "view", -1).when(F.col("kind") == "signup", 2).otherwise(0)
    code = hotp(F.col("secret"), floor_div(F.col("seconds"), 30) + off)
    given = F.when((F.col("kind") == "error") & (F.col("attempt") % 2 == 0), None).when(F.col("kind") == "purchase", F.reverse(code)).otherwise(code)
    return rows.select("user", "seconds", "attempt", "secret", given.alias("code"))


def q_totp_verify(spark: SparkSession, sf: str) -> DataFrame:
    tune(spark)
    return totp_verify(sign_ins(read_table(spark, sf, "events"))).select("attempt", "code", "step", "status")


def q_ber_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as nested tag-length-value bytes, taken apart again; of one
    in eleven the last byte is lost."""
    tune(spark)
    key, words = F.col("o_orderkey"), F.encode(F.repeat("o_orderpriority", F.col("o_custkey").cast("int") % 60), "UTF-8")
    inner = ber.sequence(ber.integer(key * F.pow(F.lit(10), key % 13).cast("bigint") * -1), ber.boolean(key % 2 == 0))
    whole = ber.sequence(ber.integer(key), ber.part(words, ber.OCTETS), inner, ber.part(F.encode("o_orderstatus", "UTF-8"), 200, ber.CONTEXT))
    rows = read_table(spark, sf, "orders").select("o_orderkey", bind(whole, lambda b: F.when(key % 11 == 0, F.substring(b, F.lit(1), F.octet_length(b) - 1)).otherwise(b)).alias("data"))
    value, number = F.col("value"), (F.col("tag") == ber.INTEGER) & (F.col("class") == ber.UNIVERSAL)
    return ber.ber_explode(rows, "o_orderkey", "data").select(
        F.col("id").alias("o_orderkey"), F.concat_ws(".", "path").alias("path"), "class", "constructed", "tag", "size",
        F.when(number, ber.integer_of(value).cast("string")).when(F.col("tag") == ber.BOOLEAN, F.hex(value)).otherwise(F.decode(value, "UTF-8")).alias("value"), "status",
    )


QUERIES = {
    "ber_explode": q_ber_explode,
    "hkdf_column": q_hkdf_column,
    "totp_verify": q_totp_verify,
    "siphash_column": q_siphash_column,
    "cmac_column": q_cmac_column,
}
