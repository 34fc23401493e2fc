"""Host configuration: ordered blocks of host patterns, looked up for whole
tables of hosts.

A block applies to a host if one of its patterns fits and none of its negated
ones does.  Patterns have ``*``, ``?`` and sets (``[ab]``, ``[!ab]``).  Of every
option the value of the first block that has it counts; identity files add up
over the blocks, each once; forwards are a list of their block.

Hosts and patterns are joined by what patterns spell out, not pair by pair: a
pattern without wildcards by the host itself, else by the labels that it ends
with (``.example.com``), else by its first letters.  Only patterns that spell
out neither end meet all hosts.  What is joined is then matched in full.

Defined results: a host that no block fits has its own name as ``hostname``
and nothing else; null hosts are left out and repeated hosts come once; a block
without a positive pattern applies to no host; within a block the first of equal
options counts; matching tells upper from lower case; an option with a null
value hides later ones (``proxycommand none``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Options that are lists, and the tokens that options expand.
ADDED_UP = ("identityfile",)
LISTED = ("localforward", "remoteforward")
TOKENS = {
    "controlpath": ("%h", "%l", "%L", "%n", "%p", "%r", "%u"),
    "hostname": ("%h",),
    "identityfile": ("~", "%d", "%h", "%l", "%u", "%r"),
    "proxycommand": ("~", "%h", "%p", "%r"),
}
DEFAULT_PORT = "22"
FIRST_LETTERS = 4


def pattern_regex(pattern: Column) -> Column:
    """The regular expression of a whole wildcard pattern."""
    text = F.regexp_replace(pattern, r"([.\\+^$(){}|&~#])", r"\\$1")
    text = F.regexp_replace(text, r"\[(?![^\]]+\])", r"\\[")  # a set that is not closed is a bracket
    text = F.replace(F.replace(F.replace(text, F.lit("[!"), F.lit("[^")), F.lit("*"), F.lit(".*")), F.lit("?"), F.lit("."))
    return F.concat(F.lit(r"(?s)^(?:"), text, F.lit(r")\z"))


def pattern_key(pattern: Column) -> Column:
    """What a pattern is found by."""
    ending = F.regexp_extract(pattern, r"[^*?\]\[]*\z", 0)
    labels = F.regexp_extract(ending, r"\..*\z", 0)
    opening = F.substring(F.regexp_extract(pattern, r"^[^*?\]\[]*", 0), 1, FIRST_LETTERS)
    return (
        F.when(~pattern.rlike(r"[*?\[]"), F.concat(F.lit("="), pattern))
        .when(labels != "", F.concat(F.lit("$"), labels))
        .when(opening != "", F.concat(F.lit("^"), opening))
        .otherwise(F.lit("*"))
    )


def host_keys(host: Column) -> Column:
    """All keys under which a pattern that fits the host can be found."""
    dots = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(host))), lambda i: F.substr(host, i, F.lit(1)) == ".")
    ends = F.transform(dots, lambda i: F.concat(F.lit("$"), F.substr(host, i)))
    openings = F.transform(F.sequence(F.lit(1), F.lit(FIRST_LETTERS)), lambda n: F.concat(F.lit("^"), F.substr(host, F.lit(1), n)))
    return F.array_distinct(F.concat(F.array(F.lit("*"), F.concat(F.lit("="), host)), ends, openings))


def applying_blocks(hosts: DataFrame, patterns: DataFrame) -> DataFrame:
    """Which blocks apply: ``host``, ``block``.  ``patterns``: block, pattern,
    negated."""
    looked = hosts.select("host").where("host IS NOT NULL").distinct()
    index = patterns.select("block", "negated", pattern_regex(F.col("pattern")).alias("regex"), pattern_key(F.col("pattern")).alias("key"))
    met = looked.select("host", F.explode(host_keys(F.col("host"))).alias("key")).join(index, "key").where(F.regexp_like("host", F.col("regex")))
    return met.groupBy("host", "block").agg(F.bool_or(~F.col("negated")).alias("fits"), F.bool_or("negated").alias("not")).where("fits AND NOT `not`").select("host", "block")


def host_config_lookup(hosts: DataFrame, patterns: DataFrame, options: DataFrame, local: Mapping[str, str] | None = None) -> DataFrame:
    """One row per host and option: ``host``, ``key``, ``values`` (one value
    unless the option is a list).  ``options``: block, position, key, value;
    ``local``: what ``%u``, ``%d``, ``%l`` and ``%L`` stand for."""
    local = {"%u": "", "%d": "~", "%l": "localhost", "%L": "localhost", **(local or {})}
    key = F.lower("key")
    given = options.select("block", "position", key.alias("key"), F.when((key == "proxycommand") & (F.lower("value") == "none"), F.lit(None)).otherwise(F.col("value")).alias("value"))
    # One row per block and option, with its values in order.
    rows = F.transform(F.sort_array(F.collect_list(F.struct("position", "value"))), lambda v: v["value"])
    listed = given.where(F.col("key").isin(*ADDED_UP, *LISTED)).groupBy("block", "key").agg(rows.alias("values"))
    single = given.where(~F.col("key").isin(*ADDED_UP, *LISTED)).groupBy("block", "key").agg(F.min_by(F.struct("value"), "position")["value"].alias("v")).select("block", "key", F.array("v").alias("values"))
    found = applying_blocks(hosts, patterns).join(listed.unionByName(single), "block")
    first = found.where(~F.col("key").isin(*ADDED_UP)).groupBy("host", "key").agg(F.min_by("values", "block").alias("values"))
    added = found.where(F.col("key").isin(*ADDED_UP)).groupBy("host", "key").agg(
        F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("block", "values"))), lambda b: b["values"]))).alias("values")
    )
    found = first.unionByName(added)
    # What the tokens of a host's options stand for.
    value = lambda name: F.max(F.when(F.col("key") == name, F.get("values", 0))).alias(name)
    known = hosts.select("host").where("host IS NOT NULL").distinct().join(found.groupBy("host").agg(value("hostname"), value("port"), value("user")), "host", "left")
    name = F.coalesce(F.replace("hostname", F.lit("%h"), F.col("host")), F.col("host"))
    known = known.select("host", name.alias("real"), F.coalesce("port", F.lit(DEFAULT_PORT)).alias("port"), F.coalesce("user", F.lit(local["%u"])).alias("user"))
    stands = {"%h": F.col("real"), "%n": F.col("host"), "%p": F.col("port"), "%r": F.col("user"), "~": F.lit(local["%d"]), **{t: F.lit(x) for t, x in local.items()}}

    def expanded(of: str) -> Column:
        def one(text: Column) -> Column:
            for token in ("%d", "%h", "%L", "%l", "%n", "%p", "%r", "%u", "~"):
                if token in TOKENS[of]:
                    text = F.replace(text, F.lit(token), stands[token])
            return text

        return F.transform("values", one)

    done = found.where("key != 'hostname'").join(known, "host")
    values = F.col("values")
    for of in TOKENS:
        if of != "hostname":
            values = F.when(F.col("key") == of, expanded(of)).otherwise(values)
    names = known.select("host", F.lit("hostname").alias("key"), F.array("real").alias("values"))
    return done.select("host", "key", values.alias("values")).unionByName(names)
