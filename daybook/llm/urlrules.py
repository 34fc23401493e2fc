"""Association-rule URL filter, as native expressions and Spark's FP-growth.

URLs become sets of tokens (scheme, host labels, path words with numbers as
``#``, file ending, query keys, fragment).  FP-growth over the labelled pages'
tokens plus their label finds frequent combinations; rules "tokens => block"
are kept by support and confidence, however many tokens they have.

Tokens that stand on exactly the same labelled pages can replace each other in
any rule, so they form a group and FP-growth mines groups: a long URL that many
labelled pages share adds one group, not a power of its tokens.  A URL has a
group if it has one of its tokens.  A rule that has a part of one group less
with at least its confidence can never be a URL's best (highest confidence,
then support, then fewest tokens, then first text) and is left out.  An inverted
index lists each rule under its rarest group; a URL's groups look rules up there
and the rule matches if the URL has all its groups.  Stated host and path rules
go before the learnt ones.

Frequent combinations of groups are bounded by the number of groups on a page
and the support, not by the data; the index is broadcast only below
``BROADCAST_RULES`` rows.  Matching works on distinct URLs, so a URL that a third
of the pages share is matched once.

Defined results: null URLs and URLs without ``://`` have empty host and path,
no rule and, lacking tokens, the verdict ``allow``; without labelled pages
nothing is learnt and the method allows; a page with several labels is blocked
if any says so; repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: (verdict, host, path): stated rules; a rule's name is host + path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
MIN_SUPPORT = 0.005
MIN_PAGES = 5
MIN_CONFIDENCE = 0.6
BROADCAST_RULES = 20_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def stated(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(name, verdict) of the longest fitting rule of a short list; else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL, ascending; empty without ``://``."""

    def words(kind: str, text: Column, pattern: str) -> Column:
        found = F.filter(F.split(text, pattern), lambda w: w != "")
        return F.transform(found, lambda w: F.concat(F.lit(kind + ":"), F.regexp_replace(w, "[0-9]+", "#")))

    low = F.lower(url)
    rest = F.regexp_extract(low, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    made = F.array_sort(F.array_distinct(F.flatten(F.array(
        words("scheme", F.regexp_extract(low, r"(?s)^(.*?)://", 1), "://"),
        words("host", host(url), r"\."),
        words("path", F.regexp_extract(rest, r"(?s)^([^?#]*)", 1), r"[/.]+"),
        words("query", F.regexp_extract(rest, r"(?s)^[^?#]*\?([^#]*)", 1), "&"),
        words("part", F.regexp_extract(rest, r"(?s)#(.*)$", 1), "#"),
    ))))
    return F.when(url.contains("://"), made).otherwise(F.array().cast("array<string>"))


def learn(
    labelled: DataFrame, *, min_support: float = MIN_SUPPORT, min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE
) -> tuple[DataFrame, DataFrame] | None:
    """From rows (``tokens``, ``blocked``) the rules: ``groups`` (their names),
    ``confidence``, ``support`` (pages with the tokens and the label) and
    ``anchor`` (the rule's rarest group); and the groups' tokens: ``token``,
    ``group``.  None without rows."""
    label = "label:block"
    pages = written(labelled.select(F.monotonically_increasing_id().alias("page"), "tokens", "blocked"), "url-labelled")
    n = pages.count()
    if not n:
        return None
    # Half a page below the wanted count, as the miner rounds share x n up.
    share = min(1.0, max(min_support, (min_pages - 0.5) / n))
    # Tokens of the same pages have equal counts and equal sums of page hashes.
    held = pages.select("page", F.explode("tokens").alias("token"))
    signed = held.groupBy("token").agg(F.count("*").alias("freq"), *[F.bit_xor(F.xxhash64("page", F.lit(s))).alias(f"x{s}") for s in (1, 2)])
    signed = signed.where(F.col("freq") >= share * n)
    named = signed.groupBy("freq", "x1", "x2").agg(F.min("token").alias("group"))
    members = written(signed.join(named, ["freq", "x1", "x2"]).select("token", "group", "freq"), "url-groups")
    items = held.join(members, "token").groupBy("page").agg(F.collect_set("group").alias("items"))
    baskets = pages.join(items, "page", "left").select(F.coalesce("items", F.array().cast("array<string>")).alias("items"), "blocked")
    baskets = written(baskets.select(F.when(F.col("blocked"), F.concat("items", F.array(F.lit(label)))).otherwise(F.col("items")).alias("items")), "url-baskets")
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.element_at("consequent", 1) == label)
    rules = rules.select(F.array_sort("antecedent").alias("groups"), "confidence", F.round(F.col("support") * n).cast("bigint").alias("support"))
    mined = written(rules, "url-mined")
    # Whatever URL a rule matches, its part matches too.
    parts = mined.select(F.col("groups").alias("part"), F.col("confidence").alias("c"))
    longer = mined.select("*", F.explode("groups").alias("group")).withColumn("part", F.array_remove("groups", F.col("group"))).join(parts, "part")
    rules = written(mined.join(longer.where(F.col("c") >= F.col("confidence")).select("groups").distinct(), "groups", "left_anti"), "url-rules")
    rarest = (
        rules.select("groups", F.explode("groups").alias("group")).join(members.where(F.col("token") == F.col("group")), "group")
        .groupBy("groups").agg(F.min(F.struct("freq", "group"))["group"].alias("anchor"))
    )
    return rules.join(rarest, "groups"), members.select("token", "group")


def match(urls: DataFrame, rules: DataFrame, members: DataFrame) -> DataFrame:
    """Per distinct non-null ``url`` that a rule matches: ``learnt`` (the best
    rule's tokens in one text), ``confidence`` and ``support``."""

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= BROADCAST_RULES else df

    index = small(written(rules, "url-index"))
    members = small(members.join(rules.select(F.explode("groups").alias("group")).distinct(), "group", "left_semi"))
    listed = urls.select("url").where("url IS NOT NULL").distinct().select("url", F.explode(tokens(F.col("url"))).alias("token"))
    # The first of the URL's tokens stands for the group.
    have = listed.join(members, "token").groupBy("url", "group").agg(F.min("token").alias("token"))
    have = have.groupBy("url").agg(F.map_from_entries(F.collect_list(F.struct("group", "token"))).alias("have"))
    hits = have.select("url", "have", F.explode(F.map_keys("have")).alias("anchor")).join(index, "anchor")
    hits = hits.where(F.forall("groups", lambda g: F.map_contains_key("have", g)))
    text = F.array_join(F.array_sort(F.transform("groups", lambda g: F.element_at("have", g))), " ")
    # Highest confidence, then support, then fewest, then the first text: minima throughout.
    best = F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.size("groups").alias("n"), text.alias("t")))
    return hits.groupBy("url").agg(best.alias("b")).select("url", F.col("b.t").alias("learnt"), (-F.col("b.c")).alias("confidence"), (-F.col("b.s")).alias("support"))


def judge(pages: DataFrame, labels: DataFrame, *, rules: list[tuple[str, str, str]] = RULES, **kw) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule`` and
    ``verdict``, with the learnt rule (``learnt``, ``confidence``).  ``labels``:
    doc_id, quality, toxic of the page; toxic or low-quality pages teach."""
    rows = pages.select("page_id", "url")
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    marked = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("blocked"))
    labelled = rows.join(marked, "page_id").select(tokens(F.col("url")).alias("tokens"), "blocked").where(F.size("tokens") > 0)
    learnt = learn(labelled, **kw)
    if learnt is None:
        found = rows.withColumns({"learnt": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    else:
        found = rows.join(match(rows, *learnt), "url", "left")
    name, verdict = stated(F.col("host"), F.col("path"), rules)
    found = found.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "learnt", "confidence")
    return found.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(F.col("learnt").isNotNull(), "block").otherwise("allow")).alias("verdict"), "learnt", "confidence")


def op5_urlrules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
