"""Registered queries of the client library's table jobs: statements, result
sets, range reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import result_sets as rs
from daybook.operators.host_config import host_config_lookup
from daybook.operators.links import resolve_links
from daybook.operators.ranges import range_read_plan
from daybook.operators.statements import MAX_BYTES, insert_statements
from daybook.session import tune
from daybook.sources import raw_text
from daybook.sources.tables import read_table

#: Statement sizes of the query: the client's own, and one that gives many.
STATEMENT_BYTES = (MAX_BYTES, 16_384)
STATEMENT_POSTFIX = " ON DUPLICATE KEY UPDATE o_totalprice = VALUES(o_totalprice)"


def q_insert_statements(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as multi-row statements, with a note that needs escaping and
    is missing for some; one row per statement with its digest."""
    tune(spark)
    orders = read_table(spark, sf, "orders")
    note = F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("it's \"\\\n"), F.col("o_orderpriority"), F.lit("\t\r é\x1a")))
    rows = orders.withColumn("note", note).withColumn("per_day", F.col("o_totalprice") / 365)
    out = None
    for size in STATEMENT_BYTES:
        made = insert_statements(
            rows, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "per_day", "o_orderdate", "note"], ["o_orderkey"], postfix=STATEMENT_POSTFIX, max_bytes=size
        )
        made = made.select(F.lit(size).cast("bigint").alias("max_bytes"), "statement", "n_rows", "n_bytes", F.md5("sql").alias("digest"))
        out = made if out is None else out.unionByName(made)
    return out


BINARY = rs.BINARY_CHARSET
#: (result, position, table, name, type code, flags, scale, charset)
RESULT_COLUMNS = [
    ("events", 0, "events", "at", rs.DATETIME, 0, 6, BINARY), ("events", 1, "events", "gap", rs.TIME, 0, 6, BINARY),
    ("events", 2, "events", "stamp", rs.TIMESTAMP, 0, 0, BINARY), ("events", 3, "events", "props", rs.JSON, 0, 0, BINARY),
    ("events", 4, "events", "kind", rs.VAR_STRING, 0, 0, 45),
    ("orders", 0, "orders", "day", rs.DATE, 0, 0, BINARY), ("orders", 1, "orders", "price", rs.NEWDECIMAL, 0, 18, BINARY),
    ("orders", 2, "orders", "number", rs.LONGLONG, 0, 0, BINARY), ("orders", 3, "orders", "count", rs.LONGLONG, rs.UNSIGNED, 0, BINARY),
    ("orders", 4, "orders", "real", rs.DOUBLE, 0, 0, BINARY), ("orders", 5, "orders", "small", rs.TINY, 0, 0, BINARY),
    ("pages", 0, "pages", "tags", rs.SET, 0, 0, 45), ("pages", 1, "pages", "bytes", rs.BLOB, 0, 0, rs.BINARY_CHARSET),
]


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    """Raw cells of three result sets in one long table; every eleventh row of a
    column is NULL."""
    events, orders, pages = (read_table(spark, sf, n) for n in ("events", "orders", "pages"))
    number = raw_text.numeric_texts(orders)
    columns = {
        "events": [raw_text.datetime_texts(events), raw_text.interval_texts(events), raw_text.compact_texts(events), events.select("event_id", "props"), events.select("event_id", "event_type")],
        "orders": [raw_text.date_texts(orders), number, number, number, number, orders.select("o_orderkey", (F.col("o_orderkey") % 300 - 150).cast("string"))],
        "pages": [raw_text.set_texts(pages), pages.select("page_id", "url")],
    }
    out = None
    for result, raws in columns.items():
        for position, raw in enumerate(raws):
            row, content = (F.col(c) for c in raw.columns)
            content = F.when(row % 11 != position, F.encode(content, "UTF-8"))
            cells = raw.select(F.lit(result).alias("result"), row.alias("row"), F.lit(position).alias("position"), content.alias("content"))
            out = cells if out is None else out.unionByName(cells)
    return out


def q_decode_by_descriptor(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell with its value, by the kind of type its descriptor names.
    (The descriptors are a fixed few, of a size Spark does not know: broadcast,
    so that no cell is shuffled to the task of its column.)"""
    tune(spark)
    done = rs.decode_cells(_cells(spark, sf), F.broadcast(spark.createDataFrame(RESULT_COLUMNS, rs.DESCRIPTORS)))
    get = lambda kind, *codes: F.when(F.col("type_code").isin(*codes), F.try_variant_get("value", "$", kind))
    number = F.replace(F.format_number(get("decimal(38,18)", rs.NEWDECIMAL, rs.LONGLONG, rs.TINY), 18), F.lit(","), F.lit(""))
    return done.select(
        "result", "row", "name", number.alias("as_decimal"), get("double", rs.DOUBLE).alias("as_double"), get("bigint", rs.TIME).alias("as_micros"),
        F.coalesce(get("timestamp_ntz", rs.DATETIME, rs.TIMESTAMP), get("date", rs.DATE).cast("timestamp_ntz")).alias("as_time"),
        F.coalesce(get("string", rs.VAR_STRING), F.array_join(get("array<string>", rs.SET), "|"), F.hex(get("binary", rs.BLOB))).alias("as_text"),
        F.when(F.col("type_code") == rs.JSON, F.col("value").isNotNull()).alias("is_json"), F.col("reject").cast("string").alias("reject"),
    )


def wanted_ranges(events: DataFrame) -> DataFrame:
    """Byte ranges of files, from events: a third of all (the clicks) want one
    file, the others one for each of 50 groups of users."""
    k = F.col("event_id")
    size = F.when(F.col("event_type") == "error", F.lit(0)).when(F.col("event_type") == "purchase", k % 300_007).otherwise(k * 31 % 9_001)
    file = F.when(F.col("event_type") == "click", "hot").otherwise(F.concat(F.lit("user-"), (F.col("user_id") % 50).cast("string")))
    return events.select(file.alias("file"), (k * 104_729 % 40_000_003).alias("offset"), size.alias("size"))


def q_range_read_plan(spark: SparkSession, sf: str) -> DataFrame:
    tune(spark)
    return range_read_plan(wanted_ranges(read_table(spark, sf, "events")))


#: A block for every host of the pages, numbered by a hash of the host.
HOST = r"^[^:]+://([^/?#]*)"
LAST_BLOCK = 1 << 28


def host_rules(hosts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(patterns, options) made from hosts: patterns of five shapes, some
    negated ones, and a last block for all."""
    spark = hosts.sparkSession
    block = F.conv(F.substring(F.md5("host"), 1, 7), 16, 10).cast("bigint")
    rows = hosts.select("host", block.alias("block"))
    k, h = F.col("block"), F.col("host")
    shape = (
        F.when(k % 5 == 0, h).when(k % 5 == 1, F.concat(F.lit("*"), F.regexp_extract(h, r"\..*$", 0))).when(k % 5 == 2, F.concat(F.substring(h, 1, 3), F.lit("*")))
        .when(k % 5 == 3, F.concat(F.lit("?"), F.substr(h, F.lit(2)))).otherwise(F.concat(F.lit("*["), F.substring(h, -7, 1), F.lit("x]"), F.substr(h, F.length(h) - 5)))
    )
    last = spark.createDataFrame([(LAST_BLOCK, "*", False)], "block long, pattern string, negated boolean")
    patterns = rows.select("block", shape.alias("pattern"), F.lit(False).alias("negated")).unionByName(rows.where(k % 4 == 0).select("block", F.lit("m.*").alias("pattern"), F.lit(True).alias("negated"))).unionByName(last)
    number = k.cast("string")
    given = [
        (F.when(k % 2 == 0, "Port"), F.concat(F.lit("1"), number)),
        (F.lit("User"), F.concat(F.lit("u"), number)),
        (F.lit("user"), F.lit("second")),
        (F.when(k % 3 == 0, "ProxyCommand"), F.when(k % 9 == 0, "none").otherwise("nc %h:%p -l %r ~")),
        (F.lit("IdentityFile"), F.concat(F.lit("%d/id_"), (k % 3).cast("string"), F.lit("_%r"))),
        (F.when(k % 7 == 0, "HostName"), F.lit("%h.internal")),
    ]
    given = F.array(*[F.struct(F.lit(i).alias("position"), name.alias("key"), value.alias("value")) for i, (name, value) in enumerate(given)])
    options = rows.select("block", F.inline(given)).where("key IS NOT NULL")
    last = spark.createDataFrame([(LAST_BLOCK, 0, "ControlPath", "%n-%p-%u"), (LAST_BLOCK, 1, "User", "root")], "block long, position int, key string, value string")
    return patterns, options.unionByName(last)


def q_host_config_lookup(spark: SparkSession, sf: str) -> DataFrame:
    tune(spark)
    hosts = read_table(spark, sf, "pages").select(F.regexp_extract("url", HOST, 1).alias("host")).distinct()
    done = host_config_lookup(hosts, *host_rules(hosts), {"%u": "me", "%d": "/home/me"})
    return done.select("host", "key", F.size("values").alias("n"), F.array_join("values", "|", "(none)").alias("text"))


def q_resolve_links(spark: SparkSession, sf: str) -> DataFrame:
    """A link for every order: chains to every tenth order's file (missing for
    a third of these), and cycles of four in every fifty."""
    tune(spark)
    k = F.col("o_orderkey")
    orders = read_table(spark, sf, "orders").select(k)
    following = (k + 1).cast("string")
    target = (
        F.when(k % 10 == 0, F.concat(F.lit("../o/f"), k.cast("string"))).when(k % 50 == 7, F.concat(F.lit("l"), (k - 3).cast("string")))
        .when(k % 2 == 0, F.concat(F.lit("./l"), following)).otherwise(F.concat(F.lit("/o/x/..//l"), following))
    )
    links = orders.select(F.concat(F.lit("/o/l"), k.cast("string")).alias("path"), target.alias("target"))
    files = orders.where((k % 10 == 0) & (k % 3 != 0)).select(F.concat(F.lit("/o/f"), k.cast("string")).alias("path"))
    return resolve_links(links, files)


QUERIES = {
    "insert_statements": q_insert_statements,
    "decode_by_descriptor": q_decode_by_descriptor,
    "range_read_plan": q_range_read_plan,
    "host_config_lookup": q_host_config_lookup,
    "resolve_links": q_resolve_links,
}
