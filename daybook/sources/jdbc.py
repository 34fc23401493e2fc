"""SQL databases over JDBC, and bulk loading of delimited text.

Reads are split into ``num_partitions`` range queries on a numeric column, so
executors fetch in parallel (``fetchsize`` rows per round trip); writes run
one connection per task with batched inserts (``batchsize``).  The column
types come from the database's result descriptors, as the JDBC source maps
them.

Not exercised against a live database in this repository's tests: starting
one (even embedded in the test process) is out of scope here; the option
building is unit-tested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed value: the client's statement size bound for multi-row inserts.
MAX_INSERT_BYTES = 1_024_000


def read_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    num_partitions: int | None = None,
    fetchsize: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = {"url": url, "fetchsize": str(fetchsize)}
    opts["dbtable" if table else "query"] = table or query
    if partition_column:
        if None in (lower, upper, num_partitions):
            raise ValueError("a partition column needs lower, upper and num_partitions")
        if query is not None:
            raise ValueError("partitioned reads need a table (or a subquery alias as table)")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(num_partitions),
        )
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def jdbc_scan(spark: SparkSession, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(**kw)).load()


def batch_rows(avg_row_bytes: int, max_bytes: int = MAX_INSERT_BYTES) -> int:
    """Rows per insert batch so a batch stays within the statement bound."""
    return max(1, max_bytes // max(1, avg_row_bytes))


def write_options(url: str, table: str, batchsize: int, num_partitions: int | None = None, **extra) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize)}
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)  # caps concurrent connections
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def jdbc_batch_write(df: DataFrame, mode: str = "append", **kw) -> None:
    df.write.format("jdbc").options(**write_options(**kw)).mode(mode).save()


CORRUPT = "_corrupt_record"


def bulk_text_load(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = "|",
    date_format: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text (a file or a folder of parts) with a fixed schema;
    malformed lines keep their text in ``_corrupt_record`` (PERMISSIVE) instead
    of failing the load.  Files are split between tasks; with ``multi_line``
    (quoted fields may hold line breaks) a task reads a whole part."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.read.schema(full)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", str(multi_line).lower())
    )
    if date_format:
        reader = reader.option("dateFormat", date_format)
    return reader.csv(path)
