"""Two-pass external shuffle, as native expressions.

The first pass scatters the records by seeded hashes: rendezvous hashing of
the id chooses the shard (the greatest of one hash per shard wins, so a further
shard takes rows only into itself), and a second hash of the whole record
chooses one of the shard's buckets, sized to fit a task's memory.  The scatter
is a repartition by the bucket's number, one task per bucket: records lie in
Spark's shuffle files, not in memory.
The second pass shuffles each bucket by Fisher-Yates (Spark's ``shuffle`` of an
array with a seed).  A record's slot in its shard is its place in the bucket
plus the sizes of the buckets before.

Inside a task, buckets and records are sorted before they are shuffled, so a
task that runs again makes the same permutation.

The law is ``key``: id and number of shards decide.  Shards are equal up to
chance (a hot id, if ids repeat, keeps its shard but is spread over its
buckets by the other columns; only rows equal in every column stay together).

Defined results: a null text has size 1 and the CRC of no bytes; a null id is
one more id; rows that repeat get slots one after another or apart, all
different; an empty table gives an empty result; ``write_shards`` keeps all
columns, and columns named as the results are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

SHARDS = 16
BUCKET_BYTES = 8 << 20
MOST_BYTES = 128 << 20
SEED = 20


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """Rendezvous hashing: 0-based shard of a key."""
    draws = [F.struct(F.xxhash64(F.lit(seed), F.lit(i), key.cast("string")).alias("draw"), F.lit(i).alias("shard")) for i in range(shards)]
    return F.greatest(*draws)["shard"] if shards > 1 else F.lit(0)


def byte_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def external_shuffle(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED
) -> DataFrame:
    """``docs`` with ``shard``, ``bucket`` (inside the shard) and ``slot``
    (gapless from 0 in the shard)."""
    docs = docs.drop("shard", "bucket", "slot")
    total = docs.agg(F.sum(byte_size(docs[text_col]) + 64)).first()[0] or 0
    # Larger buckets for large inputs, so that tasks stay countable.
    size = min(MOST_BYTES, max(bucket_bytes, total // 100_000))
    buckets = max(1, math.ceil(total / (shards * size)))
    record = F.xxhash64(F.lit(seed + 1), *[docs[c] for c in docs.columns])
    placed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), shard_of(docs[id_col], shards, seed).alias("shard"), F.pmod(record, F.lit(buckets)).cast("int").alias("bucket"), record.alias("order"))
    sizes = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # One task per bucket: the bucket's number is the partition's.
    cell = (F.col("shard") * buckets + F.col("bucket")).cast("int")
    scattered = placed.withColumn("cell", cell).repartitionById(shards * buckets, F.col("cell")).sortWithinPartitions("cell", "order")
    shuffled = scattered.groupBy("cell").agg(F.shuffle(F.collect_list("row"), F.lit(seed)).alias("rows"))
    sizes = sizes.withColumn("cell", cell)
    out = shuffled.join(sizes, "cell").select("shard", "bucket", "before", F.posexplode("rows").alias("place", "row"))
    return out.select("row.*", "shard", "bucket", (F.col("before") + F.col("place")).cast("bigint").alias("slot"))


def write_shards(docs: DataFrame, path: str, **kw) -> None:
    """The shuffled records as Parquet, one folder per shard, files of whole
    buckets in slot order."""
    out = external_shuffle(docs, **kw)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = external_shuffle(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", byte_size(F.col("text")).alias("size"), F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", shard_of(F.col("doc_id"), SHARDS + 1).alias("grown_shard"),
    )
