"""Length-bucketed packing.

Every text becomes pieces of at most ``max_len`` tokens (whole texts: a long
text gives several pieces).  Dynamic programming over the histogram of all
piece lengths chooses at most ``n_buckets`` boundaries with the least total
padding.  Inside a bucket, pieces in the order of a seeded hash form batches
of a fixed number of rows: as many padded pieces as the token budget holds.

The histogram has at most ``max_len`` rows whatever the input, so the driver
can hold it.  Rows are numbered in cells (a bucket times a prefix of the hash)
and the cells' sizes are added up before them, so no task numbers a whole
bucket.

A token is a UTF-8 byte, plus one end-of-text token (byte-level vocabulary);
``lengths`` takes any other count, for instance of ``bpe_tokens``.

Defined results: null and empty texts are the end token alone; rows with equal
id and piece are numbered one after the other (they are interchangeable); null
ids come like any other; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

MAX_LEN = 4096
N_BUCKETS = 8
BUDGET = 65536
SEED = "pack-1"
CELL_ROWS = 50_000


def byte_tokens(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def bpe_tokens(docs: DataFrame, ranks_file: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``: tokens of a byte-pair vocabulary, plus the end
    token.  The file (lines of base64 token and rank) is read on the driver and
    broadcast; every task builds the vocabulary once.  Null counts as empty."""
    import tiktoken

    with open(ranks_file, "rb") as f:
        lines = docs.sparkSession.sparkContext.broadcast(f.read())

    def task(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.value.splitlines() if line.strip())}
        bpe = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pa.array([len(bpe.encode_ordinary(t or "")) + 1 for t in texts.to_pylist()], pa.int64())

    # The hints are given as types: under deferred annotations they are names.
    task.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn("n_tokens", F.arrow_udf(task, "bigint")(docs[text_col]))


def boundaries(lengths: list[int], counts: list[int], n_buckets: int) -> list[int]:
    """Upper ends of at most ``n_buckets`` buckets with the least padding; of
    equal choices, the one with the lowest boundaries from the top down."""
    order = np.argsort(lengths)
    size = np.array(lengths, np.int64)[order]
    rows = np.append(0, np.cumsum(np.array(counts, np.int64)[order]))
    n = len(size)
    if not n:
        return []
    # best[j]: least padded tokens of the first j lengths (the tokens
    # themselves are a constant); came: where the last bucket begins.
    best = np.append(0, size * rows[1:])
    came = [np.zeros(n + 1, np.int64)]
    for _ in range(1, min(n_buckets, n)):
        after, at = best.copy(), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + size[j - 1] * (rows[j] - rows[:j])
            at[j] = cost.argmin()
            after[j] = cost[at[j]]
        best = after
        came.append(at)
    out, j = [], n
    for at in reversed(came):
        if j:
            out.append(int(size[j - 1]))
            j = int(at[j])
    return out[::-1]


def pack(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lengths: Column | None = None,
    max_len: int = MAX_LEN, n_buckets: int = N_BUCKETS, budget: int = BUDGET, seed: str = SEED,
) -> DataFrame:
    """One row per piece: ``id``, ``piece``, ``start`` and ``n_tokens`` (its
    stretch of the text's tokens), ``bucket``, ``bucket_len`` (padded length),
    ``batch`` (numbered inside the bucket) and ``slot`` (place in the batch)."""
    n = byte_tokens(docs[text_col]) if lengths is None else lengths.cast("bigint")
    narrow = written(docs.select(docs[id_col].alias("id"), n.alias("n")), "lengths")
    last = F.ceil(F.col("n") / F.lit(max_len)).cast("bigint") - 1
    pieces = narrow.select("id", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece")).select(
        "id", "piece", (F.col("piece") * max_len).alias("start"), F.least(F.lit(max_len).cast("bigint"), F.col("n") - F.col("piece") * max_len).alias("n_tokens")
    )
    histogram = pieces.groupBy("n_tokens").count().collect()
    ends = boundaries([r["n_tokens"] for r in histogram], [r["count"] for r in histogram], n_buckets) or [max_len]
    total = sum(r["count"] for r in histogram)
    digits = 2
    while total > CELL_ROWS * 16**digits:
        digits += 1
    bucket, upper = F.lit(len(ends) - 1), F.lit(ends[-1])
    for i, end in reversed(list(enumerate(ends[:-1]))):
        bucket = F.when(F.col("n_tokens") <= end, i).otherwise(bucket)
        upper = F.when(F.col("n_tokens") <= end, end).otherwise(upper)
    placed = pieces.withColumns({
        "bucket": bucket.cast("bigint"), "bucket_len": upper.cast("bigint"),
        "order": F.md5(F.concat_ws("-", F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("piece").cast("string"))),
    }).withColumn("cell", F.substring("order", 1, digits))
    before = Window.partitionBy("bucket").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = placed.groupBy("bucket", "cell").count().select("bucket", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("bucket", "cell").orderBy("order", "id", "piece"))
    numbered = placed.withColumn("rank", rank).join(cells, ["bucket", "cell"])
    place = F.col("before") + F.col("rank") - 1
    per_batch = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(budget) / F.col("bucket_len")))
    return numbered.select("id", "piece", "start", "n_tokens", "bucket", "bucket_len", F.floor(place / per_batch).cast("bigint").alias("batch"), (place % per_batch).cast("bigint").alias("slot"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
