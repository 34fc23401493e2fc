"""Product codes of vectors by member-resident Lloyd.

Vectors are cut into ``PARTS`` equal consecutive parts of whole numbers; each
part position has a codebook of its own, learnt by Lloyd's rounds.  Rows of
parts live with their owner: the partition of (position, entry, salt).  In a
round every owner gives its residents their nearest entry under the codebook of
its position.  Those that keep their entry stay where they lie, in a file that
the owner's task writes without a shuffle; only those that change it migrate to
the new entry's owner.  Entries are then updated from the resident members,
summed in the owners' tasks first.  The salt splits an entry that holds more
than ``MEMBERS`` rows, so a crowded entry has many owners.

Codebooks have ``ENTRIES`` x dimensions whole numbers however many vectors there
are: the driver holds them and sends them to the tasks.  All arithmetic is on
integers, so results do not depend on the partitioning.

Defined results: rows whose vector is null, empty, or holds a null or
non-finite component are dropped, and so are vectors of another length than
most have (of equally common lengths the longer) or, with none of a length that
``parts`` divides, all of them.  Components are taken as at most 2^20 in size,
so that every sum of squares is exact.  The codebook begins with the vectors
of the least ids (null ids last, equal ids by the vector); fewer vectors than
entries give as many entries.  Repeated rows count and come out each; equal
distances take the lower entry; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
MEMBERS = 200_000
_BOUND = float(1 << 20)


def whole(x: Column, scale: int, bound: float = _BOUND) -> Column:
    """floor(scale * x) of a finite component."""
    return F.floor(F.least(F.greatest(x.cast("double"), F.lit(-bound)), F.lit(bound)) * scale).cast("bigint")


def usable(vectors: DataFrame, vector_col: str, divisor: int = 1) -> DataFrame:
    """The rows whose vector can be used, all of one length."""
    v = vectors[vector_col]
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    rows = vectors.where(F.coalesce(fine, F.lit(False)))
    most = rows.groupBy(F.size(rows[vector_col]).alias("size")).count().where(F.col("size") % divisor == 0).orderBy(F.desc("count"), F.desc("size")).head()
    return rows.where(F.size(rows[vector_col]) == (most["size"] if most else -1))


def _matrix(lists: pa.ListArray, width: int, dtype) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``book`` (ties: the lower) and its squared
    distance, for every row of ``x``."""
    best = np.full(len(x), np.iinfo(np.int64).max)
    at = np.zeros(len(x), np.int64)
    for k, entry in enumerate(book):
        d = x - entry
        d = (d * d).sum(1)
        less = d < best
        best[less], at[less] = d[less], k
    return at, best


_MEMBER = T.StructType([
    T.StructField("position", T.IntegerType()), T.StructField("entry", T.IntegerType()), T.StructField("salt", T.IntegerType()),
    T.StructField("part", T.ArrayType(T.LongType())), T.StructField("moved", T.BooleanType()),
])


def _reassigned(books: np.ndarray):
    """Task that gives members (position, entry, salt, part) their nearest entry."""
    width = books.shape[2]

    def task(batches):
        for batch in batches:
            position, entry = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            part, new = _matrix(batch.column(3), width, np.int64), np.empty(batch.num_rows, np.int64)
            for p in np.unique(position):
                here = position == p
                new[here] = nearest(part[here], books[p])[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(new.astype(np.int32)), batch.column(2), batch.column(3), pa.array(new != entry)], names=_MEMBER.names
            )

    return task


def _updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry with members becomes the floor of their mean, by component."""
    width = books.shape[2]
    sums = [F.sum(F.col("part")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = books.copy()
    # At most parts x entries rows reach the driver.
    for r in members.groupBy("position", "entry").agg(F.count("*").alias("n"), *sums).collect():
        out[r["position"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return out


def codebooks(vectors: DataFrame, *, rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES, n: int | None = None) -> np.ndarray | None:
    """The learnt entries as (position, entry, component) of rows (``id``,
    ``x``: whole numbers); None without rows."""
    spark = vectors.sparkSession
    first = vectors.select("id", "x").orderBy(F.asc_nulls_last("id"), "x").limit(entries).collect()
    if not first:
        return None
    width = len(first[0]["x"]) // parts
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    n = vectors.count() if n is None else n
    # Owners hold about MEMBERS rows at most, also where one entry has all.
    salts, owners = max(1, -(-n // MEMBERS)), max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts * n // MEMBERS)
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.struct(p.alias("position"), F.slice("x", p * width + 1, F.lit(width)).alias("part")))
    newcomers = vectors.select(F.inline(cut)).select(
        "position", F.lit(-1).alias("entry"), F.pmod(F.xxhash64("part", F.monotonically_increasing_id()), F.lit(salts)).cast("int").alias("salt"), "part"
    )
    home = ["position", "entry", "salt"]
    residents = None
    for r in range(rounds):
        judged = (newcomers if residents is None else residents).mapInArrow(_reassigned(books), _MEMBER)
        if residents is None:
            residents = written(judged.drop("moved").repartition(owners, *home), "members")
        else:
            split = written(judged, f"round-{r}", "moved")
            migrants = written(split.where("moved").drop("moved").repartition(owners, *home), f"migrants-{r}")
            residents = split.where(~F.col("moved")).drop("moved").unionByName(migrants)
        books = _updated(residents, books)
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vectors`` (with ``x``) and, added, ``code`` (entries in part order, two
    hex digits each or as many as the entries need) and ``error``."""
    parts, entries, width = books.shape
    digits = max(2, len(f"{entries - 1:x}"))
    names = np.array([f"{k:0{digits}x}" for k in range(entries)])

    def task(batches):
        for batch in batches:
            x = _matrix(batch.column(batch.schema.get_field_index("x")), parts * width, np.int64)
            code, error = np.zeros(len(x), "U1"), np.zeros(len(x), np.int64)
            for p in range(parts):
                at, d = nearest(x[:, p * width : (p + 1) * width], books[p])
                code, error = np.char.add(code, names[at]), error + d
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code.tolist(), pa.string()), pa.array(error)], names=[*batch.schema.names, "code", "error"])

    return vectors.mapInArrow(task, T.StructType([*vectors.schema, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]))


def compress(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray | None]:
    """One row per usable vector (``id``, ``label``, ``code``, ``error``), and
    the codebooks."""
    kept = usable(vectors, vector_col, parts)
    rows = written(kept.select(kept[id_col].alias("id"), kept[label_col].alias("label"), F.transform(kept[vector_col], lambda c: whole(c, scale)).alias("x")), "vectors")
    books = codebooks(rows, rounds=rounds, parts=parts, entries=entries)
    if books is None:
        return rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), None
    return encode(rows, books).drop("x"), books


def op11_vectorcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(b"" if books is None else ",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = written(coded, "vector-codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
