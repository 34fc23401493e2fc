"""File manifests: inventory of a directory tree and reconciliation.

The inventory is the ``binaryFile`` source without its ``content`` column:
Spark lists files in parallel and, since ``content`` is pruned, never reads
file bodies.  Reconciliation is a full outer join of two manifests on the
relative path, so it scales with the number of files.
"""

from __future__ import annotations

import datetime as dt
import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fits(name: str, glob: str) -> bool:
    """A file name against a glob, with alternatives in one pair of braces."""
    head, brace, rest = glob.partition("{")
    inner, _, tail = rest.partition("}")
    return any(fnmatch.fnmatchcase(name, head + x + tail) for x in (inner.split(",") if brace else [""]))


def zero_length_files(
    spark: SparkSession, root: str, glob: str | None = None, recursive: bool = True
) -> list[tuple[str, int, dt.datetime]]:
    """Zero-length files under ``root`` from a Hadoop listing on the driver
    (metadata only; the ``binaryFile`` scan skips empty files)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    it = fs.listFiles(path, recursive)
    while it.hasNext():
        st = it.next()
        if st.getLen() == 0 and (glob is None or _fits(st.getPath().getName(), glob)):
            mtime = dt.datetime.fromtimestamp(st.getModificationTime() / 1000, dt.timezone.utc).replace(tzinfo=None)
            out.append((st.getPath().toString(), 0, mtime))
    return out


def file_inventory(
    spark: SparkSession,
    root: str,
    glob: str | None = None,
    modified_after: str | None = None,
    include_empty: bool = True,
) -> DataFrame:
    """Regular files under ``root`` (recursive): relative path, size, mtime,
    sorted by path (a listing-sized sort).

    Files are listed by the ``binaryFile`` source with ``content`` pruned, so
    no file body is read.  That scan skips zero-length files; they are added
    from the file system's listing (metadata only) unless ``include_empty``
    is off."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    files = reader.load(root).select("path", "length", "modificationTime")
    if include_empty:
        empty = zero_length_files(spark, root, glob)
        if modified_after:
            cutoff = dt.datetime.fromisoformat(modified_after)
            empty = [e for e in empty if e[2] > cutoff]
        if empty:
            extra = spark.createDataFrame(empty, "path string, length bigint, modificationTime timestamp_ntz")
            files = files.unionByName(extra.select("path", "length", F.col("modificationTime").cast("timestamp")))
    base = root.rstrip("/")
    base_uri = base if ":" in base.split("/")[0] else f"file:{base}"
    rel = F.regexp_replace(
        F.regexp_replace(F.col("path"), "^" + _quote(base_uri) + "/", ""), "^" + _quote(base) + "/", ""
    )
    return files.select(
        rel.alias("relative_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("mtime"),
    ).orderBy("relative_path")


def _quote(s: str) -> str:
    return "".join("\\" + c if c in r".^$*+?()[]{}|\\" else c for c in s)


def manifest_reconcile(source: DataFrame, target: DataFrame, key: str = "relative_path", check_mtime: bool = False) -> DataFrame:
    """Status per key: ``missing`` (only in source), ``extra`` (only in
    target), ``size_mismatch``, ``mtime_mismatch`` (with ``check_mtime``),
    or ``ok``."""
    s = source.select(F.col(key), F.col("size").alias("source_size"), F.col("mtime").alias("source_mtime"))
    t = target.select(F.col(key), F.col("size").alias("target_size"), F.col("mtime").alias("target_mtime"))
    j = s.join(t, key, "full_outer")
    status = (
        F.when(F.col("target_size").isNull(), "missing")
        .when(F.col("source_size").isNull(), "extra")
        .when(F.col("source_size") != F.col("target_size"), "size_mismatch")
    )
    if check_mtime:
        status = status.when(~F.col("source_mtime").eqNullSafe(F.col("target_mtime")), "mtime_mismatch")
    return j.select(key, "source_size", "target_size", status.otherwise("ok").alias("status"))
