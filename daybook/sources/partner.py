"""Files that come back from the partner, and the statistic documents.

Files are read with the ``binaryFile`` source: one row per file with
``path, modificationTime, length, content``; decoding and base64 happen in
executors.  A large export or result is a folder of ordered parts, so no value
holds a whole report: its text is read line by line, and each part is one
attachment.  A statistic document is a JSON array whose first object's keys and
values are reported; text that is not such an array counts as an empty object
(the run continues).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.manifest import zero_length_files

STAT_SCHEMA = "array<map<string,string>>"


def read_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "modificationTime", "length", "content")
    # The scan skips zero-length files; they are results like any other.
    empty = zero_length_files(spark, path, glob, recursive)
    if not empty:
        return files
    rows = spark.createDataFrame([(p, n, t) for p, n, t in empty], "path string, length bigint, modificationTime timestamp_ntz")
    rows = rows.select("path", F.col("modificationTime").cast("timestamp").alias("modificationTime"), "length", F.lit(b"").alias("content"))
    return files.unionByName(rows)


def read_lines(spark: SparkSession, path: str, line_end: str) -> DataFrame:
    """The lines of a text file or of a folder of parts: ``file_name``,
    ``line``; files are split between tasks."""
    lines = spark.read.option("lineSep", line_end).text(path)
    return lines.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("line"))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def read_result_text(files: DataFrame) -> DataFrame:
    """Each file's bytes decoded as UTF-8 text."""
    return files.select(
        file_name(F.col("path")).alias("file_name"),
        F.col("length"),
        F.decode(F.col("content"), "UTF-8").alias("text"),
    )


def attachment_b64(files: DataFrame, name: Column | None = None) -> DataFrame:
    """``{filename, content}`` pairs: single-line base64 of each file's bytes
    (needs ``spark.sql.chunkBase64String.enabled=false``, set by
    ``session.tune``; line breaks are stripped as well to be safe)."""
    name = name if name is not None else file_name(F.col("path"))
    return files.select(
        name.alias("filename"),
        F.regexp_replace(F.base64(F.col("content")), r"[\r\n]", "").alias("content"),
    )


def stat_pairs(docs: DataFrame, text_col: str = "doc", key_cols=()) -> DataFrame:
    """Keys and values of the first object of each JSON-array document, one row
    per pair in document order (``pos``); a repeated key keeps its first place
    and its last value, like a dict.  Invalid text, a non-array, an empty array
    or a non-object first element give one row with NULL key: the document is
    read as an empty object."""
    first = F.get(F.from_json(F.col(text_col), STAT_SCHEMA), 0)
    keys, values = F.map_keys(first), F.map_values(first)
    n = F.size(keys)
    # The value of a key is that of its last occurrence.
    last = F.transform(
        F.array_distinct(keys),
        lambda k: F.struct(k.alias("key"), F.element_at(values, n - F.array_position(F.reverse(keys), k).cast("int") + 1).alias("value")),
    )
    pairs = F.posexplode_outer(F.when(first.isNotNull(), last)).alias("pos", "pair")
    return docs.select(*key_cols, pairs).select(*key_cols, "pos", F.col("pair.key").alias("key"), F.col("pair.value").alias("value"))
