"""Read plans: the requests that fetch wanted byte ranges of files.

Ranges of a file that overlap or touch are one stretch, and every stretch is
cut into requests of at most ``REQUEST_BYTES`` from its beginning on, so no
byte is fetched twice.

A file can hold any share of all ranges and be of any length, so it is cut at
fixed places into segments: ranges are first made one per start and segment (a
partial aggregate), gaps and islands are found segment by segment, and only the
islands that touch a segment's border, two a segment at most, are chained per
file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REQUEST_BYTES = 32_768  # fixed value: the client's largest read request
SEGMENT_BYTES = 8 << 20


def coalesced(ranges: DataFrame, segment: int = SEGMENT_BYTES) -> DataFrame:
    """From ``file``, ``offset``, ``size`` the stretches by segment: ``file``,
    ``segment``, ``start``, ``stop`` (inside the segment), ``first`` and
    ``last`` (of the whole stretch).  Empty ranges and those before a file's
    beginning or with nulls fetch nothing."""
    wanted = ranges.where("file IS NOT NULL AND offset >= 0 AND size > 0").select("file", F.col("offset").cast("bigint").alias("a"), (F.col("offset") + F.col("size")).cast("bigint").alias("b"))
    number = F.explode(F.sequence(F.floor(F.col("a") / segment), F.floor((F.col("b") - 1) / segment)))
    pieces = wanted.select("file", "a", "b", number.alias("segment")).select(
        "file", "segment", F.greatest("a", F.col("segment") * segment).alias("start"), F.least("b", (F.col("segment") + 1) * segment).alias("stop")
    )
    starts = pieces.groupBy("file", "segment", "start").agg(F.max("stop").alias("stop"))
    inside = Window.partitionBy("file", "segment").orderBy("start")
    before = F.max("stop").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    marked = starts.withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1))
    islands = marked.withColumn("island", F.sum("new").over(inside)).groupBy("file", "segment", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")
    # Islands at a border go on in the neighbour if that begins at the border.
    border = islands.where((F.col("start") == F.col("segment") * segment) | (F.col("stop") == (F.col("segment") + 1) * segment))
    along = Window.partitionBy("file").orderBy("start")
    chained = border.withColumn("head", F.when(F.col("start") != F.coalesce(F.lag("stop").over(along), F.lit(-1)), F.col("start")))
    chained = chained.withColumn("first", F.max("head").over(along)).select("file", "segment", "start", "stop", "first")
    ends = chained.groupBy("file", "first").agg(F.max("stop").alias("last"))
    chained = chained.join(ends, ["file", "first"]).select("file", "segment", "start", "first", "last")
    return islands.join(chained, ["file", "segment", "start"], "left").select(
        "file", "segment", "start", "stop", F.coalesce("first", "start").alias("first"), F.coalesce("last", "stop").alias("last")
    )


def range_read_plan(ranges: DataFrame, request: int = REQUEST_BYTES, segment: int = SEGMENT_BYTES) -> DataFrame:
    """One row per request: ``file``, ``offset``, ``length``."""
    stretch = coalesced(ranges, segment)
    # Requests that begin in this segment, counted from the stretch's first byte.
    low = F.ceil((F.col("start") - F.col("first")) / request)
    high = F.ceil((F.col("stop") - F.col("first")) / request) - 1
    each = stretch.where(low <= high).select("file", "first", "last", F.explode(F.sequence(low, high)).alias("k"))
    offset = F.col("first") + F.col("k") * request
    return each.select("file", offset.alias("offset"), F.least(F.lit(request).cast("bigint"), F.col("last") - offset).alias("length"))
