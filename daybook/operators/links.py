"""Symbolic links followed to their final targets, for a whole table of links.

Every link points to the path its target names (relative targets start from
the link's folder; ``.``, ``..`` and empty parts are taken out).  Pointers are
doubled: in each round all links that still point to a link take over that
link's pointer, so chains of n links need log2(n) rounds, each one join that is
written to the shared folder.  When a round settles no further link, none of the
others ever ends: on the way from any link to its end every smaller distance
occurs, so what is left leads into a cycle.

Defined results: a link whose final path is no given file is ``broken``; one
that leads into a cycle is ``cycle`` and has neither final path nor hops; of
several targets of one path the least counts; links with a null path or target
are left out; links inside a path (folders that are links) are not followed;
``..`` at the root stays at the root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.session import scratch_path


def normalised(path: Column) -> Column:
    """An absolute path without ``.``, ``..`` and empty parts."""
    none = F.array().cast("array<string>")
    parts = F.aggregate(
        F.split(path, "/"), none,
        lambda kept, p: F.when(p.isin("", "."), kept).when(p == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(p))),
    )
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def target_path(path: Column, target: Column) -> Column:
    """Where a link points: its target, from its own folder if relative."""
    folder = F.regexp_extract(path, r"(?s)^(.*/)[^/]*$", 1)
    return normalised(F.when(target.startswith("/"), target).otherwise(F.concat(folder, target)))


def _written(df: DataFrame, name: str) -> DataFrame:
    at = scratch_path(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def resolve_links(links: DataFrame, files: DataFrame) -> DataFrame:
    """From ``links`` (path, target) and ``files`` (path) one row per link:
    ``path``, ``target`` (the path it names), ``final``, ``hops`` and
    ``status`` (``ok``, ``broken`` or ``cycle``)."""
    named = links.where("path IS NOT NULL AND target IS NOT NULL").select(normalised(F.col("path")).alias("path"), target_path(F.col("path"), F.col("target")).alias("target"))
    first = named.groupBy("path").agg(F.min("target").alias("target"))
    known = first.select(F.col("path").alias("link"))
    state = first.join(known, F.col("target") == F.col("link"), "left").select("path", "target", F.col("target").alias("to"), F.lit(1).cast("bigint").alias("hops"), F.col("link").isNotNull().alias("on"))
    state = _written(state, "links")
    left = state.where("on").count()
    while left:
        ahead = state.select(F.col("path").alias("link"), F.col("to").alias("next"), F.col("hops").alias("more"), F.col("on").alias("still"))
        moved = state.where("on").join(ahead, F.col("to") == F.col("link"))
        moved = moved.select("path", "target", F.col("next").alias("to"), (F.col("hops") + F.col("more")).alias("hops"), F.col("still").alias("on"))
        state = _written(state.where("NOT on").unionByName(moved), "links")
        before, left = left, state.where("on").count()
        if left == before:
            break
    there = files.select(normalised(F.col("path")).alias("file")).where("file IS NOT NULL").distinct()
    done = state.join(there, F.col("to") == F.col("file"), "left")
    ends = ~F.col("on")
    return done.select(
        "path", "target", F.when(ends, F.col("to")).alias("final"), F.when(ends, F.col("hops")).alias("hops"),
        F.when(~ends, "cycle").when(F.col("file").isNull(), "broken").otherwise("ok").alias("status"),
    )
