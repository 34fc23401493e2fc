"""Multi-row INSERT statements of bounded size, packed in order.

Rows go into a statement, in order, until the next one would make it longer
than ``max_bytes``.  Where a statement begins depends on all rows before it, yet
no task may see all rows: the work is a scan.

1. Rows are range-partitioned and sorted; each partition sums up its *cut
   function*: for every size of the statement that is open when it begins, the
   size of the one that is open when it ends, and how many were begun.  The
   function is a staircase with a step for each row that could be cut first, so
   at most as many as fit into one statement.
2. Neighbouring functions are composed, ``FAN`` at a time, until few are left
   (up), and the open size at each partition's start is handed back (down).
3. Every partition cuts its rows.  Statements that lie in one partition are
   ready; only the pieces at partition borders are shuffled and joined.

A row longer than ``max_bytes`` is a statement of its own, as it is for the
client; equal keys are ordered by the row's bytes.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.literals import values_tuple
from daybook.session import scratch_path

MAX_BYTES = 1_024_000  # fixed value: the client's largest generated statement
FAN = 64


class CutFunction(NamedTuple):
    """What rows do to an open statement of ``c`` bytes (0: none is open).

    ``upto`` (ascending): the i-th step holds for c up to ``upto[i]`` (and above
    the one before); ``out`` is the open size afterwards, ``begun`` the number of
    statements begun.  A first step with ``out`` -1 begins none: ``total`` is
    added to c.
    """

    total: int
    upto: np.ndarray
    out: np.ndarray
    begun: np.ndarray

    def __call__(self, c: int) -> tuple[int, int]:
        if not len(self.upto):  # no rows
            return c, 0
        if not c:
            return int(self.out[-1]), int(self.begun[-1])
        at = int(np.searchsorted(self.upto, c))
        return (c + self.total, 0) if self.out[at] < 0 else (int(self.out[at]), int(self.begun[at]))


def followers(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``sizes`` and, for a statement that begins at each row, the row
    where the next one begins."""
    sums = np.append(0, np.cumsum(sizes))
    after = np.searchsorted(sums, sums[:-1] + limit, side="right") - 1
    return sums, np.maximum(after, np.arange(len(sizes)) + 1)


def cut_function(sizes: np.ndarray, limit: int) -> CutFunction:
    """Of rows with sizes that count one separator each."""
    n = len(sizes)
    if not n:
        return CutFunction(0, *[np.zeros(0, np.int64)] * 3)
    sums, after = followers(sizes, limit)
    # Only rows that can be cut first are asked for, but their chains go on.
    last = min(n - 1, int(np.searchsorted(sums[1:], limit, side="right")))
    out, begun = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n - 1, -1, -1):
        j = after[i]
        out[i], begun[i] = (sums[n] - sums[i], 1) if j >= n else (out[j], begun[j] + 1)
    # Row i is cut first if c + sums[i] fits and c + sums[i + 1] does not.
    first = np.arange(last, -1, -1)
    upto = limit - sums[first]
    fits = limit - int(sums[n])
    keep = upto > max(fits, 0)
    upto, out, begun = upto[keep], out[first][keep], begun[first][keep]
    if fits > 0:
        upto, out, begun = np.append(fits, upto), np.append(-1, out), np.append(0, begun)
    # An open statement may be longer than the limit (one long row).
    upto[-1] = np.iinfo(np.int64).max
    return CutFunction(int(sums[n]), upto, out, begun)


def composed(functions: Sequence[CutFunction]) -> CutFunction:
    """The function of several row ranges, one after the other."""
    whole = functions[0]
    for f in functions[1:]:
        if not len(f.upto):
            continue
        if not len(whole.upto):
            whole = f
            continue
        cut = whole.out >= 0
        after = [f(int(c)) for c in whole.out[cut]]
        upto, out = whole.upto[cut], np.array([o for o, _ in after], np.int64)
        begun = whole.begun[cut] + np.array([b for _, b in after], np.int64)
        if not cut[0]:  # c + total meets the steps of f
            end = int(whole.upto[0])
            far = f.upto - whole.total
            far[-1] = end
            keep = (far > 0) & (np.append(0, far[:-1]) < end)
            upto, out, begun = np.append(np.minimum(far[keep], end), upto), np.append(f.out[keep], out), np.append(f.begun[keep], begun)
        whole = CutFunction(whole.total + f.total, upto, out, begun)
    return whole


_FUNCTION = "place int, total long, upto array<long>, out array<long>, begun array<long>"
_CARRY = "place int, open long, number long"


def _functions(batches) -> list[tuple[int, CutFunction]]:
    found = []
    for batch in batches:
        place, total, *lists = (batch.column(batch.schema.get_field_index(n)) for n in ("place", "total", "upto", "out", "begun"))
        for i in range(batch.num_rows):
            found.append((place[i].as_py(), CutFunction(total[i].as_py(), *[np.array(x[i].as_py(), np.int64) for x in lists])))
    return sorted(found, key=lambda f: f[0])


def _row(place: int, f: CutFunction) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([place], pa.int32()), pa.array([f.total], pa.int64()), *[pa.array([x.tolist()], pa.list_(pa.int64())) for x in f[1:]]],
        names=["place", "total", "upto", "out", "begun"],
    )


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _carries(functions: DataFrame, n: int) -> DataFrame:
    """For each of ``n`` places the open size and the statements begun before."""
    if n <= FAN:

        def scan(batches):
            rows, c, begun = [], 0, 0
            for place, f in _functions(batches):
                rows.append((place, c, begun))
                c, more = f(c)
                begun += more
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["place", "open", "number"])

        return _written(functions.repartitionById(1, F.lit(0)).mapInArrow(scan, _CARRY), "carries")
    groups = -(-n // FAN)

    def up(batches):
        found = _functions(batches)
        if found:
            yield _row(found[0][0] // FAN, composed([f for _, f in found]))

    group = F.floor(F.col("place") / FAN).cast("int")
    above = _carries(_written(functions.repartitionById(groups, group).mapInArrow(up, _FUNCTION), "cut-functions"), groups)

    def down(batches):
        rows, held = [], list(batches)
        given = {(r["place"] // FAN, r["open"], r["number"]) for b in held for r in b.select(["place", "open", "number"]).to_pylist()}
        if given:
            ((_, c, begun),) = given
            for place, f in _functions(held):
                rows.append((place, c, begun))
                c, more = f(c)
                begun += more
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["place", "open", "number"])

    handed = functions.join(above.select(F.col("place").alias("of"), "open", "number"), group == F.col("of")).drop("of")
    return _written(handed.repartitionById(groups, group).mapInArrow(down, _CARRY), "carries")


def insert_statements(
    df: DataFrame, table: str, columns: Sequence[str], order_by: Sequence[str], *,
    verb: str = "INSERT INTO", postfix: str = "", max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """One row per statement, numbered from 0: ``statement``, ``n_rows``,
    ``n_bytes`` and ``sql`` (the statement's bytes)."""
    spark = df.sparkSession
    prefix = f"{verb} {table} ({', '.join(columns)}) VALUES ".encode()
    suffix = postfix.encode()
    # A statement holds prefix, postfix and rows with a separator between.
    limit = max(1, max_bytes - len(prefix) - len(suffix) + 1)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [df[c].alias(f"k{i}") for i, c in enumerate(order_by)]
    rows = df.select(*keys, values_tuple(df, columns).alias("row"))
    ordered = rows.repartitionByRange(n, *[f"k{i}" for i in range(len(keys))], "row", F.monotonically_increasing_id())
    ordered = ordered.sortWithinPartitions(*[f"k{i}" for i in range(len(keys))], "row")
    # Written once: which rows a place has must not change between steps.
    placed = _written(ordered.select(F.spark_partition_id().alias("place"), F.monotonically_increasing_id().alias("at"), "row"), "ordered-rows")
    n = 1 + (placed.agg(F.max("place").alias("p")).head()["p"] or 0)

    def local(df: DataFrame) -> DataFrame:
        return df.repartitionById(n, "place").sortWithinPartitions("at")

    def summed(batches):
        place, sizes = None, []
        for batch in batches:
            if batch.num_rows:
                place = batch.column(0)[0].as_py()
                sizes.append(batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64))
        if place is not None:
            yield _row(place, cut_function(np.concatenate(sizes), limit))

    sized = placed.select("place", "at", (F.octet_length("row") + 1).alias("size"))
    carries = _carries(_written(local(sized).mapInArrow(summed, _FUNCTION), "cut-functions"), n)
    # A place's own carry comes first in its task.
    start = carries.select("place", F.lit(-1).cast("bigint").alias("at"), F.lit(None).cast("binary").alias("row"), "open", "number")
    both = placed.withColumns({"open": F.lit(None).cast("bigint"), "number": F.lit(None).cast("bigint")}).unionByName(start)

    def cut(batches):
        """Pieces of statements; the first of a place may go on one before,
        the last may go on."""
        c, number, held, place, first = 0, -1, [], None, False

        def piece(whole: bool):
            columns = ([number], [place], [len(held)], [b",".join(held)], [whole])
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.bool_()), strict=True)], names=["statement", "place", "n_rows", "body", "whole"])

        for batch in batches:
            for row, open_, before, at in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("row", "open", "number", "place")), strict=True):
                if row is None:
                    c, number, place, first = open_, before - 1, at, open_ > 0
                    continue
                size = len(row) + 1
                if not c or c + size > limit:
                    if held:
                        yield piece(not first)
                        first = False
                    elif first:
                        first = False
                    held, c, number = [], 0, number + 1
                held.append(row)
                c += size
        if held:
            yield piece(False)

    pieces = _written(local(both).mapInArrow(cut, "statement long, place int, n_rows long, body binary, whole boolean"), "pieces")
    border = pieces.where(~F.col("whole")).groupBy("statement").agg(F.sum("n_rows").alias("n_rows"), F.sort_array(F.collect_list(F.struct("place", "body"))).alias("p"))
    comma = F.encode(F.lit(","), "UTF-8")
    joined = F.aggregate("p", F.lit(None).cast("binary"), lambda acc, p: F.coalesce(F.concat(acc, comma, p["body"]), p["body"]))
    done = pieces.where("whole").select("statement", "n_rows", "body").unionByName(border.select("statement", "n_rows", joined.alias("body")))
    sql = F.concat(F.lit(prefix), F.col("body"), F.lit(suffix))
    return done.select("statement", "n_rows", sql.alias("sql")).select("statement", "n_rows", F.octet_length("sql").cast("bigint").alias("n_bytes"), "sql")
