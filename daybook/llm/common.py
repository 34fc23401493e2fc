"""Helpers shared by the operators: tables, written intermediates, and word
hashing of UTF-8 text in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Bytes of text handled at once inside a task; a longer text is handled alone.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, *split_by: str, path: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, or at ``path``, read back;
    with columns to split by, every task writes a file for each of their values
    it holds.

    Later steps read the files, so a lost executor never re-runs what is
    before them, and tasks that are dealt anew see the same rows.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    (df.write.partitionBy(*split_by) if split_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_hash(text: Column) -> Column:
    """64-bit hash of a text; null keeps apart from the empty text."""
    return F.xxhash64(text.isNull(), text)


def mix(h: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser over uint64 (wraps by design)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHasher:
    """Words ``[0-9a-z and bytes from 0x80]+`` of texts, A-Z lower-cased, as
    64-bit hashes.  Equal words have equal hashes everywhere."""

    _P = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        lut = np.zeros(256, np.int8)
        lut[0x30:0x3A] = 1
        lut[0x61:0x7B] = 1
        lut[0x80:] = 1
        self._word = lut
        self._pow = self._inv = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self._pow) < n:
            size = max(n, STEP_BYTES + (1 << 16))
            for name, p in (("_pow", self._P), ("_inv", pow(self._P, -1, 1 << 64))):
                run = np.full(size, p, np.uint64)
                run[0] = 1
                setattr(self, name, np.cumprod(run))

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and the number of words per text."""
        sizes = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
        data = np.frombuffer(b"\0".join([t or b"" for t in texts] + [b""]).lower(), np.uint8)
        edge = np.diff(self._word[data], prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self._powers(len(data) + 1)
        upto = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * self._pow[: len(data)], out=upto[1:])
        words = mix((upto[ends] - upto[starts]) * self._inv[starts])
        bounds = np.cumsum(sizes)
        counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
        return words, counts


def steps(texts: list[bytes | None], limit: int = STEP_BYTES):
    """Index ranges of consecutive texts of about ``limit`` bytes."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or b"") + 1
        if held >= limit:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)
