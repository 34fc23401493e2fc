"""Per-context cache of built Column expressions.

Building a Column tree from Python costs one JVM call per node; the report
rules are thousands of nodes.  The trees are immutable and refer to columns
by name, so a tree built once is reused by every DataFrame of the same Spark
context (keyed by the context, so a new context never sees stale objects).
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

from pyspark import SparkContext

T = TypeVar("T")
_CACHE: dict[tuple, object] = {}


def _context_key() -> tuple | None:
    sc = SparkContext._active_spark_context  # None for a remote (Connect) session
    # application id and start time identify a context for good (an object id
    # could be reused after a context is stopped)
    return None if sc is None else (sc.applicationId, sc.startTime)


def cached(key: Hashable, build: Callable[[], T]) -> T:
    k = (_context_key(), key)
    if k not in _CACHE:
        _CACHE[k] = build()
    return _CACHE[k]  # type: ignore[return-value]
