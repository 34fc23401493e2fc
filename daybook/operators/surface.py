"""Query surface: bound parameters, paging and unique column names.

* ``param_query``: client-style placeholders (``%s`` positional, ``%(name)s``
  named, ``%%`` a literal percent) become Spark parameter markers (``?`` /
  ``:name``), and values are bound by ``spark.sql(text, args=...)``: no value
  is ever pasted into SQL text.
* ``page``: a page of rows in a total order.  Spark plans
  ``orderBy + offset + limit`` as a per-task top-(offset + size) followed by a
  merge, so memory is bounded by the page end, not by the table.
  ``page_after`` pages by key instead (bounded by the page size alone).
* ``dedupe_columns``: after a join, a repeated column name keeps its name for
  the first column; later ones become ``table.name`` and further clashes are
  numbered.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PLACEHOLDER = re.compile(r"%(?:\((\w+)\))?([s%])")


def convert_placeholders(text: str) -> tuple[str, str | None]:
    """Client placeholders to Spark markers; returns (text, style) where
    style is ``named``, ``positional`` or None.  Mixing both is an error."""
    styles = set()

    def repl(m: re.Match) -> str:
        name, kind = m.group(1), m.group(2)
        if kind == "%":
            return "%"
        styles.add("named" if name else "positional")
        return f":{name}" if name else "?"

    out = _PLACEHOLDER.sub(repl, text)
    if len(styles) > 1:
        raise ValueError("placeholders must be all named or all positional")
    return out, (styles.pop() if styles else None)


def param_query(
    spark: SparkSession,
    text: str,
    args: Mapping[str, object] | Sequence[object] | None = None,
    **frames: DataFrame,
) -> DataFrame:
    """Run client-style parameterised SQL.  ``frames`` are DataFrames referred
    to as ``{name}`` in the text."""
    sql, style = convert_placeholders(text)
    if style == "named" and not isinstance(args, Mapping):
        raise TypeError("named placeholders need a mapping of values")
    if style == "positional" and (isinstance(args, Mapping) or args is None):
        raise TypeError("positional placeholders need a sequence of values")
    return spark.sql(sql, args=(dict(args) if style == "named" else list(args)) if style else None, **frames)


def page(df: DataFrame, order: Sequence[str | Column], offset: int, size: int) -> DataFrame:
    """Rows ``offset .. offset + size - 1`` of ``df`` in ``order`` (which must
    be a total order, e.g. end with a unique key)."""
    if offset < 0 or size < 0:
        raise ValueError("offset and size must be >= 0")
    return df.orderBy(*order).offset(offset).limit(size)


def page_after(df: DataFrame, key: str, last, size: int) -> DataFrame:
    """Keyset paging: the ``size`` rows after key value ``last`` (None for the
    first page) in ascending order of a unique ``key``.  Memory per task is
    bounded by ``size`` however deep the page, and the key filter can be
    pushed into the scan; ``page`` (offset based) keeps offset + size rows."""
    if size < 0:
        raise ValueError("size must be >= 0")
    rows = df if last is None else df.where(F.col(key) > F.lit(last))
    return rows.orderBy(key).limit(size)


def unique_names(names: Sequence[str], tables: Sequence[str]) -> list[str]:
    """First occurrence keeps the name; later ones ``table.name``; clashes of
    those get ``_2``, ``_3``, ..."""
    if len(names) != len(tables):
        raise ValueError("one table per column")
    seen: set[str] = set()
    out = []
    for name, table in zip(names, tables):
        candidate = name if name not in seen else f"{table}.{name}"
        base, k = candidate, 2
        while candidate in seen:
            candidate = f"{base}_{k}"
            k += 1
        seen.add(candidate)
        out.append(candidate)
    return out


def dedupe_columns(df: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Rename ``df``'s columns positionally (``toDF``), so repeated names
    from a join become addressable."""
    return df.toDF(*unique_names(df.columns, tables))


def join_unique(
    parts: Sequence[tuple[str, DataFrame]], conditions: Sequence[Column], how: str = "inner"
) -> DataFrame:
    """Join ``(table, frame)`` parts left to right and make names unique."""
    out, tables = parts[0][1], [parts[0][0]] * len(parts[0][1].columns)
    for (table, frame), cond in zip(parts[1:], conditions):
        out = out.join(frame, cond, how)
        tables += [table] * len(frame.columns)
    return dedupe_columns(out, tables)
