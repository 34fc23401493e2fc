"""Configuration records: a group key with arbitrary attributes.

The original reads one row per group from a key-value store and folds its
``(name, value)`` attribute list into a dict.  Here a long table
``(group, name, value)`` is folded for all groups in one grouped aggregate;
each group holds only its own attributes, so groups stay small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def config_lookup(long: DataFrame, order_col: str | None = None) -> DataFrame:
    """``group -> map(name -> value)`` with names sorted.

    Copies are collapsed first: one value per (group, name), by a partially
    aggregated ``groupBy``.  A repeated name keeps the value of the greatest
    ``order_col`` (the last one, as the original's dict did); without an order
    there is no last one, so different values of one name raise an error.  The
    fold into a map then only sees each group's distinct attribute names,
    however many copies a hot group has."""
    if order_col:
        value = F.max(F.struct(F.col(order_col), F.col("value")))["value"]
    else:
        clash = F.concat(F.lit("conflicting values of attribute "), F.col("name"), F.lit(" in group "), F.col("group"))
        value = F.when(F.min("value") < F.max("value"), F.raise_error(clash).cast("string")).otherwise(F.max("value"))
    attrs = long.groupBy("group", "name").agg(value.alias("value"))
    entries = F.array_sort(F.collect_list(F.struct(F.col("name"), F.col("value"))))
    return attrs.groupBy("group").agg(F.map_from_entries(entries).alias("attributes"))


def config_of(long: DataFrame, group: str, order_col: str | None = None) -> DataFrame:
    """The attributes of one group (filter pushed below the aggregate)."""
    return config_lookup(long.where(F.col("group") == group), order_col)


def long_config(customer: DataFrame) -> DataFrame:
    """Customer attributes as a long config table: group = customer key."""
    return customer.select(
        F.col("c_custkey").cast("string").alias("group"),
        F.explode(
            F.create_map(
                F.lit("name"), F.col("c_name"),
                F.lit("nation"), F.col("c_nationkey").cast("string"),
                F.lit("segment"), F.col("c_mktsegment"),
                F.lit("balance"), F.col("c_acctbal").cast("decimal(18,2)").cast("string"),
            )
        ).alias("name", "value"),
    )
