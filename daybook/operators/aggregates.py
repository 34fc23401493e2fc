"""Aggregates of the result check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.filters import REPORT_DATE_COLUMN


def daily_counts(snapshot: DataFrame, day_col: str = REPORT_DATE_COLUMN) -> DataFrame:
    """Rows per report day, ordered by day (partial + final aggregation)."""
    return snapshot.groupBy(day_col).agg(F.count(F.lit(1)).alias("count")).orderBy(day_col)


def daily_counts_sql(spark, view: str, first, last, day_col: str = REPORT_DATE_COLUMN) -> DataFrame:
    """The same through the SQL surface, ordered by ordinal (``ORDER BY 1``)."""
    return spark.sql(
        f"SELECT {day_col}, count(*) AS count FROM {view} "
        f"WHERE {day_col} >= :first AND {day_col} <= :last GROUP BY {day_col} ORDER BY 1",
        args={"first": first, "last": last},
    )
