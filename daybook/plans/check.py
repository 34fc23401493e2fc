"""Result check: the notification message built from daily counts, the
partner's result text and the statistic document.

All inputs are small by construction (days of a window, keys of one
statistic object, one result file), but the message is still built as one
grouped aggregate in executors, never by looping over collected rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.filters import REPORT_DATE_COLUMN

# The opening line; a job passes its own.
INTRO = "Results of the last report.<br /><br />"
# The notification's HTML layout.
TABLE_OPEN = "<table style='width: 30%;' border='2' cellpadding='1'>"
TABLE_HEAD = "<tr><th>tanggal</th> <th>count</th></tr>"
TABLE_CLOSE = "</table>"
BLOCK_OPEN = "<pre><div style='padding-left:2em'>"
BLOCK_CLOSE = "</div></pre></p>"


def _section(parts: Column, section: int) -> Column:
    """The texts of one section of the sorted (section, order, text) array,
    concatenated in order."""
    return F.array_join(F.transform(F.filter(parts, lambda p: p["section"] == section), lambda p: p["s"]), "")


def summary_message(
    counts: DataFrame,
    result_name: Column,
    result_text: DataFrame,
    stat_name: Column,
    stat: DataFrame,
    intro: str = INTRO,
) -> DataFrame:
    """One row ``message``.

    ``counts``: (tgl_pelaporan_data, count); ``result_text``: one row with
    ``text``; ``stat``: (pos, key, value) pairs, NULL key for an empty object.
    The three inputs are tagged and unioned, then folded by one aggregate."""
    day = F.col(REPORT_DATE_COLUMN)
    count_rows = counts.select(
        F.lit(1).alias("section"),
        F.date_format(day, "yyyy-MM-dd").alias("o"),
        F.concat(F.lit("<tr><td>"), F.date_format(day, "yyyy-MM-dd"), F.lit("</td> <td>"),
                 F.col("count").cast("string"), F.lit("</td></tr>")).alias("s"),
    )
    text_rows = result_text.select(F.lit(2).alias("section"), F.lit("").alias("o"), F.col("text").alias("s"))
    stat_rows = stat.where(F.col("key").isNotNull()).select(
        F.lit(3).alias("section"),
        F.lpad(F.col("pos").cast("string"), 10, "0").alias("o"),
        F.concat(F.col("key"), F.lit(": "), F.coalesce(F.col("value"), F.lit("None")), F.lit("<br/>")).alias("s"),
    )
    parts = count_rows.unionByName(text_rows).unionByName(stat_rows)
    # one bounded collection, sorted by (section, order), split by section
    folded = parts.agg(F.array_sort(F.collect_list(F.struct("section", "o", "s"))).alias("parts")).select(
        _section(F.col("parts"), 1).alias("table_rows"),
        _section(F.col("parts"), 2).alias("result_text"),
        _section(F.col("parts"), 3).alias("stat_rows"),
    )
    message = F.concat(
        F.lit(intro + TABLE_OPEN + TABLE_HEAD),
        F.col("table_rows"),
        F.lit(TABLE_CLOSE + "<p>"),
        result_name,
        F.lit(":<br /> " + BLOCK_OPEN),
        F.col("result_text"),
        F.lit(BLOCK_CLOSE + "<p>"),
        stat_name,
        F.lit(":<br />" + BLOCK_OPEN),
        F.col("stat_rows"),
        F.lit(BLOCK_CLOSE),
    )
    return folded.select(message.alias("message"))
