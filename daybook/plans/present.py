"""Engine-neutral presentation of a result for cross-engine comparison.

Decimals become text with all digits of their scale, dates ISO ``yyyy-MM-dd``
text, day-time intervals their signed microseconds and binary values upper-case
hex; everything else is left as is.  Applied only at the very end of a registered query (a projection,
no extra stage); the library functions keep their typed columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.decode import interval_micros


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = F.replace(F.format_number(c, field.dataType.scale), F.lit(","), F.lit(""))
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.DayTimeIntervalType):
            c = interval_micros(c)
        elif isinstance(field.dataType, T.BinaryType):
            c = F.hex(c)
        cols.append(c.alias(field.name))
    return df.select(*cols)
