"""Plain column types for comparing results across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    """Money and ratios as doubles of six decimals, counts as bigint, dates and lists as text."""
    columns = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("int").cast("bigint")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = c.cast("date").cast("string")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c, "|")
        columns.append(c.alias(f.name))
    return df.select(*columns)
