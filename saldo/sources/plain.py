"""Result columns as the types every engine prints alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, whole numbers and flags as bigint, dates and times as ISO text."""
    out = []
    for field in df.schema:
        value, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            value = value.cast("bigint")
        elif isinstance(kind, T.DateType):
            value = value.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(value.alias(field.name))
    return df.select(*out)
