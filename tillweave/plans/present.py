"""Plain result columns for reports: dates as ISO text, decimals as doubles, whole numbers as bigint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def present(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, WHOLE):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, TIMES):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)
