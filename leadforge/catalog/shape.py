"""Output shaping that keeps results comparable across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def comparable(df: DataFrame) -> DataFrame:
    """Decimals and ratios as rounded doubles, dates as ISO text; all else unchanged."""
    columns = []
    for field in df.schema.fields:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.DecimalType) and field.dataType.scale <= 4:
            name = f"cast({name} as double)"
        elif isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            name = f"round(cast({name} as double), 4)"
        elif isinstance(field.dataType, T.DateType):
            name = f"date_format({name}, 'yyyy-MM-dd')"
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            name = f"cast({name} as bigint)"
        columns.append(f"{name} as `{field.name}`")
    return df.selectExpr(*columns)


def dbl(expression: str) -> str:
    """DuckDB twin of the decimal rule above."""
    return f"round(cast({expression} as double), 4)"


def day(expression: str) -> str:
    """DuckDB twin of the date rule above."""
    return f"strftime({expression}, '%Y-%m-%d')"


def big(expression: str) -> str:
    return f"cast({expression} as bigint)"
