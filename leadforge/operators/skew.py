"""Joins on keys that may hold a large share of the rows.

Adaptive execution sees the sizes of a join's shuffled partitions and reads a skewed one of the left side in several tasks, each with
the other side's matching partition; rows with a NULL key, which all meet in one partition of an outer join, are split the same
way. No pass over the data is needed to find heavy keys. What these functions add is the order of columns and reduced right sides,
which keep the copied partitions small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equi_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """The join on ``keys`` with the left columns first; a key column is the left one, so its split side leads."""
    rest = [c for c in right.columns if c not in keys] if how not in ("left_semi", "left_anti") else []
    return left.join(right, keys, how).select(*left.columns, *rest)


def flag_in(left: DataFrame, right: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """``left`` with a boolean column: does its key occur in ``right``? NULL keys never do."""
    present = right.select(*keys).dropna().distinct().withColumn(flag, F.lit(True))
    return equi_join(left, present, keys, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
