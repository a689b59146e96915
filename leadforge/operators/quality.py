"""Data-quality checks that answer with rows instead of raising."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL count and verdict of each required column, all in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return counts.select(F.inline(pairs)).withColumn("is_valid", F.col("null_count") == 0)


def threshold_report(df: DataFrame, failed: Column, threshold: float, check: str) -> DataFrame:
    """One row: failed share against the threshold; an empty frame passes."""
    counts = df.agg(F.count(F.lit(1)).alias("total_count"), F.count_if(failed).alias("failed_count"))
    rate = F.when(F.col("total_count") > 0, F.col("failed_count") / F.col("total_count")).otherwise(0.0)
    return counts.select(
        F.lit(check).alias("check_name"), "failed_count", "total_count", rate.alias("failure_rate")
    ).withColumn("is_valid", F.col("failure_rate") <= threshold)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count: a check before joins that must not multiply rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
