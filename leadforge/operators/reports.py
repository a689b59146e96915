"""Load reports: what was read, what was stored."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Standard table names, in the order in which a file name is folded into them.
STANDARD_NAMES = (
    "ADDRESS", "AR", "EMAIL", "ENQ", "ID", "NAME_DOB", "PHONE", "SCORE", "EMPLOYMENT", "FINTECH_ENQUIRIES",
    "PROPENSITY_SCORE",
)
# Tables of each bureau in routing order.
EXPERIAN_TABLES = ("ADDRESS", "AR", "EMAIL", "ENQ", "ID", "NAME_DOB", "PHONE", "SCORE")
EQUIFAX_TABLES = ("PII", "AR", "ENQ")


def route(file_name: Column, tables: tuple[str, ...], *, whole_words: bool = False) -> Column:
    """First table whose name occurs in the file name, else NULL.

    ``whole_words`` asks for the name between non-letters, so that ``march_score.txt`` is not an AR file.
    """
    lowered = F.lower(file_name)
    chain = F
    for table in tables:
        if whole_words:
            hit = lowered.rlike(rf"(^|[^a-z]){table.lower()}([^a-z]|$)")
        else:
            hit = F.contains(lowered, F.lit(table.lower()))
        chain = chain.when(hit, table)
    return chain.otherwise(None)


def standard_file_name(file_name: Column) -> Column:
    """The standard name that a file name contains, else the name itself."""
    return F.coalesce(route(file_name, STANDARD_NAMES), file_name)


def load_report(results: DataFrame) -> DataFrame:
    """Files, rows read, rows stored and rows dropped per standard name, batch and status; of those dropped, the bad rows
    where the results count them."""
    bad = [F.sum("bad_count").alias("bad_rows")] if "bad_count" in results.columns else []
    named = results.withColumn("file_name", standard_file_name(F.col("file_name")))
    return named.groupBy("file_name", "batch", "status").agg(
        F.count(F.lit(1)).alias("nnr_of_files"),
        F.sum("original_count").alias("original_count"),
        F.sum("final_count").alias("final_count"),
        F.sum(F.col("original_count") - F.col("final_count")).alias("duplicates_and_nulls"),
        *bad,
    )


def stored_counts(tables: dict[str, DataFrame], batch: str | None = None) -> DataFrame:
    """Stored rows per table and batch."""
    counted = []
    for name, df in tables.items():
        chosen = df if batch is None else df.filter(F.col("batch_no") == batch)
        counted.append(
            chosen.groupBy(F.lit(name).alias("file_name"), F.col("batch_no").alias("batch"))
            .agg(F.count(F.lit(1)).alias("stored_count"))
        )
    return reduce(lambda a, b: a.unionByName(b), counted).distinct()


def merged_report(report: DataFrame, stored: DataFrame) -> DataFrame:
    return report.join(stored, ["file_name", "batch"], "left")
