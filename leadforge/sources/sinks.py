"""Writing tables and exchange files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_FILE = 30_000_000
# Partitions that a task writes side by side; a task that meets more sorts its rows first.
OPEN_WRITERS, OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters", 4
# Shuffled bytes that are put together for a task whose rows become far wider after the shuffle.
TASK_BYTES, FEW_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def unsorted_write(spark: SparkSession):
    """Partitioned writes in here keep a few files open instead of sorting all rows of a task by partition in memory."""
    return _setting(spark, OPEN_WRITERS, str(OPEN_FILES))


def narrow_tasks(spark: SparkSession):
    """Jobs in here put less of a shuffle together for a task, so that wide rows made of it are sorted in memory and not spilled."""
    return _setting(spark, TASK_BYTES, FEW_BYTES)


def with_audit(df: DataFrame, batch_no: str, as_of: dt.date) -> DataFrame:
    return df.withColumns({"batch_no": F.lit(batch_no), "created_at": F.lit(as_of)})


def in_table_order(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns by name in table order; those the frame lacks are NULL, others are dropped."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[F.col(have[c.lower()]).alias(c) if c.lower() in have else F.lit(None).cast("string").alias(c) for c in columns]
    )


def append_by_name(df: DataFrame, path: str, columns: list[str], partition_by: tuple[str, ...] = ("batch_no",)) -> None:
    writer = in_table_order(df, columns).write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.partitionBy(*partition_by).parquet(path)


def in_table_layout(df: DataFrame, ddl: str) -> DataFrame:
    """Columns by name, order and type of a stored table; those the frame lacks are NULL."""
    target = T.StructType.fromDDL(ddl)
    named = in_table_order(df, target.fieldNames())
    return named.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = ("batch_no",), within: tuple[str, ...] = (), *, gather: bool = True
) -> None:
    """Replace only the partitions that ``df`` holds, so that a repeated write changes nothing.

    ``df`` must not read from ``path``; pass a frame made durable first where it does. Rows are gathered by
    partition before the write, so that few files arise; a partition that is far larger than the others is
    split again at run time. Files are sorted by the columns ``within``; without these nothing is sorted, as a
    gathered task holds few partitions. A frame that holds one partition needs no gathering, and wide rows
    are better not shuffled for it: ``gather=False`` writes a file per task.
    """
    gathered = df.hint("rebalance", *[F.col(c) for c in partition_by]) if gather else df
    if within:
        gathered = gathered.sortWithinPartitions(*partition_by, *within)
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*partition_by)
    if within:
        return writer.parquet(path)
    with unsorted_write(df.sparkSession):
        writer.parquet(path)


def export_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).options(header=True, sep=sep).csv(path)


def export_by_name(frames: list[DataFrame], path: str, name: str, sep: str = ",") -> None:
    """Delimited files of many names below ``path``, a folder per value of the column ``name``; one write per layout.

    The first write replaces all that a former run left, so a run that was cut short is simply repeated.
    """
    for mode, df in zip(["overwrite"] + ["append"] * len(frames), frames):
        writer = df.hint("rebalance", F.col(name)).write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE)
        writer.options(header=True, sep=sep).partitionBy(name).csv(path)


def export_summary(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def batch_slice(spark: SparkSession, path: str, batch_no: str) -> DataFrame:
    """One batch of a stored table; only that partition is read."""
    return spark.read.option("basePath", path).parquet(path).filter(F.col("batch_no") == batch_no)
