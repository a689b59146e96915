"""Tables made of many files, stored in buckets: a batch's rows lie in folders of bounded number, a small map says which holds which file.

New files go to new buckets of about ``BUCKET_BYTES`` of text, after the last one has been filled up. So folders grow with the
bytes of a batch, however many files bring them. A file that comes again keeps its bucket, and only that bucket is rewritten,
with the rows of its other files as they were. Within a bucket rows are sorted by file, so a reader of one file skips
most of it by the statistics in the file footers.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.session import durable
from leadforge.sources.ledger import exists
from leadforge.sources.sinks import overwrite_partitions

FILE = ["folder", "file_name"]  # what names a file
MAP_SCHEMA = "folder string, file_name string, bytes bigint, bucket int, table_name string, batch_no string"
FILE_MAP, BUCKET = "file_map", "bucket"
BUCKET_BYTES = 512 << 20


def file_map(spark: SparkSession, target: str, table: str, batch_no: str) -> DataFrame:
    """The map's entries of one table and batch: file, size and bucket."""
    path = f"{target}/{FILE_MAP}"
    if not exists(spark, path):
        return spark.createDataFrame([], MAP_SCHEMA)
    return spark.read.schema(MAP_SCHEMA).parquet(path).filter((F.col("table_name") == table) & (F.col("batch_no") == batch_no))


def place(spark: SparkSession, files: DataFrame, target: str, table: str, batch_no: str, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(path, folder, file_name, bucket, reused) of a listing; new files are entered into the map.

    ``reused`` marks buckets that may hold rows already. The map is written before any row, so a load that is cut short
    finds its files in the same buckets again.
    """
    entries = file_map(spark, target, table, batch_no)
    listed = files.select("path", "bytes", *FILE).join(entries.select(*FILE, F.col(BUCKET).alias("held")), FILE, "left")
    filled = entries.groupBy(BUCKET).agg(F.sum("bytes").alias("bytes")).agg(F.max(F.struct(BUCKET, "bytes")).alias("last")).first()["last"]
    coming = listed.filter("held is null").agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    last = -1 if filled is None else filled[BUCKET]
    start = last if filled is not None and filled["bytes"] < bucket_bytes / 2 else last + 1
    spread = F.lit(start) + F.pmod(F.xxhash64(*FILE), F.lit(max(1, math.ceil(coming / bucket_bytes)))).cast("int")
    placed = durable(listed.withColumn(BUCKET, F.coalesce("held", spread)).withColumn("reused", F.col(BUCKET) <= last))
    entered = placed.filter("held is null").select(*FILE, "bytes", BUCKET, F.lit(table).alias("table_name"), F.lit(batch_no).alias("batch_no"))
    entered.hint("rebalance").write.mode("append").partitionBy("table_name", "batch_no").parquet(f"{target}/{FILE_MAP}")
    return placed.drop("held", "bytes")


def held_rows(spark: SparkSession, path: str, layout: T.StructType, outer: dict[str, str]) -> DataFrame:
    """The rows stored below the outer partitions, in the given layout."""
    here = [F.col(name) == value for name, value in outer.items()]
    return spark.read.schema(layout).parquet(path).filter(reduce(lambda a, b: a & b, here))


def _drop_folder(spark: SparkSession, path: str, levels: list[tuple[str, object]]) -> None:
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *[f"{name}={names.escapePathName(str(value))}" for name, value in levels]]))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def store_files(rows: DataFrame, placed: DataFrame, path: str, outer: dict[str, str]) -> None:
    """Replace the rows of the placed files below ``path``; ``rows`` has their bucket, ``outer`` the partitions above it.

    Buckets without earlier rows are simply written. Of the others the rows of files that do not come now are read and
    written again; a bucket that is left without rows is removed. Files and buckets are broadcast, so no rows are shuffled by them.
    """
    spark = rows.sparkSession
    partition, emptied = (*outer, BUCKET), []
    reused = placed.filter("reused").select(BUCKET).distinct()
    if exists(spark, path) and not reused.isEmpty():
        touched = held_rows(spark, path, rows.schema, outer).join(F.broadcast(reused), BUCKET, "left_semi").select(*rows.columns)
        rows = durable(touched.join(F.broadcast(placed.select(*FILE)), FILE, "left_anti").unionByName(rows))
        left = touched.select(BUCKET).distinct().join(rows.select(BUCKET).distinct(), BUCKET, "left_anti")
        emptied = [row[BUCKET] for row in left.toLocalIterator()]  # numbers of buckets that nothing is left of
    overwrite_partitions(rows, path, partition, within=tuple(FILE))
    for bucket in emptied:
        _drop_folder(spark, path, [*outer.items(), (BUCKET, bucket)])


def file_rows(spark: SparkSession, target: str, table: str, batch_no: str, folder: str, file_name: str) -> DataFrame:
    """The stored rows of one file: of the table, its bucket alone is read."""
    entries = file_map(spark, target, table, batch_no).filter((F.col("folder") == folder) & (F.col("file_name") == file_name))
    entry = entries.select(BUCKET).first()
    stored = stored_rows(spark, target, table, buckets=True)
    if entry is None:
        return stored.limit(0).drop(BUCKET)
    named = (F.col("batch_no") == batch_no) & (F.col(BUCKET) == entry[BUCKET])
    return stored.filter(named & (F.col("folder") == folder) & (F.col("file_name") == file_name)).drop(BUCKET)


def stored_rows(spark: SparkSession, target: str, table: str, *, buckets: bool = False) -> DataFrame:
    """A stored table's rows. Batch and table are read as the text they are, never as numbers or dates."""
    path = f"{target}/{table.lower()}"
    names = ("batch_no", "table_name")
    layout = [T.StructField(f.name, T.StringType() if f.name in names else f.dataType) for f in spark.read.parquet(path).schema]
    rows = spark.read.schema(T.StructType(layout)).parquet(path)
    return rows if buckets else rows.drop(BUCKET)
