"""Which files have been loaded: a small append-only table instead of a status file."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "batch string, folder string, file_name string, row_count bigint, loaded_on date"


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was written at a path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at a path, empty while nothing was written there."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(path) if exists(spark, path) else empty_ledger(spark)


def _names(files: DataFrame) -> DataFrame:
    """Folder and name of each file, and its batch; entries without a folder are known by their batch."""
    folder = F.coalesce("folder", "batch") if "folder" in files.columns else F.col("batch")
    return files.select("batch", folder.alias("folder"), "file_name").distinct()


def unprocessed(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    return inventory.join(_names(ledger).drop("batch"), ["folder", "file_name"], "left_anti")


def ledger_rows(loaded: DataFrame, as_of: dt.date) -> DataFrame:
    """Ledger entries of loaded files (batch, folder, file_name, row_count)."""
    return loaded.select("batch", "folder", "file_name", F.col("row_count").cast("bigint").alias("row_count"), F.lit(as_of).alias("loaded_on"))


def reset_batch(ledger: DataFrame, batch: str) -> DataFrame:
    return ledger.filter(F.col("batch") != batch)


def batch_status(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """Success when the listed files are exactly the loaded ones, per batch."""
    listed = _names(inventory).withColumn("listed", F.lit(1))
    loaded = _names(ledger).withColumn("loaded", F.lit(1))
    both = listed.join(loaded, ["batch", "folder", "file_name"], "full").fillna(0, ["listed", "loaded"])
    return both.groupBy("batch").agg(
        F.sum("listed").alias("files_listed"),
        F.sum("loaded").alias("files_loaded"),
        F.when(F.min(F.col("listed") + F.col("loaded")) == 2, "success").otherwise("failed").alias("final_status"),
    )
