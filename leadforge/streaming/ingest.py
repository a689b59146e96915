"""Incremental file ingest: new bureau files are picked up by a file stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from leadforge.plans.bureau import load_table
from leadforge.session import durable
from leadforge.sources.files import listing

# What a stream of files carries; the content itself is never read through it.
FILES = "path string, modificationTime timestamp, length bigint, content binary"


def incremental_ingest(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    table: str,
    bureau: str,
    batch_no: str,
    as_of: dt.date,
    *,
    sep: str = "|",
) -> StreamingQuery:
    """Load the files that arrived since the last run into ``target``/``table``, then stop.

    The stream carries the names of new files; each micro-batch loads its files as a batch does, bound by header, bad
    rows stored apart. The stream's checkpoint replaces a ledger of finished files. A micro-batch that is repeated after a
    failure replaces the partitions of its own files.
    """
    arriving = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True).load(folder)

    def load(micro_batch: DataFrame, _: int) -> None:
        files = durable(listing(micro_batch, folder))
        load_table(micro_batch.sparkSession, files, target, table, bureau, batch_no, as_of, sep=sep)

    return (
        arriving.select("path", "length").writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
