"""Stage 3 end to end: bureau files to tables, lender layouts and reports."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge.operators import cleaning as C
from leadforge.operators.lender_views import LENDERS, lender_view
from leadforge.operators.reports import EQUIFAX_TABLES, EXPERIAN_TABLES, route
from leadforge.session import durable
from leadforge.sources import files as SF
from leadforge.sources import ledger as LG
from leadforge.sources.filemap import BUCKET, BUCKET_BYTES, FILE, held_rows, place, store_files, stored_rows
from leadforge.sources.schemas import BUREAUS
from leadforge.sources.sinks import export_delimited, with_audit

RESULT_SCHEMA = "batch string, folder string, file_name string, original_count bigint, bad_count bigint, final_count bigint, status string"
TABLES = {"experian": EXPERIAN_TABLES, "equifax": EQUIFAX_TABLES}
BAD_ROWS = "bad_rows"


def routed(inventory: DataFrame, bureau: str, *, whole_words: bool = False) -> DataFrame:
    return inventory.withColumn("table_name", route(F.col("file_name"), TABLES[bureau], whole_words=whole_words))


def load_table(
    spark: SparkSession,
    files: DataFrame,
    target: str,
    table: str,
    bureau: str,
    batch_no: str,
    as_of: dt.date,
    *,
    sep: str = "|",
    heads: DataFrame | None = None,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Load a listing's files into one table below ``target``; returns rows read, bad and stored per file.

    Text is parsed once, into the shared folder; cleaning and counts read that. Rows are stored by batch and bucket (see
    ``sources.filemap``), rows with a wrong number of cells as text below ``bad_rows`` in the same buckets. A repeated load
    of a file replaces its rows, and rewrites its bucket only.
    """
    path = f"{target}/{table.lower()}"
    placed = place(spark, files, target, table, batch_no, bucket_bytes)
    landed = durable(SF.scan_rows(spark, files, BUREAUS[bureau][table], sep=sep, heads=heads))
    # A row per file, as in every listing: broadcast, since a shuffle by file would put all rows of a file in one task.
    named = landed.join(F.broadcast(placed.select(F.col("path").alias("file_path"), *FILE, BUCKET)), "file_path")
    good = named.filter(F.col(SF.BAD).isNull()).drop("file_path", SF.BAD)
    cleaned = with_audit(C.clean_bureau_table(good, table, bureau), batch_no, as_of)
    store_files(cleaned, placed, path, {"batch_no": batch_no})
    bad = named.filter(F.col(SF.BAD).isNotNull()).select(F.col(SF.BAD).alias("line"), *FILE, BUCKET)
    bad = with_audit(bad.withColumn("table_name", F.lit(table)), batch_no, as_of)
    store_files(bad, placed, f"{target}/{BAD_ROWS}", {"batch_no": batch_no, "table_name": table})
    read = named.groupBy(*FILE).agg(F.count(F.lit(1)).alias("original_count"), F.count(SF.BAD).alias("bad_count"))
    # Of what was written now, the columns that name the file are read back.
    stored = held_rows(spark, path, cleaned.schema, {"batch_no": batch_no}).join(F.broadcast(placed.select(BUCKET).distinct()), BUCKET, "left_semi")
    kept = stored.groupBy(*FILE).agg(F.count(F.lit(1)).alias("final_count"))
    counted = files.select("batch", *FILE).join(read, FILE, "left").join(kept, FILE, "left")
    filled = counted.fillna(0, ["original_count", "bad_count", "final_count"])
    usable = F.col("original_count") > F.col("bad_count")
    return filled.withColumn("status", F.when(usable, "Processed").otherwise("Failed"))


def bureau_ingest(
    spark: SparkSession,
    inventory: DataFrame,
    ledger_path: str,
    target: str,
    batch_no: str,
    bureau: str,
    as_of: dt.date,
    *,
    lender: str | None = None,
    lender_target: str | None = None,
    whole_words: bool = False,
) -> DataFrame:
    """Load the new files of one batch's inventory, one write per table; returns the load results per file.

    A file is known by its folder and name. A repeated load of a file replaces its own rows, and the lender export is
    replaced by the batch as stored so far, so a run that is cut short can simply be run again. Files already in the ledger
    are left out. The number of writes grows with the tables of the bureau, not with the files.
    """
    ledger = LG.read_ledger(spark, ledger_path)
    fresh = durable(LG.unprocessed(routed(inventory, bureau, whole_words=whole_words), ledger))
    present = {r["table_name"] for r in fresh.select("table_name").distinct().collect()} - {None}
    if not present:
        return spark.createDataFrame([], RESULT_SCHEMA)
    heads = durable(SF.header_lines(fresh.filter("table_name is not null")))
    results = []
    for table in TABLES[bureau]:
        if table not in present:
            continue
        own = fresh.filter(F.col("table_name") == table)
        own_heads = heads.join(own.select("path"), "path", "left_semi")
        results.append(load_table(spark, own, target, table, bureau, batch_no, as_of, heads=own_heads))
        if lender is not None and lender_target is not None and table in LENDERS[lender, bureau][0]:
            stored = stored_rows(spark, target, table).filter(F.col("batch_no") == batch_no)
            export_delimited(lender_view(stored, lender, bureau, table), f"{lender_target}/{batch_no}/{table.lower()}", "|", "overwrite")
    outcome = durable(reduce(lambda a, b: a.unionByName(b), results))
    loaded = outcome.filter("status = 'Processed'").withColumn("row_count", F.col("final_count"))
    LG.ledger_rows(loaded, as_of).write.mode("append").parquet(ledger_path)
    return outcome
