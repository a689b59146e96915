"""Stage 1 end to end: uploaded rows to raw rows, and raw rows to processed leads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.functions.text import null_tokens
from leadforge.operators import leads as L
from leadforge.session import durable
from leadforge.sources import files as SF
from leadforge.sources import partner_files as PF
from leadforge.sources.ledger import exists
from leadforge.sources.schemas import TABLES
from leadforge.sources.sinks import append_by_name, in_table_layout, overwrite_partitions

PARTNER_COLUMNS = ["partner_reference_id", "hashed_phone", "masked_phone", "phone", "pan_no", "name", "partner_name"]


def ingest(
    uploaded: DataFrame, partners: DataFrame, as_of: dt.date, order: tuple[str, ...] = ("file_seq", "row_seq")
) -> DataFrame:
    """Uploaded rows (one frame per upload) trimmed, completed, de-duplicated and labelled for the raw table."""
    trimmed = uploaded.withColumns(
        {name: null_tokens(F.trim(name), ("",)) for name, kind in uploaded.dtypes if kind == "string"}
    )
    if "hashed_phone" not in trimmed.columns and "phone" in trimmed.columns:
        trimmed = trimmed.withColumn("hashed_phone", F.col("phone"))
    complete = L.enrich_if_absent(trimmed, **{c: F.lit(None).cast("string") for c in PARTNER_COLUMNS})
    marked = L.mark_duplicates(complete, order=order)
    dated = marked.withColumn("created_at", F.lit(as_of))
    return L.lookup_partner(dated, partners)


def ingest_files(
    spark: SparkSession, inventory: DataFrame, partners: DataFrame, partner: str, batch_no: str, as_of: dt.date
) -> tuple[DataFrame, DataFrame]:
    """(raw rows, file report) of one upload of partner files; only files with a proper header are read.

    Files count in the order of their names, rows in the order of the file.
    """
    checked = SF.partner_header_report(SF.header_columns(SF.header_lines(inventory), ","), PF.HEADER_ALIASES)
    is_csv = F.lower("file_name").endswith(SF.PARTNER_ENDINGS[0])
    report = durable(checked.withColumn("is_valid", F.col("is_valid") & is_csv))
    accepted = inventory.join(report.filter("is_valid").select("path"), "path", "left_semi")
    rows = PF.scan_partner_csv(spark, accepted)
    named = rows.toDF(*[c.lower() for c in rows.columns]).withColumns(
        {"partner_name": F.lit(partner), "batch_no": F.lit(batch_no)}
    )
    return ingest(named, partners, as_of, ("filename", "file_offset", "row_seq")), report


def process_batch(
    raw: DataFrame, phone_base: DataFrame, as_of: dt.date, partner: str | None = None, batch: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(updated raw rows, new processed rows, summary) of one batch, or of all batches.

    Nothing is updated in place: the caller overwrites the raw partitions and appends the processed rows.
    The new rows that are not missing are just the ones that get processed, so one look at the phone base
    settles both status changes.
    """
    processed = L.processed_rows(L.match_phone(raw, phone_base, partner, batch), as_of)
    updated = L.settle(raw, phone_base, partner, batch)
    return updated, processed, L.process_summary(updated, processed)


RAW_PARTITIONS = ("partner_name", "batch_no")


LEAD_KEY = ["partner_name", "batch_no", "partner_reference_id", "lead_id"]


def store_batch(updated: DataFrame, processed: DataFrame, raw_path: str, processed_path: str) -> None:
    """Write the results of ``process_batch`` over the stored tables.

    Both frames come from the raw table itself, so they are written to the shared folder first. The new leads are
    stored before their raw rows are marked: a run that was cut short in between is simply run again, and leads that
    are stored already are not appended twice.
    """
    updated, processed = durable(updated), durable(processed)
    layout = TABLES["partners_processed"]
    rows = in_table_layout(processed, layout)
    if exists(processed.sparkSession, processed_path):
        stored = processed.sparkSession.read.parquet(processed_path).select(*LEAD_KEY).distinct()
        same = [rows[k].eqNullSafe(stored[k]) for k in LEAD_KEY]
        rows = rows.join(stored, same, "left_anti")
    append_by_name(rows, processed_path, T.StructType.fromDDL(layout).fieldNames())
    overwrite_partitions(updated, raw_path, RAW_PARTITIONS)
