"""Partner leads: duplicates, matching to the identity base, status changes, batch summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadforge.operators.skew import equi_join, flag_in

NEW, DUPLICATE, PROCESSED = "not processed", "duplicate", "processed"
MISSING_ID = "error: lead id not found"


def lookup_partner(df: DataFrame, partners: DataFrame) -> DataFrame:
    """Add partner_id by partner name; unknown partners get NULL.

    The partner list is one row per partner after the reduction. It is left to the planner whether to
    broadcast it, since its size is not fixed here.
    """
    ids = partners.groupBy("partner_name").agg(F.min("partner_id").alias("partner_id"))
    return df.join(ids, "partner_name", "left")


def enrich_if_absent(df: DataFrame, **columns: Column) -> DataFrame:
    """Add the given columns only where the frame does not have them yet."""
    return df.withColumns({name: c for name, c in columns.items() if name not in df.columns})


def mark_duplicates(
    df: DataFrame,
    key: str = "hashed_phone",
    order: tuple[str, ...] = ("file_seq", "row_seq"),
    scope: tuple[str, ...] = ("partner_name", "batch_no")) -> DataFrame:
    """Status of every uploaded row: the first row of a phone is new, later ones are duplicates.

    ``order`` is file position then row position inside the upload ``scope``; empty and NULL phones are
    never duplicates. ``duplicate_kind`` is ``in_file`` when the first row is in the same file, else
    ``in_batch``. The first row per phone is a minimum (combined before the shuffle); in the join back
    adaptive execution splits phones that fill much of an upload.
    """
    keys = [*scope, key]
    usable = F.col(key).isNotNull() & (F.col(key) != "")
    firsts = df.filter(usable).groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
    joined = equi_join(df, firsts, keys, "left")
    repeated = usable & (F.struct(*[F.col(c) for c in order]) != F.col("_first"))
    same_file = F.col(order[0]) == F.col("_first")[order[0]]
    return joined.select(
        *df.columns,
        F.when(repeated, DUPLICATE).otherwise(NEW).alias("status"),
        F.when(repeated, F.when(same_file, "in_file").otherwise("in_batch")).alias("duplicate_kind"),
    )


def duplicate_log(marked: DataFrame) -> DataFrame:
    """Rows and duplicates of each uploaded file."""
    return marked.groupBy("partner_name", "batch_no", "filename").agg(
        F.count(F.lit(1)).alias("original_count"),
        F.count_if(F.col("duplicate_kind") == "in_file").alias("infile_dropped"),
        F.count_if(F.col("duplicate_kind") == "in_batch").alias("inbatch_dropped"),
    )


def _batch_filter(partner: str | None, batch: str | None) -> Column:
    chosen = F.lit(True)
    if partner is not None:
        chosen = chosen & (F.col("partner_name") == partner)
    if batch is not None:
        chosen = chosen & (F.col("batch_no") == batch)
    return chosen


def match_phone(
    raw: DataFrame, phone_base: DataFrame, partner: str | None = None, batch: str | None = None, *,
    id_col: str = "lead_id",
) -> DataFrame:
    """New rows with their lead id. A phone that the base holds twice yields two rows."""
    fresh = raw.filter(_batch_filter(partner, batch) & (F.col("status") == NEW) & F.col("hashed_phone").isNotNull())
    return equi_join(fresh, phone_base.select("hashed_phone", id_col), ["hashed_phone"], "inner")


def mark_missing(
    raw: DataFrame, phone_base: DataFrame, partner: str | None = None, batch: str | None = None, *,
    label: str = MISSING_ID,
) -> DataFrame:
    """All rows, where new rows without a match in the phone base carry the error label."""
    flagged = flag_in(raw, phone_base, ["hashed_phone"], "_known")
    missing = _batch_filter(partner, batch) & (F.col("status") == NEW) & ~F.col("_known")
    return flagged.withColumn("status", F.when(missing, label).otherwise(F.col("status"))).drop("_known")


def mark_processed(
    raw: DataFrame, processed: DataFrame, partner: str | None = None, batch: str | None = None) -> DataFrame:
    """All rows, where new rows whose reference id reached the processed table become processed."""
    keys = ["partner_name", "batch_no", "partner_reference_id"]
    flagged = flag_in(raw, processed, keys, "_done")
    done = _batch_filter(partner, batch) & (F.col("status") == NEW) & F.col("_done")
    return flagged.withColumn("status", F.when(done, PROCESSED).otherwise(F.col("status"))).drop("_done")


def settle(
    raw: DataFrame, phone_base: DataFrame, partner: str | None = None, batch: str | None = None, *,
    label: str = MISSING_ID,
) -> DataFrame:
    """``mark_missing`` and ``mark_processed`` in one join: new rows become processed or carry the error label."""
    flagged = flag_in(raw, phone_base, ["hashed_phone"], "_known")
    fresh = _batch_filter(partner, batch) & (F.col("status") == NEW)
    outcome = F.when(F.col("_known"), PROCESSED).otherwise(label)
    return flagged.withColumn("status", F.when(fresh, outcome).otherwise(F.col("status"))).drop("_known")


def processed_rows(matched: DataFrame, as_of: dt.date, *, id_col: str = "lead_id") -> DataFrame:
    """Matched rows in the shape of the processed table."""
    keep = ["partner_reference_id", id_col, "hashed_phone", "masked_phone", "phone", "pan_no", "name",
            "partner_name", "batch_no", "partner_id"]
    present = [c for c in keep if c in matched.columns]
    return matched.select(
        *present,
        F.lit(as_of).alias("created_at"),
        F.lit(False).alias("sent_to_scrub"),
        F.lit(None).cast("date").alias("scrub_date"),
    )


def raw_batch_counts(raw: DataFrame, partner: str, batch: str) -> DataFrame:
    """Rows, new rows and the rest of one batch, in one pass."""
    counts = raw.filter(_batch_filter(partner, batch)).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == NEW).alias("not_processed")
    )
    return counts.withColumn("duplicates", F.col("total") - F.col("not_processed"))


def _progress(counted: DataFrame) -> DataFrame:
    idle = F.col("new_count") == 0
    return counted.withColumns(
        {
            "no_of_records": F.when(idle, F.col("total_count")).otherwise(F.col("new_count")),
            "status": F.when(idle, PROCESSED).otherwise(NEW),
        }
    ).drop("total_count", "new_count")


_COUNTS = (
    lambda: F.count(F.lit(1)).alias("total_count"),
    lambda: F.count_if(F.col("status") == NEW).alias("new_count"),
)


def pending_batches(raw: DataFrame) -> DataFrame:
    """Batches with the count that matters (new rows, else all) and their state; odd batch names are skipped."""
    counted = raw.groupBy("partner_name", "batch_no").agg(*[c() for c in _COUNTS])
    numbered = counted.withColumn("batch_no", F.replace("batch_no", F.lit("batch_"), F.lit("")).try_cast("int"))
    return _progress(numbered.filter(F.col("batch_no").isNotNull())).orderBy("partner_name", "batch_no")


def files_for_batch(raw: DataFrame, partner: str, batch: str) -> DataFrame:
    chosen = raw.filter(_batch_filter(partner, batch))
    return _progress(chosen.groupBy("filename").agg(*[c() for c in _COUNTS]))


def process_summary(raw: DataFrame, processed: DataFrame, missing_label: str = MISSING_ID, *,
                    count_rest_as_duplicates: bool = False) -> DataFrame:
    """Original, cleaned, duplicate and unmatched rows of every batch.

    ``count_rest_as_duplicates`` gives the older figure: everything that is not new counts as duplicate.
    """
    duplicate = F.col("status") != NEW if count_rest_as_duplicates else F.col("status") == DUPLICATE
    original = raw.groupBy("partner_name", "batch_no").agg(
        F.count(F.lit(1)).alias("original_count"),
        F.count_if(duplicate).alias("duplicates_found"),
        F.count_if(F.col("status") == missing_label).alias("missing_id_count"),
    )
    cleaned = processed.groupBy("partner_name", "batch_no").agg(F.count(F.lit(1)).alias("cleaned_count"))
    return original.join(cleaned, ["partner_name", "batch_no"], "left").fillna(0, ["cleaned_count"])


def _tagged(line: Column, *tags: str) -> Column:
    """What follows the first of the tags found in a comma-separated line, up to the comma."""
    found = []
    for tag in tags:
        at = lambda piece, tag=tag: F.locate(tag, F.lower(piece))
        piece = F.get(F.filter(F.split(line, ","), lambda p: at(p) > 0), F.lit(0))  # noqa: B023
        found.append(F.trim(F.substr(piece, at(piece) + len(tag))))
    return F.coalesce(*found)


def next_partner_batch(log_lines: DataFrame, as_of: dt.date) -> DataFrame:
    """Next batch number per partner from log lines (line_no, value): same day keeps it, another day adds one.

    A line counts if it names a partner, a whole batch number and a date.
    """
    line = F.col("value")
    parsed = log_lines.select(
        "line_no", _tagged(line, "partner:").alias("partner_name"), _tagged(line, "batch no:", "batch:").try_cast("int").alias("batch"),
        F.split_part(_tagged(line, "date:"), F.lit(" "), F.lit(1)).try_cast("date").alias("day"),
    ).dropna()
    newest = parsed.groupBy("partner_name").agg(F.max(F.struct("line_no", "batch", "day")).alias("last"))
    same_day = F.col("last.day") == F.lit(as_of)
    return newest.select(
        "partner_name", (F.col("last.batch") + F.when(same_day, 0).otherwise(1)).cast("bigint").alias("next_batch")
    )


def next_numbered_batch(log_lines: DataFrame, tag: str) -> DataFrame:
    """One row: the largest number that stands behind ``tag`` and a colon or equals sign, plus one; one for an empty log."""
    behind = F.slice(F.split(F.lower("value"), "\\Q" + tag.lower() + "\\E"), 2, 1 << 30)
    pieces = log_lines.select(F.explode(F.transform(behind, lambda piece: F.ltrim(piece, F.lit(".")))).alias("rest"))
    marked = pieces.filter(F.left("rest", F.lit(1)).isin(":", "="))
    number = F.regexp_substr(F.ltrim(F.substr("rest", F.lit(2))), F.lit("^[0-9]+")).try_cast("bigint")
    return marked.agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_batch"))
