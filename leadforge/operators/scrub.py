"""Bureau exports: due leads, running bureau ids, exchange rows, status flags, monitoring."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadforge.operators.skew import equi_join, flag_in
from leadforge.session import durable

ID_DIGITS = 12
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above bit 33


def due_for_scrub(processed: DataFrame, as_of: dt.date, days: int = 90, *, id_col: str = "lead_id") -> DataFrame:
    """Leads never sent, or sent more than ``days`` ago."""
    stale = F.col("scrub_date") < F.lit(as_of - dt.timedelta(days=days))
    return processed.filter((~F.col("sent_to_scrub") | stale) & F.col(id_col).isNotNull())


def select_batches(due: DataFrame, batches: list[str]) -> DataFrame:
    return due.filter(F.col("batch_no").isin(*batches))


def batch_selection_report(due: DataFrame, batches: list[str]) -> DataFrame:
    """Rows of each requested batch, with a warning for batches that have none."""
    requested = due.sparkSession.createDataFrame([(b,) for b in batches], "batch_no string")
    counted = select_batches(due, batches).groupBy("batch_no").agg(F.count(F.lit(1)).alias("record_count"))
    joined = requested.join(counted, "batch_no", "left").fillna(0, ["record_count"])
    warning = F.concat(F.lit("Batch "), "batch_no", F.lit(": No pending records found"))
    return joined.withColumn("warning", F.when(F.col("record_count") == 0, warning))


def union_batches(frames: list[DataFrame]) -> DataFrame:
    """Union without repeated rows."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct() if len(frames) > 1 else frames[0]


def max_bureau_index(exchange: DataFrame, prefix: str, as_of: dt.date) -> DataFrame:
    """One row: the largest running number handed out on a day, NULL when none was."""
    stem = f"{prefix}{as_of:%d%m%Y}"
    number = F.substring("bureau_id", len(stem) + 1, ID_DIGITS).try_cast("bigint")
    return exchange.filter(F.col("bureau_id").startswith(stem)).agg(F.max(number).alias("max_index"))


def next_bureau_index(exchange: DataFrame, prefix: str, as_of: dt.date) -> int:
    return (max_bureau_index(exchange, prefix, as_of).first()["max_index"] or 0) + 1


def number_rows(df: DataFrame, order: list[str], start: int, name: str) -> DataFrame:
    """Consecutive numbers in ``order``, without sending all rows through one task.

    Rows are range-partitioned and sorted; the position inside each partition is fixed by writing the
    frame to the shared folder. Then only the partition sizes, one row per partition, are summed up in
    order and broadcast back as offsets.
    """
    remaining = [c for c in df.columns if c not in order]
    full_order = [*order, *remaining]
    placed = durable(
        df.repartitionByRange(*full_order).sortWithinPartitions(*full_order)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS).cast("int"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position + F.lit(start))
        .drop("_at", "_part", "_offset")
    )


def assign_bureau_ids(df: DataFrame, prefix: str, as_of: dt.date, start: int, order: list[str]) -> DataFrame:
    """Prefix, day and a twelve-digit running number that continues from ``start``."""
    numbered = number_rows(df, order, start, "_number")
    text = F.concat(F.lit(f"{prefix}{as_of:%d%m%Y}"), F.lpad(F.col("_number").cast("string"), ID_DIGITS, "0"))
    return numbered.withColumn("bureau_id", text).drop("_number")


def exchange_rows(df: DataFrame, scrub_batch: str, as_of: dt.date, *, id_col: str = "lead_id",
                  with_second_flag: bool = True) -> DataFrame:
    """Numbered leads in the shape of the exchange table."""
    rows = df.select(
        id_col, "bureau_id", "hashed_phone", "phone", "pan_no",
        F.lit(scrub_batch).alias("scrub_batch_no"), F.lit(as_of).alias("scrub_date"),
    )
    return rows.withColumn("sent_to_experian", F.lit(False)) if with_second_flag else rows


def export_view(df: DataFrame) -> DataFrame:
    return df.select("bureau_id", "name", "phone")


def mark_sent(
    processed: DataFrame, exchange: DataFrame, scrub_batch: str, as_of: dt.date, bureau: str, *,
    id_col: str = "lead_id",
) -> DataFrame:
    """Processed leads of a scrub batch become sent, to the given bureau, on the given day."""
    batch = exchange.filter(F.col("scrub_batch_no") == scrub_batch)
    flagged = flag_in(processed, batch, [id_col], "_sent")
    sent, flag = F.col("_sent"), f"sent_to_{bureau}"
    earlier = F.col(flag) if flag in processed.columns else F.lit(False)
    return flagged.withColumns(
        {
            "sent_to_scrub": sent | F.col("sent_to_scrub"),
            flag: sent | earlier,
            "scrub_date": F.when(sent, F.lit(as_of)).otherwise(F.col("scrub_date")),
        }
    ).drop("_sent")


def mark_sent_to_second(
    exchange: DataFrame, second_exchange: DataFrame, scrub_batch: str | None = None, *,
    id_col: str = "lead_id",
) -> DataFrame:
    """First-bureau rows whose lead is in the second exchange; of all batches unless one is named."""
    if scrub_batch is not None:
        second_exchange = second_exchange.filter(F.col("scrub_batch_no") == scrub_batch)
    flagged = flag_in(exchange, second_exchange, [id_col], "_sent")
    return flagged.withColumn("sent_to_experian", F.col("_sent") | F.col("sent_to_experian")).drop("_sent")


EXCHANGE_COLUMNS = ["bureau_id", "hashed_phone", "phone", "pan_no", "scrub_batch_no", "scrub_date"]


def score_gate(
    exchange: DataFrame, responses: DataFrame, scrub_batch: str | None, min_score: int = 600, *,
    id_col: str = "lead_id",
) -> DataFrame:
    """Leads of a scrub batch (all batches when None) that have a response at or above the score, once each."""
    good = responses.filter(F.col("score").try_cast("double") >= min_score).select(
        F.col("reference_no").alias("bureau_id")
    ).distinct()
    leads = exchange.filter(F.col(id_col).isNotNull())
    if scrub_batch is not None:
        leads = leads.filter(F.col("scrub_batch_no") == scrub_batch)
    passed = equi_join(leads, good, ["bureau_id"], "left_semi")
    return passed.select(id_col, *EXCHANGE_COLUMNS)


def send_all(exchange: DataFrame, scrub_batch: str, *, id_col: str = "lead_id") -> DataFrame:
    return exchange.filter(F.col("scrub_batch_no") == scrub_batch).select(id_col, *EXCHANGE_COLUMNS)


def _received(processed: DataFrame, raw: DataFrame) -> DataFrame:
    """Distinct leads of each partner batch with their newest received date (rows without raw record drop)."""
    dates = raw.groupBy("partner_reference_id").agg(F.max("created_at").alias("received"))
    rows = equi_join(
        processed.select("partner_reference_id", "partner_name", "batch_no", "lead_id"), dates, ["partner_reference_id"], "inner"
    )
    return rows.groupBy("partner_name", "batch_no", "lead_id").agg(F.max("received").alias("received"))


def _answers(exchange: DataFrame, responses: DataFrame, response_id: str) -> DataFrame:
    """Exchange rows as (lead, answer, batch sent); the answer is the bureau id, NULL without a response."""
    rows = exchange.select("lead_id", "bureau_id", F.col("scrub_batch_no").alias("sent_batch"))
    known = flag_in(rows, responses.select(F.col(response_id).alias("bureau_id")), ["bureau_id"], "_answered")
    return known.select("lead_id", F.when(F.col("_answered"), F.col("bureau_id")).alias("answer"), "sent_batch")


def _distinct(bureau: int, column: str, name: str):
    """How many different values the rows of one bureau have."""
    return F.count_distinct(F.when(F.col("bureau") == bureau, F.col(column))).alias(name)


def batch_summary(
    processed: DataFrame, raw: DataFrame, exchange: DataFrame, responses: DataFrame, response_id: str,
    second_exchange: DataFrame, second_responses: DataFrame,
) -> DataFrame:
    """Per partner batch: leads, sent, answered, scrub batch, and the same for the second bureau.

    The rows of both exchanges, told apart by ``bureau``, meet the leads in one join and are counted with them in one
    aggregate; counts are of distinct keys, so no row counts twice. Exchange rows lead the join, so that a lead that was
    sent very often is split over tasks. Each input is read once; the leads are reduced once and used for both.
    """
    group = ["partner_name", "batch_no"]
    leads = _received(processed, raw)
    sent = _answers(exchange, responses, response_id).withColumn("bureau", F.lit(1)).unionByName(
        _answers(second_exchange, second_responses, "customer_id").withColumn("bureau", F.lit(2)))
    met = equi_join(sent, leads, ["lead_id"], "inner")
    own = leads.withColumns({"answer": F.lit(None).cast("string"), "sent_batch": F.lit(None).cast("string"), "bureau": F.lit(0)})
    counted = own.unionByName(met).groupBy(*group).agg(
        F.max("received").alias("received_date"),
        F.count(F.when(F.col("bureau") == 0, F.col("lead_id"))).alias("total_records"),
        _distinct(1, "lead_id", "sent_count"), _distinct(1, "answer", "response_count"),
        F.max(F.when(F.col("bureau") == 1, F.col("sent_batch"))).alias("scrub_batch_no"),
        _distinct(2, "lead_id", "sent_to_experian_count"), _distinct(2, "answer", "experian_response_count"),
    )
    return counted.orderBy(F.desc("received_date"))


def pending_summary(
    processed: DataFrame, raw: DataFrame, exchange: DataFrame, as_of: dt.date, days: int = 90
) -> DataFrame:
    """Per partner batch: leads still due and the last scrub batch; batches without due leads are left out."""
    stale = F.col("scrub_date") < F.lit(as_of - dt.timedelta(days=days))
    leads = _received(processed.filter(~F.col("sent_to_scrub") | stale), raw)
    batches = exchange.groupBy("lead_id").agg(F.max("scrub_batch_no").alias("last_scrub_batch"))
    return (
        leads.join(batches, "lead_id", "left")
        .groupBy("partner_name", "batch_no")
        .agg(
            F.max("received").alias("received_date"),
            F.count_distinct("lead_id").alias("pending_records"),
            F.max("last_scrub_batch").alias("last_scrub_batch"),
        )
        .filter(F.col("pending_records") > 0)
        .orderBy(F.desc("received_date"))
    )


def scrub_monitor(
    exchange: DataFrame, responses: DataFrame, second_exchange: DataFrame, second_responses: DataFrame,
    as_of: dt.date, min_score: int = 600, days: int = 90,
) -> DataFrame:
    """Per scrub batch: sent, hits, no hits, good scores, second-bureau sent and responses, dates."""
    recent = exchange.filter(F.col("scrub_date") >= F.lit(as_of - dt.timedelta(days=days)))
    hits = responses.groupBy(F.col("reference_no").alias("bureau_id")).agg(
        F.max("created_at").alias("response_date"),
        F.bool_or(F.col("score").try_cast("double") >= min_score).alias("scored"),
        F.count(F.lit(1)).alias("answers"),
    )
    first = equi_join(recent.select("scrub_batch_no", "lead_id", "bureau_id", "scrub_date"), hits, ["bureau_id"], "left").select(
        "scrub_batch_no", "lead_id", F.when(F.col("answers").isNotNull(), F.col("bureau_id")).alias("answer"),
        F.when(F.col("scored"), F.col("lead_id")).alias("good_lead"), "scrub_date", "response_date", F.lit(1).alias("bureau"),
    )
    members = recent.select("scrub_batch_no", "lead_id").distinct()
    second = equi_join(_answers(second_exchange, second_responses, "customer_id").drop("sent_batch"), members, ["lead_id"], "inner")
    counted = first.unionByName(second.withColumn("bureau", F.lit(2)), allowMissingColumns=True).groupBy("scrub_batch_no").agg(
        F.max("scrub_date").alias("scrub_date"),
        F.max("response_date").alias("equifax_response_date"),
        _distinct(1, "lead_id", "sent_to_equifax"), _distinct(1, "answer", "equifax_hits"), _distinct(1, "good_lead", "score_gte_input"),
        _distinct(2, "lead_id", "sent_to_experian"), _distinct(2, "answer", "experian_response"),
    )
    return counted.withColumn("no_hits", F.col("sent_to_equifax") - F.col("equifax_hits")).orderBy(F.desc("scrub_date"))


def response_status(responses: DataFrame, batch: str) -> DataFrame:
    counted = responses.filter(F.col("batch_no") == batch).agg(F.count(F.lit(1)).alias("record_count"))
    return counted.withColumn("has_response", F.col("record_count") > 0)


def response_counts(responses: DataFrame) -> DataFrame:
    """Response rows of every batch."""
    return responses.groupBy(F.col("batch_no").alias("scrub_batch_no")).agg(F.count(F.lit(1)).alias("record_count"))


def exclude_other_bureau_only(df: DataFrame, other: str, own: str) -> DataFrame:
    """Drop batches that were only ever sent to the other bureau."""
    return df.filter(~((F.col(other) > 0) & (F.col(own) == 0)))
