"""Stage 2 end to end: due leads to a numbered bureau file, and first-bureau leads to the second bureau."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from leadforge.operators import scrub as S
from leadforge.session import durable


def bureau_export(
    processed: DataFrame,
    exchange: DataFrame,
    batches: list[str],
    scrub_batch: str,
    as_of: dt.date,
    *,
    bureau: str = "equifax",
    days: int = 90,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(export file rows, new exchange rows, processed leads with updated flags).

    The numbered rows are written once and read three times, so all results carry the same ids.
    """
    prefix = {"equifax": "EQ", "experian": "EX"}[bureau]
    due = S.due_for_scrub(processed, as_of, days)
    combined = S.select_batches(due, batches)
    combined = combined.distinct() if len(batches) > 1 else combined
    start = S.next_bureau_index(exchange, prefix, as_of)
    numbered = durable(S.assign_bureau_ids(combined, prefix, as_of, start, ["lead_id", "partner_reference_id"]))
    rows = S.exchange_rows(numbered, scrub_batch, as_of, with_second_flag=bureau == "equifax")
    return S.export_view(numbered), rows, S.mark_sent(processed, rows, scrub_batch, as_of, bureau)


def second_bureau_export(
    exchange: DataFrame,
    responses: DataFrame,
    second_exchange: DataFrame,
    processed: DataFrame,
    scrub_batch: str,
    as_of: dt.date,
    *,
    min_score: int | None = 600,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows for the second bureau, first exchange with flags, processed leads with flags).

    ``min_score=None`` sends the whole scrub batch, otherwise only leads that reach the score.
    """
    if min_score is None:
        rows = S.send_all(exchange, scrub_batch)
    else:
        rows = S.score_gate(exchange, responses, scrub_batch, min_score)
    grown = second_exchange.select("lead_id", "scrub_batch_no").unionByName(rows.select("lead_id", "scrub_batch_no"))
    flagged = S.mark_sent_to_second(exchange, grown)
    return rows, flagged, S.mark_sent(processed, rows, scrub_batch, as_of, "experian")


def second_bureau_report(exchange: DataFrame, scrub_batches: list[str]) -> DataFrame:
    """Which of the requested scrub batches have rows to send."""
    report = S.batch_selection_report(exchange.withColumnRenamed("scrub_batch_no", "batch_no"), scrub_batches)
    return report.selectExpr(
        "batch_no as scrub_batch_no", "record_count",
        "if(record_count > 0, 'success', 'failed') as outcome",
        "if(record_count > 0, null, 'No data found for this batch') as error",
    )
