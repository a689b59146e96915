"""Status labels as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def score_status(score: Column, threshold: int = 700) -> Column:
    return F.when(score >= threshold, "Approved").otherwise("Declined")


def _progress(sent: Column, total: Column, whole: str, part: str) -> Column:
    ratio = F.format_string(part + " (%d/%d)", sent.cast("bigint"), total.cast("bigint"))
    return F.when(sent >= total, whole).otherwise(ratio)


def single_bureau_status(total: Column, sent: Column, responses: Column) -> Column:
    """State of a partner batch that goes to one bureau."""
    return (
        F.when((responses > 0) & (responses >= sent), "Response Received")
        .when(sent > 0, _progress(sent, total, "Sent (Awaiting Response)", "Partially Sent"))
        .otherwise("Pending")
    )


def two_bureau_status(
    total: Column, sent: Column, responses: Column, sent_second: Column, responses_second: Column
) -> Column:
    """State of a partner batch that goes to Equifax first and Experian second."""
    return (
        F.when(responses_second > 0, "Response Received from Experian")
        .when(sent_second > 0, "Sent to Experian")
        .when(responses > 0, "Response Received from Equifax")
        .when(sent > 0, _progress(sent, total, "Sent to Equifax", "Partially Sent to Equifax"))
        .otherwise("Pending")
    )


def scrub_batch_status(has_response: Column, responses_second: Column, sent_second: Column) -> Column:
    return (
        F.when(has_response, "Response Received from Equifax")
        .when(responses_second > 0, "Response Received from Experian")
        .when(sent_second > 0, "Sent to Experian")
        .otherwise("Pending")
    )


def ready_for_second_bureau(status: Column, hits: Column) -> Column:
    return (status == "Response Received from Equifax") | ((status == "Pending") & (hits > 0))
