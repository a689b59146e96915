"""Stages 2 to 5 over stored tables: each reads what the stage before it stored and replaces its own partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.operators import scrub as S
from leadforge.operators.features.risk import add_tli
from leadforge.operators.identity import pii_master
from leadforge.plans import export as E
from leadforge.plans import lenders as PL
from leadforge.session import durable
from leadforge.sources.ledger import exists
from leadforge.sources.schemas import TABLES
from leadforge.sources.sinks import export_delimited, in_table_layout, narrow_tasks, overwrite_partitions, with_audit

PROCESSED = f"{TABLES['partners_processed']}, sent_to_equifax boolean, sent_to_experian boolean"
OFFERS = f"{TABLES['lender_offers']}, delivery string"


def read_table(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """A stored table in its layout: empty while nothing is stored, NULL where older files lack a column."""
    schema = T.StructType.fromDDL(layout)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def _settled(rows: DataFrame, path: str, layout: str, partition: tuple[str, ...]) -> None:
    overwrite_partitions(in_table_layout(durable(rows), layout), path, partition)


def _with_leads(table: DataFrame, leads: DataFrame, partition: str) -> DataFrame:
    """The partitions of a table that hold one of the leads; all others keep their files as they are.

    The touched partitions are one row each, so they are broadcast: a shuffle by partition would put a whole one in a task.
    """
    touched = table.join(leads, "lead_id", "left_semi").select(F.col(partition).alias("_touched")).distinct()
    return table.join(F.broadcast(touched), F.col(partition).eqNullSafe(F.col("_touched")), "left_semi")


def _store_sent(processed: DataFrame, path: str, rows: DataFrame, scrub_batch: str, as_of: dt.date, bureau: str) -> None:
    """Flag the leads of a scrub batch in the stored leads."""
    touched = _with_leads(processed, rows.select("lead_id").distinct(), "batch_no")
    no_flags = touched.fillna(False, ["sent_to_scrub", "sent_to_equifax", "sent_to_experian"])
    _settled(S.mark_sent(no_flags, rows, scrub_batch, as_of, bureau), path, PROCESSED, ("batch_no",))


def store_bureau_export(
    spark: SparkSession,
    processed_path: str,
    exchange_path: str,
    file_path: str,
    batches: list[str],
    scrub_batch: str,
    as_of: dt.date,
    *,
    bureau: str = "equifax",
    days: int = 90,
) -> None:
    """Send due leads to a bureau: the bureau's file, then the exchange rows, then the flags of the leads.

    The exchange rows of a scrub batch settle its ids. A run that was cut short before them is made anew; after them, a
    repeated run sets the flags only. Ids continue from the day's largest, so a bureau's exports run one at a time.
    """
    layout = TABLES[f"{bureau}_exchange"]
    processed = read_table(spark, processed_path, PROCESSED)
    exchange = read_table(spark, exchange_path, layout)
    if exchange.filter(F.col("scrub_batch_no") == scrub_batch).isEmpty():
        file_rows, rows, _ = E.bureau_export(processed, exchange, batches, scrub_batch, as_of, bureau=bureau, days=days)
        export_delimited(file_rows, f"{file_path}/{scrub_batch}", mode="overwrite")
        _settled(rows, exchange_path, layout, ("scrub_batch_no",))
    sent = read_table(spark, exchange_path, layout).filter(F.col("scrub_batch_no") == scrub_batch)
    _store_sent(processed, processed_path, sent, scrub_batch, as_of, bureau)


def store_second_export(
    spark: SparkSession,
    exchange_path: str,
    responses: DataFrame,
    second_path: str,
    processed_path: str,
    file_path: str,
    scrub_batch: str,
    as_of: dt.date,
    *,
    min_score: int | None = 600,
) -> None:
    """Hand a scrub batch on to the second bureau: file, rows of the second exchange, flags in the first and on the leads.

    As above, a batch that has rows in the second exchange is settled, and a repeated run sets the flags only.
    """
    first_layout, layout = TABLES["equifax_exchange"], TABLES["experian_exchange"]
    first = read_table(spark, exchange_path, first_layout)
    second = read_table(spark, second_path, layout)
    processed = read_table(spark, processed_path, PROCESSED)
    if second.filter(F.col("scrub_batch_no") == scrub_batch).isEmpty():
        rows = durable(E.second_bureau_export(first, responses, second, processed, scrub_batch, as_of, min_score=min_score)[0])
        export_delimited(rows, f"{file_path}/{scrub_batch}", mode="overwrite")
        _settled(rows, second_path, layout, ("scrub_batch_no",))
    sent = read_table(spark, second_path, layout).filter(F.col("scrub_batch_no") == scrub_batch)
    touched = _with_leads(first, sent.select("lead_id").distinct(), "scrub_batch_no")
    flagged = S.mark_sent_to_second(touched.fillna(False, ["sent_to_experian"]), sent)
    _settled(flagged, exchange_path, first_layout, ("scrub_batch_no",))
    _store_sent(processed, processed_path, sent, scrub_batch, as_of, "experian")


def store_pii_master(
    spark: SparkSession, tables: dict[str, DataFrame], exchange: DataFrame, batch: str, as_of: dt.date, path: str
) -> DataFrame:
    """Build and store the identity rows of a batch; ``tables`` holds scores, ids, name_dob, phones and addresses."""
    master = pii_master(
        tables["scores"], exchange, tables["ids"], tables["name_dob"], tables["phones"], tables["addresses"], batch, as_of)
    # Made of other tables than the one it goes to, and of one partition: neither checkpointed nor gathered before the write.
    overwrite_partitions(in_table_layout(with_audit(master, batch, as_of), TABLES["pii_master"]), path, ("batch_no",), gather=False)
    return read_table(spark, path, TABLES["pii_master"])


def store_features(
    pii_path: str, exchange: DataFrame, accounts: DataFrame, enquiries: DataFrame, batch: str, as_of: dt.date, path: str
) -> DataFrame:
    """Build the feature table of a batch from the stored identity rows and store it, one partition a batch."""
    spark = accounts.sparkSession
    pii = read_table(spark, pii_path, TABLES["pii_master"])
    features = add_tli(pii, exchange, accounts, enquiries, batch, as_of)
    with narrow_tasks(spark):
        overwrite_partitions(features, path, ("batch_no",), gather=False)
    return spark.read.schema(features.schema).parquet(path)


def store_shortlist(
    spark: SparkSession,
    lenders: DataFrame,
    inventory: DataFrame,
    batches: list[str],
    lender: str,
    bureau: str,
    lender_batch: str,
    as_of: dt.date,
    path: str,
    target: str | None = None,
    **features,
) -> DataFrame:
    """Shortlist a lender's batch by its stored criteria; files to ``target``, then the record, replaced by batch.

    Without usable criteria or score files nothing is stored. With ``features`` (see ``lender_export``) all rules act.
    """
    layout, partition = TABLES["lenders_shortlisted"], ("lender_name", "bureau_type", "lender_batch")
    done = PL.export_for_lender(spark, lenders, inventory, batches, lender, bureau, lender_batch, as_of, target, **features)
    if done is not None:
        _settled(done[1], path, layout, partition)
    return read_table(spark, path, layout)


def store_offers(
    spark: SparkSession, inventory: DataFrame, as_of: dt.date, path: str, lender_name: str, delivery: str
) -> DataFrame:
    """Store a lender's returned offers; a repeated delivery replaces itself."""
    offers = PL.lender_offers(spark, inventory, as_of, lender_name=lender_name).withColumn("delivery", F.lit(delivery))
    _settled(offers, path, OFFERS, ("lender_name", "delivery"))
    return read_table(spark, path, OFFERS)
