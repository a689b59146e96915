"""The identity master: contact lists, newest contacts, masks and sanity rules per customer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadforge.functions import text as X
from leadforge.functions.dates import plausible_dob
from leadforge.functions.status import score_status


def _newest(value: str) -> Column:
    """Newest value; an unreported date counts as newest, equal dates fall to the larger value.

    A maximum over (undated, date, value), so it combines before the shuffle and needs no sort.
    """
    ranked = F.struct(F.col("date_reported").isNull().alias("undated"), "date_reported", value)
    return F.max(F.when(F.col(value).isNotNull(), ranked))


def _contact_days(df: DataFrame, item: str, candidate: str) -> DataFrame:
    """Contacts reduced to one row per customer and day.

    The day level splits a customer with very many contacts over many tasks: sorting and joining text
    happens there, and the customer level only strings finished days together.
    """
    return df.groupBy("customer_id", "date_reported").agg(
        F.expr(f"listagg({item} || '|' || date_reported, ',') within group (order by {item})").alias("day_list"),
        _newest(candidate).alias("newest"),
    )


# A customer whose contacts are all undated has an empty list, not a missing one.
def _days_to_list(day_list: str) -> Column:
    return F.expr(f"coalesce(listagg({day_list}, ',') within group (order by date_reported), '')")


def phone_summary(phones: DataFrame) -> DataFrame:
    """Per customer: all phones with their dates, and the newest usable mobile."""
    rows = phones.select(
        "customer_id",
        "date_reported",
        X.phone_last10(F.col("phone")).alias("number"),
        X.mobile_candidate(F.col("phone")).alias("mobile"),
    ).withColumn("mobile", F.when(F.length("mobile") == 10, F.col("mobile")))
    return (
        _contact_days(rows, "number", "mobile")
        .groupBy("customer_id")
        .agg(_days_to_list("day_list").alias("mobile_list"), F.max("newest").alias("newest"))
        .select("customer_id", "mobile_list", F.col("newest.mobile").alias("latest_mobile"))
    )


def address_summary(addresses: DataFrame) -> DataFrame:
    """Per customer: all pincodes and addresses with their dates, and the newest of each."""
    rows = addresses.select(
        "customer_id", "date_reported", "address", X.pincode_last6(F.col("pincode")).alias("code")
    ).withColumn("pincode", F.when(F.length("code") == 6, F.col("code")))
    days = rows.groupBy("customer_id", "date_reported").agg(
        F.expr("listagg(code || '|' || date_reported, ',') within group (order by code)").alias("code_list"),
        F.expr("listagg(address || '|' || date_reported, ',') within group (order by address)").alias("day_list"),
        _newest("pincode").alias("newest_code"),
        _newest("address").alias("newest_address"),
    )
    return (
        days.groupBy("customer_id")
        .agg(
            _days_to_list("code_list").alias("pincode_list"),
            _days_to_list("day_list").alias("address_list"),
            F.max("newest_code").alias("newest_code"),
            F.max("newest_address").alias("newest_address"),
        )
        .select(
            "customer_id",
            F.col("newest_code.pincode").alias("pincode"),
            "pincode_list",
            "address_list",
            F.col("newest_address.address").alias("latest_address"),
        )
    )


def pii_master(
    scores: DataFrame,
    exchange: DataFrame,
    ids: DataFrame,
    name_dob: DataFrame,
    phones: DataFrame,
    addresses: DataFrame,
    batch: str,
    as_of: dt.date,
) -> DataFrame:
    """One identity row per scored customer of a batch that was sent to the bureau.

    ``exchange`` needs bureau_id, scrub_batch_no and phone: whichever exchange the bureau ids came from.
    """
    scored = scores.filter(F.col("batch_no") == batch).select("customer_id", "score_v3").distinct()
    sent = (
        exchange.filter(F.col("scrub_batch_no") == batch)
        .select(F.col("bureau_id").alias("customer_id"), F.col("phone").alias("sent_phone"))
        .distinct()
    )
    wanted = scored.join(sent, "customer_id", "left_semi").select("customer_id")
    phones, addresses = (df.join(wanted, "customer_id", "left_semi") for df in (phones, addresses))
    joined = (
        scored.join(sent, "customer_id")
        .join(ids.select("customer_id", "pan").distinct(), "customer_id", "left")
        .join(name_dob.select("customer_id", "full_name", "gender", "dob", F.col("created_at").alias("loaded_at"))
              .distinct(), "customer_id", "left")
        .join(phone_summary(phones), "customer_id", "left")
        .join(address_summary(addresses), "customer_id", "left")
    )
    mobile = F.coalesce(F.col("sent_phone"), F.col("latest_mobile"))
    personal = X.personal_pan(F.col("pan"))
    return joined.select(
        "customer_id",
        mobile.alias("mobile_number"),
        "latest_mobile",
        X.mask_phone(mobile).alias("masked_phone"),
        "full_name",
        personal.alias("pan_number"),
        X.pan_flag(F.col("pan")).alias("pan_flag"),
        X.mask_pan(personal).alias("masked_pan"),
        X.gender_label(F.col("gender")).alias("gender"),
        plausible_dob(F.col("dob"), F.col("loaded_at"), as_of).alias("dob"),
        "mobile_list",
        "pincode",
        "pincode_list",
        "address_list",
        "latest_address",
        F.col("score_v3").alias("score"),
    ).distinct().select("*", score_status(F.col("score")).alias("status"))
