"""Enquiry and delinquency features, the risk ladder, and the full feature table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadforge.functions.dates import age_years, month_diff
from leadforge.operators.features import spec as S
from leadforge.operators.features import tradelines as T


def enquiry_features(enq: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Enquiry counts by purpose family and look-back window."""
    typed = enq.select(
        "customer_id",
        F.col("inq_purp_cd").try_cast("int").alias("purpose"),
        month_diff(F.col("inq_date"), F.col("created_at")).alias("months"),
    )
    columns = []
    for family, codes in S.ENQUIRY_FAMILIES.items():
        asked = f"purpose in ({', '.join(map(str, codes))})"
        columns.append(f"count_if({asked}) as nbr_{family}_enquiry_ever")
        columns += [f"count_if({asked} and months <= {w}) as nbr_{family}_enquiry_l{w}m" for w in S.WINDOWS]
    counted = typed.groupBy("customer_id").agg(*[F.expr(c) for c in columns])
    return counted if customers is None else counted.join(customers, "customer_id", "left_semi")


def dpd_features(ar: DataFrame) -> DataFrame:
    """Worst days past due per customer and window, over all and over secured accounts."""
    secured_type = F.col("acct_type_cd").try_cast("int").isin(*S.SECURED_CODES)
    typed = T.worst_days(ar.select("customer_id", secured_type.alias("secured"), T._dpd_months()))
    everything = [F.max(f"dpd_{w}").alias(f"max_dpd_l{w}m_all") for w in S.DPD_WINDOWS]
    secured = [
        F.max(F.when(F.col("secured"), F.col(f"dpd_{w}")).otherwise(0)).cast(T.DAYS).alias(f"max_dpd_l{w}m_secured_acct")
        for w in S.DPD_WINDOWS
    ]
    return typed.groupBy("customer_id").agg(*everything, *secured)


def _cards(limit: int) -> list[str]:
    return ["nbr_active_cc >= 1", f"max_cc_loan_amt >= {limit}", "nbr_cc >= 1", "current_cc_util < 80"]


def _home(amount: int, tenure: int) -> list[str]:
    return [f"max_hl_loan_amt >= {amount}", f"cb_hl_tenure >= {tenure}"]


def _personal(amount: int) -> list[str]:
    return [f"max_pl_loan_amt >= {amount}", "nbr_pl >= 1", "current_pl_util <= 50"]


def _clean(**worst: int) -> list[str]:
    """``m36=10`` reads: worst delinquency of 36 months at most 10 days."""
    return [f"max_dpd_l{window[1:]}m_all <= {days}" for window, days in worst.items()]


def _no_new_loans(months: int) -> list[str]:
    return [f"nbr_pl_opened_l{months}m <= 0"]


def category_ladder() -> list[tuple[str, int, int | None, list[str]]]:
    """(category, least score, least bureau tenure, further conditions); the first match wins."""
    return [
        ("CAT-A1", 760, 48, _cards(100000) + _clean(m36=10) + _no_new_loans(6)),
        ("CAT-A2", 760, 48, _home(4000000, 12) + _clean(m36=10, m24=0) + _no_new_loans(12)),
        ("CAT-A3", 740, 36, _cards(100000) + _clean(m36=10) + _no_new_loans(6)),
        ("CAT-A4", 740, 36, _home(3000000, 12) + _clean(m36=10, m24=0) + _no_new_loans(12)),
        ("CAT-B1", 760, 48, _personal(250000) + _clean(m36=10, m24=0) + _no_new_loans(6)),
        ("CAT-B2", 740, 36, _personal(200000) + _clean(m36=10, m24=0) + _no_new_loans(6)),
        ("CAT-B3", 720, 24, _cards(100000) + _clean(m24=10) + _no_new_loans(3)),
        ("CAT-C1", 720, 24, _personal(150000) + _clean(m24=10, m12=0) + _no_new_loans(3)),
        ("CAT-C2", 720, 24, _home(2000000, 6) + _clean(m24=10, m12=0) + _no_new_loans(6)),
        ("CAT-C3", 700, 12, _cards(50000) + _clean(m12=10) + _no_new_loans(3)),
        ("CAT-C4", 700, 12, ["max_pl_loan_amt >= 75000"] + _clean(m12=10) + _no_new_loans(3)),
        ("CAT-C5", 700, 12, _cards(50000) + _clean(m12=10)),
        ("CAT-D1", 700, 12, ["max_pl_loan_amt >= 75000"] + _clean(m12=0)),
        ("CAT-D2", 10, None, []),
    ]


def category_sql() -> str:
    """Risk category from score, tenure, products, utilisation, delinquency and recent loans (SQL text)."""
    branches = []
    for name, score, tenure, further in category_ladder():
        conditions = [f"score >= {score}", *([f"credit_bureau_tenure >= {tenure}"] if tenure else []), *further]
        branches.append(f"when {' and '.join(conditions)} then '{name}'")
    return f"case {' '.join(branches)} else 'NO-HIT' end"


def customer_category() -> Column:
    return F.expr(category_sql())


# Columns that the ladder reads, so that it can be computed without the whole table.
CATEGORY_INPUTS = (
    "credit_bureau_tenure", "nbr_active_cc", "max_cc_loan_amt", "nbr_cc", "tot_active_cc_bal",
    "tot_active_cc_loan_amt", "max_hl_loan_amt", "cb_hl_tenure", "max_pl_loan_amt", "nbr_pl",
    "tot_active_pl_bal", "tot_active_pl_loan_amt", "nbr_pl_opened_l3m", "nbr_pl_opened_l6m", "nbr_pl_opened_l12m",
)


def of_customers(rows: DataFrame, base: DataFrame) -> DataFrame:
    """Only the rows of the customers in ``base``, so that a batch aggregates no other customer's rows."""
    return rows.join(base.select("customer_id"), "customer_id", "left_semi")


def categorised(base: DataFrame, ar: DataFrame) -> DataFrame:
    """``base`` (customer_id, score, ...) with its risk category."""
    features = [f for f in S.tradeline_catalogue() if f.name in CATEGORY_INPUTS]
    delinquency = [f for f in T.dpd_catalogue() if f.name in (f"max_dpd_l{w}m_all" for w in (12, 24, 36))]
    wanted = features + delinquency
    joined = base.join(T.feature_slots(of_customers(ar, base), wanted), "customer_id", "left")
    columns = joined.selectExpr(*base.columns, *T.slot_columns(wanted))
    columns = columns.selectExpr("*", *T.ratio_columns({"current_cc_util", "current_pl_util"}))
    return columns.select(*base.columns, customer_category().alias("customer_category"))


def feature_base(pii: DataFrame, exchange: DataFrame, batch: str, as_of: dt.date) -> DataFrame:
    """Newest identity row of each customer of a batch that was sent to the bureau.

    Newest by load date, then by score and birth date, by a maximum rather than a sort per customer.
    """
    sent = exchange.select(F.col("bureau_id").alias("customer_id")).distinct()
    newest = (
        pii.filter(F.col("batch_no") == batch)
        .groupBy("customer_id")
        .agg(F.max(F.struct("created_at", "score", "dob", "batch_no")).alias("newest"))
        .join(sent, "customer_id", "left_semi")
    )
    return newest.select(
        "customer_id",
        F.col("newest.score").alias("score"),
        F.col("newest.dob").alias("dob"),
        F.col("newest.batch_no").alias("batch_no"),
        age_years(F.col("newest.dob"), as_of).alias("age"),
        F.lit(1).cast("bigint").alias("rnk"),
    )


def add_tli(
    pii: DataFrame, exchange: DataFrame, ar: DataFrame, enq: DataFrame, batch: str, as_of: dt.date
) -> DataFrame:
    """The full customer feature table: identity base, tradelines, ratios, enquiries, delinquency, category."""
    base = feature_base(pii, exchange, batch, as_of)
    tradelines, delinquency = S.tradeline_catalogue(), T.dpd_catalogue()
    wanted = tradelines + delinquency
    enquiries = enquiry_features(of_customers(enq, base))
    counted = [c for c in enquiries.columns if c != "customer_id"]
    # The accounts come last, so that no wide row is shuffled.
    joined = T.with_slots(base.join(enquiries, "customer_id", "left"), ar, wanted, base.select("customer_id"))
    columns = joined.selectExpr(*base.columns, *T.slot_columns(wanted), *counted, "slots is null as without_accounts")
    ratios = [
        f"if(without_accounts, null, {T.ratio(b, a)}) as {name}" for name, b, a in S.utilisation_ratios()
    ]
    order = [f.name for f in tradelines] + [name for name, _, _ in S.utilisation_ratios()] + counted
    order += [f.name for f in delinquency]
    return columns.selectExpr("*", *ratios).selectExpr(
        "customer_id", "score", "dob", "age", "rnk", *order,
        f"{category_sql()} as customer_category", "batch_no", f"date '{as_of}' as created_at",
    )
