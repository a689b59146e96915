"""Config-driven column mappings for lender views and offers."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spark_transform(expression: str) -> str:
    """The two warehouse idioms that mapping files use, in Spark's spelling; other SQL passes unchanged."""
    dated = re.sub(r"(?i)to_char\(([^,()]+),\s*'DD/MM/YYYY'\)", r"date_format(\1, 'dd/MM/yyyy')", expression)
    return re.sub(r"(?i)sha2\(([^,()]+)\)", r"sha2(\1, 256)", dated)


def _target(rule: dict) -> Column:
    if rule.get("transform"):
        c = F.expr(spark_transform(rule["transform"]))
    elif rule.get("source"):
        c = F.col(rule["source"])
    elif rule.get("default") is not None:
        c = F.lit(rule["default"])
    else:
        c = F.lit(None).cast("string")
    return c.alias(rule["target"])


def apply_mapping(df: DataFrame, config: dict, *, id_prefix: str | None = None, id_col: str = "CUSTOMER_ID") -> DataFrame:
    """Target columns of a mapping config: SQL transform, else source column, else default, else NULL.

    A config without target columns leaves the frame unchanged. With ``id_prefix`` the id column is
    prefixed first.
    """
    if id_prefix is not None and id_col.lower() in [c.lower() for c in df.columns]:
        df = df.withColumn(id_col, F.concat(F.lit(id_prefix), F.col(id_col)))
    targets = [_target(rule) for rule in (config or {}).get("columns", []) if rule.get("target")]
    return df.select(*targets) if targets else df


# Target column of the offers table -> column of the lender's file.
OFFER_COLUMNS = {
    "LOAN_AMOUNT": "APPROVED_LOAN_AMOUNT",
    "ROI": "ROI",
    "TENURE": "MAX_TENURE_BY_POLICY",
    "OFFER_EXPIRY_DATE": "OFFER_EXPIRY_DATE",
    "LENDER_UID": "CUSTOMER_NUMBER",
}


def map_offers(df: DataFrame, as_of: dt.date, *, mapping: dict[str, str] = OFFER_COLUMNS, lender_name: str = "0") -> DataFrame:
    """One offers layout for all lenders; columns without a place in it go into a JSON text.

    NULL cells are left out of the JSON.
    """
    by_name = {c.upper(): c for c in df.columns}
    used = {source.upper() for source in mapping.values()}
    rest = [F.col(c) for upper, c in by_name.items() if upper not in used]
    attributes = F.to_json(F.struct(*rest)) if rest else F.lit("{}")
    picked = {
        target: F.col(by_name[source.upper()]) if source.upper() in by_name else F.lit(None).cast("string")
        for target, source in mapping.items()
    }
    return df.select(
        F.lit(as_of).alias("CREATED_AT"),
        picked["LENDER_UID"].alias("LENDER_UID"),
        F.lit(lender_name).alias("LENDER_NAME"),
        *[picked[t].alias(t) for t in ("LOAN_AMOUNT", "ROI", "TENURE", "OFFER_EXPIRY_DATE")],
        attributes.alias("LENDERS_ATTRIBUTE"),
    )
