"""Column layouts that each lender receives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadforge.operators.mapping import apply_mapping
from leadforge.sources.schemas import EQUIFAX

DAY_TEXT = "TO_CHAR({0},'DD/MM/YYYY')"


def _same(*names: str) -> list[dict]:
    return [{"source": n.lower(), "target": n} for n in names]


def _day(name: str) -> dict:
    return {"source": name.lower(), "target": name, "transform": DAY_TEXT.format(name.lower())}


def _blank(*names: str) -> list[dict]:
    return [{"source": None, "default": "", "target": n} for n in names]


_ID = {"source": "customer_id", "target": "CUSTOMER_ID"}

# The layouts of lender "prefr" (Experian data, personal details blanked).
PREFR = {
    "AR": {"columns": [
        _ID, *_same("ACCT_KEY", "ACCOUNT_NB", "M_SUB_ID", "ACCT_TYPE_CD"), _day("OPEN_DT"),
        *_same("ACTUAL_PAYMENT_AM", "ASSET_CLASS_CD", "BALANCE_AM"), _day("BALANCE_DT"), *_same("CHARGE_OFF_AM"),
        _day("CLOSED_DT"), *_same("CREDIT_LIMIT_AM", "DAYS_PAST_DUE"),
    ]},
    "ADDRESS": {"columns": [_ID, *_blank("ADDRESS"), *_same("PINCODE"), _day("DATE_REPORTED")]},
    "ENQ": {"columns": [_ID, *_same("INQ_PURP_CD", "M_SUB_ID", "AMOUNT"), _day("INQ_DATE")]},
    "SCORE": {"columns": [_ID, *_same("SCORE_V3")]},
    "NAME_DOB": {"columns": [_ID, *_blank("FULL_NAME"), _day("DOB"), *_same("GENDER")]},
    "PHONE": {"columns": [_ID, *_blank("PHONE", "DATE_REPORTED")]},
    "ID": {"columns": [
        _ID, {"source": "pan", "target": "PAN", "transform": "SHA2(pan)"},
        *_blank("PASSPORT", "VOTER_ID", "UID", "RATION_CARD", "DRIVING_LICENSE"),
    ]},
    "EMAIL": {"columns": [_ID, *_blank("EMAIL", "DATE_REPORTED")]},
}

# Columns of the Equifax files that lender "zype" does not get.
ZYPE_WITHHELD = {
    "AR": {"REPORTNUMBER", "ACCT_NUMBER", "ASSETCLASSIFICATION", "COLLATERALTYPE", "COLLATERALVALUE", "CSMR_NBR",
           "CLIENT_ID", "SELF_TRADE"},
    "PII": set(),
    "ENQ": {"SELF_TRADE"},
}
ZYPE_EQUIFAX = {
    table: {"columns": [
        {"source": f.name, "target": "CUSTOMER_ID" if f.name == "REFERENCE_NO" else f.name}
        for f in EQUIFAX[table].fields if f.name not in withheld
    ]}
    for table, withheld in ZYPE_WITHHELD.items()
}

# The layouts of lender "zype" over Experian data (source, target).
ZYPE_EXPERIAN = {
    "AR": {"columns": [
        _ID, *_same("ACCT_KEY"), {"source": "created_at", "target": "BEREAU_DATE"},
        {"source": "m_sub_id", "target": "SECTOR"}, *_same("ACCT_TYPE_CD", "OPEN_DT"),
        {"source": "balance_am", "target": "CUR_BALANCE_AM"}, {"source": "balance_dt", "target": "REPORTED_DT"},
        *_same("CLOSED_DT", "CREDIT_LIMIT_AM", "DAYS_PAST_DUE", "LAST_PAYMENT_DT", "ORIG_LOAN_AM", "PAST_DUE_AM",
               "SUIT_FILED_WILLFUL_DFLT", "WRITTEN_OFF_AND_SETTLED_STATUS", "RESPONSIBILITY_CD", "EMI_AMT",
               "INTEREST_RATE", "TENURE", *[f"DAYS_PAST_DUE_{n:02d}" for n in range(1, 37)]),
    ]},
    "ADDRESS": {"columns": [_ID, *_same("PINCODE", "DATE_REPORTED")]},
    "ENQ": {"columns": [
        _ID, {"source": "inq_purp_cd", "target": "PURPOSE"}, *_same("INQ_DATE"),
        {"source": "m_sub_id", "target": "SECTOR"}, *_same("AMOUNT"),
    ]},
    "SCORE": {"columns": [_ID, {"source": "score_v3", "target": "SCORE"}]},
}

# Lender and bureau -> (layouts, id prefix, id column).
LENDERS = {
    ("prefr", "experian"): (PREFR, "PRFR", "CUSTOMER_ID"),
    ("zype", "equifax"): (ZYPE_EQUIFAX, "ZPEQ", "REFERENCE_NO"),
    ("zype", "experian"): (ZYPE_EXPERIAN, "ZPEX", "CUSTOMER_ID"),
}


def lender_view(df: DataFrame, lender: str, bureau: str, table: str) -> DataFrame:
    """A bureau table in the layout of a lender; source columns the frame lacks are NULL."""
    layouts, prefix, id_col = LENDERS[lender, bureau]
    config = layouts[table]
    have = {c.lower() for c in df.columns}
    missing = {r["source"] for r in config["columns"] if r.get("source") and r["source"].lower() not in have}
    complete = df.withColumns({name: F.lit(None).cast("string") for name in missing}) if missing else df
    return apply_mapping(complete, config, id_prefix=prefix, id_col=id_col)
