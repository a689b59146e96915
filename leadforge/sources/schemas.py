"""Landing and table schemas. Landing columns are text; the key column is required."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(key: str, *others: str) -> T.StructType:
    fields = [T.StructField(key, T.StringType(), False)]
    return T.StructType(fields + [T.StructField(name, T.StringType()) for name in others])


def _numbered(stem: str, last: int) -> list[str]:
    return [f"{stem}_{n:02d}" for n in range(1, last + 1)]


# Column names of the bureau landing files.
EXPERIAN = {
    "ADDRESS": _text("CUSTOMER_ID", "ADDRESS", "PINCODE", "DATE_REPORTED"),
    "AR": _text(
        "CUSTOMER_ID", "ACCT_KEY", "ACCOUNT_NB", "M_SUB_ID", "ACCT_TYPE_CD", "OPEN_DT", "ACTUAL_PAYMENT_AM",
        "ASSET_CLASS_CD", "BALANCE_AM", "BALANCE_DT", "CHARGE_OFF_AM", "CLOSED_DT", "CREDIT_LIMIT_AM", "DAYS_PAST_DUE",
        "DFLT_STATUS_DT", "LAST_PAYMENT_DT", "ORIG_LOAN_AM", "PAST_DUE_AM", "PAYMENT_HISTORY_GRID",
        "SUIT_FILED_WILLFUL_DFLT", "WRITTEN_OFF_AND_SETTLED_STATUS", "WRITE_OFF_STATUS_DT", "RESPONSIBILITY_CD",
        "EMI_AMT", "INTEREST_RATE", "TENURE", "PORTFOLIO_RATING_TYPE_CD",
        *_numbered("ACTUAL_PAYMENT_AM", 48), *_numbered("BALANCE_AM", 48), *_numbered("CREDIT_LIMIT_AM", 48),
        *_numbered("PAST_DUE_AM", 48), *_numbered("PAYMENT_RATING_CD", 24), *_numbered("DAYS_PAST_DUE", 48),
        *_numbered("LAST_PYMT_DT", 48),
    ),
    "EMAIL": _text("CUSTOMER_ID", "EMAIL", "DATE_REPORTED"),
    "ENQ": _text("CUSTOMER_ID", "INQ_PURP_CD", "INQ_DATE", "M_SUB_ID", "AMOUNT"),
    "ID": _text("CUSTOMER_ID", "PAN", "PASSPORT", "VOTER_ID", "UID", "RATION_CARD", "DRIVING_LICENSE"),
    "NAME_DOB": _text("CUSTOMER_ID", "FULL_NAME", "DOB", "GENDER"),
    "PHONE": _text("CUSTOMER_ID", "PHONE", "DATE_REPORTED"),
    "SCORE": _text("CUST_ID", "SCORE_V3"),
}
REFERENCE = _text("MEMBER_REFERENCE", "NAME", "PAN_NO", "DATE_OF_BIRTH", "PHONE_NUMBER", "PIN")
EQUIFAX = {
    "PII": _text(
        "REFERENCE_NO", "MATCHED_ACCT_NBR", "EMAIL_ADDR_1", "EMAIL_ADDR_1_DT_RPTED", "BRTH_DT", "PHN_NBR", "PHN_NBR_2",
        "PHN_NBR_3", "ADDR_LN", "ADDR_LN_2", "ADDR_LN_3", "ADDR_ST", "ADDR_ST_2", "ADDR_ST_3", "ADDR_1_CTY",
        "ADDR_1_ZIP", "ADDR_2_ZIP", "ADDR_3_ZIP", "ADDR_1_CHNG_DT", "ADDR_2_CHNG_DT", "ADDR_3_CHNG_DT", "ACCT_UNIQ_ID",
        "REC_SEQ_NBR", "MATCHED_CSMR_NBR", "PAN", "PASSPORT", "VOTER", "DL", "ADHAR", "IN_NAME", "ROUTE_FLG", "AGE",
        "GENDER_CD",
    ),
    "AR": _text(
        "REFERENCE_NO", "REPORTNUMBER", "ACCT_NUMBER", "ACCOUNTSTATUS", "ACCOUNTTYPE", "ASSETCLASSIFICATION", "BALANCE",
        "SANCTIONAMOUNT", "COLLATERALTYPE", "COLLATERALVALUE", "CREDITLIMIT", "DATECLOSED", "DATEOPENED",
        "DATEREPORTED", "HIGHCREDIT", "INSTALLMENTAMOUNT", "INTERESTRATE", "LASTPAYMENT", "LASTPAYMENTDATE",
        "OWNERSHIPTYPE", "PASTDUEAMOUNT", "REPAYMENTTENURE", "TERMFREQUENCY", "TERMS_FREQUENCY", "SUITFILEDSTATUS",
        "WRITEOFFAMOUNT", "ACCOUNTSTATUS_HISTORY", "ASSETCLASS_HISTORY", "SUITFILED_HISTORY", "ACCT_UNIQ_ID",
        "CSMR_NBR", "CLIENT_ID", "SCORE", "SELF_TRADE", "SECTOR", "DAYS_PAST_DUE",
    ),
    "ENQ": _text("REFERENCE_NO", "TRAN_ID", "INQ_TIME", "TRAN_AMT", "INQ_PURPOSE", "SELF_TRADE", "SECTOR"),
}
BUREAUS = {"experian": EXPERIAN, "equifax": EQUIFAX}

PARTNER_FILE = _text(
    "PARTNER_REFERENCE_ID", "HASHED_PHONE", "MASKED_PHONE", "PHONE", "PAN_NO", "NAME", "PARTNER_NAME"
)
LENDER_OFFERS = _text(
    "CUSTOMER_NUMBER", "MOBILE_NO", "CUSTOMER_NAME", "PERSONAL_EMAIL_ID", "GENDER", "RESI_PINCODE", "PAN_NO",
    "MONTHLY_INCOME", "OFFER_EXPIRY_DATE", "APPROVED_LOAN_AMOUNT", "ROI", "CIBIL_SCRUB_DATE", "MIN_TENURE_BY_POLICY",
    "MAX_TENURE_BY_POLICY", "MAX_EMI", "MIN_TOP_UP_AMOUNT", "PROCESSING_FESS", "OFFER_STATUS", "PERSONAL_EMAIL_ID2",
    "OVERLAP_FLAG",
)


# Columns and types of the stored tables.
TABLES = {
    "partners_master": "partner_id string, partner_name string, created_at date",
    "partners_raw": """partner_reference_id string, hashed_phone string, masked_phone string, phone string, pan_no string,
        name string, partner_name string, batch_no string, filename string, status string, created_at date,
        partner_id string""",
    "partners_processed": """partner_reference_id string, lead_id string, hashed_phone string, masked_phone string,
        phone string, pan_no string, name string, partner_name string, batch_no string, created_at date,
        sent_to_scrub boolean, scrub_date date, partner_id string""",
    "phone_base": "lead_id string, hashed_phone string, phone string",
    "equifax_exchange": """lead_id string, bureau_id string, hashed_phone string, phone string, pan_no string,
        scrub_batch_no string, scrub_date date, sent_to_experian boolean""",
    "experian_exchange": """lead_id string, bureau_id string, hashed_phone string, phone string, pan_no string,
        scrub_batch_no string, scrub_date date""",
    "pii_master": """customer_id string, mobile_number string, latest_mobile string, masked_phone string, full_name string,
        pan_number string, pan_flag string, masked_pan string, gender string, dob date, mobile_list string,
        pincode string, pincode_list string, address_list string, latest_address string, score decimal(10,2),
        status string, batch_no string, created_at date""",
    "lenders_master": """created_at date, id string, lender_code string, lender_name string, bureau_type string,
        policy_version string, eligible_criteria string, is_active boolean, format_metadata string""",
    "lenders_shortlisted": """created_at date, bureau_id string, lender_uid string, lender_batch string,
        lender_name string, bureau_type string""",
    "lender_offers": """created_at date, lender_uid string, lender_name string, loan_amount decimal(10,2), roi string,
        tenure string, offer_expiry_date date, lenders_attribute string""",
}
