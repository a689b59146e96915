"""Registered cleaning, parsing, quality and report queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadforge.catalog.shape import comparable, day, dbl
from leadforge.catalog.views import Views, oracle
from leadforge.functions import codes
from leadforge.functions import dates as D
from leadforge.functions import text as X
from leadforge.operators import cleaning as C
from leadforge.operators import quality as Q
from leadforge.operators import reports as R

QUERIES: dict = {}
ORACLES: dict = {}


def _register(key, query, sql, *views):
    QUERIES[key] = lambda spark, folder: comparable(query(Views(spark, folder)))
    ORACLES[key] = oracle(sql, *views)


DAY_MASKS = ("%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y", "%Y/%m/%d", "%Y-%m-%d", "%Y.%m.%d", "%m/%d/%Y", "%m-%d-%Y")
OFFER_MASKS = DAY_MASKS + ("%d/%m/%y", "%d-%m-%y", "%d/%b/%Y", "%d-%b-%Y")


def parsed_day(column: str, masks=DAY_MASKS) -> str:
    return "cast(coalesce(" + ", ".join(f"try_strptime({column}, '{m}')" for m in masks) + ") as date)"


def amount_sql(column: str) -> str:
    return f"try_cast(regexp_replace({column}, '[^0-9.-]', '', 'g') as decimal(10,2))"


def email_sql(column: str) -> str:
    stripped = f"regexp_replace(lower({column}), '[\\\\\"\\s]+', '', 'g')"
    return f"regexp_replace(regexp_replace({stripped}, '[;:,]+$', ''), '@gmail\\.(com|con|co)$', '@gmail.com')"


_register(
    "parse_date_8",
    lambda v: v.dirty_text.select("event_id", "date_text", D.parse_date(F.col("date_text")).alias("parsed")),
    f"select event_id, date_text, {day(parsed_day('date_text'))} as parsed from dirty_text", "dirty_text",
)
_register(
    "parse_date_15",
    lambda v: v.offers_raw.select("customer_number", "offer_expiry_date", D.parse_offer_date(F.col("offer_expiry_date")).alias("parsed")),
    f"select customer_number, offer_expiry_date, {day(parsed_day('trim(offer_expiry_date)', OFFER_MASKS))} as parsed from offers_raw", "offers_raw",
)
_register(
    "parse_inquiry_time",
    lambda v: v.dirty_text.select("event_id", D.inquiry_date(F.col("inq_time_text")).alias("inq_time")),
    f"select event_id, {day('''cast(try_strptime(split_part(inq_time_text, ' ', 1), '%d-%b-%y') as date)''')} as inq_time from dirty_text", "dirty_text",
)
_register(
    "parse_amount",
    lambda v: v.dirty_text.select("event_id", "amount_text", X.parse_amount(F.col("amount_text")).alias("amount")),
    f"select event_id, amount_text, {dbl(amount_sql('amount_text'))} as amount from dirty_text", "dirty_text",
)
_register(
    "clean_email",
    lambda v: v.emails.select("customer_id", "email", X.clean_email(F.col("email")).alias("cleaned")),
    f"select customer_id, email, {email_sql('email')} as cleaned from emails", "emails",
)
_register(
    "date_to_text",
    lambda v: v.enquiries.select("customer_id", D.date_text(F.col("inq_date")).alias("inq_date")),
    "select customer_id, strftime(inq_date, '%d/%m/%Y') as inq_date from enquiries", "enquiries",
)
_register(
    "strip_prefix",
    lambda v: v.scores.select(F.substring(F.concat(F.lit("PRFR"), "customer_id"), 5, 2**30).alias("bureau_id"), F.col("customer_id")),
    "select substring('PRFR' || customer_id, 5) as bureau_id, customer_id from scores", "scores",
)
_register(
    "repeated_header_filter",
    lambda v: C.drop_repeated_headers(v.dirty_text, "BALANCE_DT").select("event_id", "balance_dt"),
    "select event_id, balance_dt from dirty_text where balance_dt <> 'BALANCE_DT' and balance_dt <> 'balance_dt'", "dirty_text",
)


def _landing(v: Views):
    """Dirty text in the shape of a landing file."""
    return v.dirty_text.select(
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("CUSTOMER_ID"),
        F.col("date_text").alias("OPEN_DT"), F.col("date_text").alias("DOB"), F.col("amount_text").alias("BALANCE_AM_01"),
        F.col("amount_text").alias("AMOUNT"), F.col("amount_text").alias("BALANCE_AM"), F.col("balance_dt").alias("BALANCE_DT"),
        F.concat(F.lit("+91"), F.lpad(F.col("event_id").cast("string"), 10, "9")).alias("PHONE"),
    )


LANDING_SQL = f"""select 'C' || cast(user_id as varchar) as CUSTOMER_ID, {day(parsed_day('date_text'))} as OPEN_DT, {day(parsed_day('date_text'))} as DOB,
 {dbl(amount_sql('amount_text'))} as BALANCE_AM_01, {dbl(amount_sql('amount_text'))} as AMOUNT, amount_text as BALANCE_AM, {day(parsed_day('balance_dt'))} as BALANCE_DT,
 right('+91' || lpad(cast(event_id as varchar), 10, '9'), 10) as PHONE from dirty_text where balance_dt <> 'BALANCE_DT' and balance_dt <> 'balance_dt'"""
_register("parse_file_columns", lambda v: C.parse_columns(_landing(v)), LANDING_SQL, "dirty_text")
_register(
    "drop_null_key",
    lambda v: v.partners_raw.dropna(subset=["hashed_phone"]).select("partner_reference_id", "hashed_phone"),
    "select partner_reference_id, hashed_phone from partners_raw where hashed_phone is not null", "partners_raw",
)
_register(
    "dedupe_rows",
    lambda v: C.dedupe_rows(v.partners_raw.select("hashed_phone", "phone", "partner_name", "batch_no")),
    "select distinct hashed_phone, phone, partner_name, batch_no from partners_raw", "partners_raw",
)
_register(
    "column_rename_rules",
    lambda v: C.clean_names(v.enquiries.selectExpr(
        "customer_id as `Customer Id`", "inq_purp_cd as `INQ-PURP  CD`", "amount as `'AMOUNT'`", "m_sub_id as `SECTOR/type`")),
    f"select customer_id as \"Customer_Id\", inq_purp_cd as \"INQ_PURP_CD\", {dbl('amount')} as \"AMOUNT\", m_sub_id as \"SECTOR\" from enquiries", "enquiries",
)
_register(
    "reference_rename",
    lambda v: C.rename_reference(v.partners_raw.selectExpr(
        "partner_reference_id as MEMBER_REFERENCE", "phone as PHONE_NUMBER_1", "hashed_phone as PHONE_NUMBER_2", "name as NAME")),
    "select partner_reference_id as CUSTOMER_ID, phone as PHONE_NUMBER, name as NAME from partners_raw", "partners_raw",
)
_register(
    "score_rename",
    lambda v: C.rename_score(v.scores.selectExpr("customer_id as CUST_ID", "score_v3 as SCORE_V3")),
    f"select customer_id as CUSTOMER_ID, {dbl('score_v3')} as SCORE_V3 from scores", "scores",
)


def _decoded(v: Views):
    spark = v.spark
    lines = v.tradelines.select("acct_type_cd").groupBy("acct_type_cd").agg(F.count(F.lit(1)).alias("accounts"))
    typed = codes.decode(lines, "acct_type_cd", codes.account_types(spark), "type_")
    return codes.decode(typed, "acct_type_cd", codes.labels(spark, codes.SUIT_FILED_CODES), "suit_")


def _values(rows) -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x).lower()
    return ", ".join("(" + ", ".join(quote(c) for c in row) + ")" for row in rows)


_register(
    "code_lookup", _decoded,
    f"""with t(code, description, account_class, is_card) as (values {_values((c, d, g, d in codes.CARD_ACCOUNTS) for c, (d, g) in codes.ACCOUNT_TYPES.items())}),
 s(code, description, is_decline) as (values {_values((c, d, d in codes.DECLINE_STATUSES) for c, d in codes.SUIT_FILED_CODES.items())})
 select l.acct_type_cd, count(*) as accounts, any_value(t.description) as type_description, any_value(t.account_class) as type_account_class, any_value(t.is_card) as type_is_card,
 any_value(s.description) as suit_description, any_value(s.is_decline) as suit_is_decline
 from tradelines l left join t on t.code = l.acct_type_cd left join s on s.code = l.acct_type_cd group by l.acct_type_cd""",
    "tradelines",
)

# -- quality ----------------------------------------------------------------------------------------

_register(
    "validate_not_null",
    lambda v: Q.null_report(v.partners_raw, ["partner_reference_id", "hashed_phone", "pan_no"]),
    """select c as column_name, n as null_count, n = 0 as is_valid from (select unnest(['partner_reference_id', 'hashed_phone', 'pan_no']) as c,
 unnest([count(*) - count(partner_reference_id), count(*) - count(hashed_phone), count(*) - count(pan_no)]) as n from partners_raw)""",
    "partners_raw",
)
_register(
    "validate_threshold",
    lambda v: Q.threshold_report(v.partners_raw, F.col("hashed_phone").isNull(), 0.005, "phone present"),
    f"""select 'phone present' as check_name, count(*) - count(hashed_phone) as failed_count, count(*) as total_count,
 {dbl('(count(*) - count(hashed_phone)) / count(*)')} as failure_rate, (count(*) - count(hashed_phone)) / count(*) <= 0.005 as is_valid from partners_raw""",
    "partners_raw",
)
_register(
    "duplicate_keys",
    lambda v: Q.duplicate_keys(v.partners_raw, ["hashed_phone"]),
    "select hashed_phone, count(*) as row_count from partners_raw group by 1 having count(*) > 1", "partners_raw",
)

# -- reports ----------------------------------------------------------------------------------------

# File names of a day's loads: one per part, with rows read and kept, derived from the orders.
FILES_SQL = """select (case o_orderkey % 9 when 0 then 'x_ar_' when 1 then 'NAME_DOB_' when 2 then 'march_score_' when 3 then 'unknown_' when 4 then 'PHONE_' when 5 then 'fintech_enq_' when 6 then 'Email ' when 7 then 'pii_' else 'Address-' end)
 || cast(o_orderkey % 100 as string) || '.txt' as file_name, 'batch_' || cast(o_orderkey % 3 + 1 as string) as batch,
 case when o_orderkey % 10 = 0 then 'Failed' else 'Processed' end as status, o_custkey as original_count, o_custkey - o_custkey % 7 as final_count from {orders}"""


def _files(v: Views):
    return v.spark.sql(FILES_SQL, orders=v.table("orders"))


FILES_CTE = f"files as ({FILES_SQL.format(orders='orders')})"


def _route_sql(column: str, tables) -> str:
    return "case " + " ".join(f"when lower({column}) like '%{t.lower().replace('_', chr(92) + '_')}%' escape '{chr(92)}' then '{t}'" for t in tables) + " end"


_register(
    "file_to_table_route",
    lambda v: _files(v).select("file_name").distinct().select(
        "file_name", R.route(F.col("file_name"), R.EXPERIAN_TABLES).alias("experian_table"), R.route(F.col("file_name"), R.EQUIFAX_TABLES).alias("equifax_table")),
    f"with {FILES_CTE} select distinct file_name, {_route_sql('file_name', R.EXPERIAN_TABLES)} as experian_table, {_route_sql('file_name', R.EQUIFAX_TABLES)} as equifax_table from files",
)
REPORT_SQL = f"""{FILES_CTE}, steps as (select *, case {' '.join(f"when contains(lower(file_name), '{n.lower()}') then '{n}'" for n in R.STANDARD_NAMES)} else file_name end as folded from files),
 report as (select folded as file_name, batch, status, count(*) as nnr_of_files, cast(sum(original_count) as bigint) as original_count, cast(sum(final_count) as bigint) as final_count,
 cast(sum(original_count - final_count) as bigint) as duplicates_and_nulls from steps group by folded, batch, status)"""
_register("load_report", lambda v: R.load_report(_files(v)), f"with {REPORT_SQL} select * from report")


def _stored(v: Views):
    return {"ENQ": v.enquiries, "SCORE": v.scores, "AR": v.tradelines}


STORED_SQL = """stored as (select 'ENQ' as file_name, batch_no as batch, count(*) as stored_count from enquiries group by 1, 2
 union select 'SCORE' as file_name, batch_no as batch, count(*) as stored_count from scores group by 1, 2
 union select 'AR' as file_name, batch_no as batch, count(*) as stored_count from tradelines group by 1, 2)"""
_register("stored_counts_report", lambda v: R.stored_counts(_stored(v), "batch_1"),
          f"with {STORED_SQL} select * from stored where batch = 'batch_1'", "enquiries", "scores", "tradelines")
_register("union_counts", lambda v: R.stored_counts(_stored(v)), f"with {STORED_SQL} select * from stored", "enquiries", "scores", "tradelines")
_register(
    "report_merge",
    lambda v: R.merged_report(R.load_report(_files(v)), R.stored_counts(_stored(v))),
    f"with {STORED_SQL}, {REPORT_SQL} select r.*, s.stored_count from report r left join stored s on s.file_name = r.file_name and s.batch = r.batch",
    "enquiries", "scores", "tradelines",
)
