"""Registered lender mapping, rule and offer queries and their SQL twins."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from leadforge.catalog.cleaning import OFFER_MASKS, amount_sql, parsed_day
from leadforge.catalog.features import features_sql
from leadforge.catalog.shape import comparable, day, dbl
from leadforge.catalog.views import AS_OF, Views, oracle
from leadforge.operators import cleaning as C
from leadforge.operators import lender_views as LV
from leadforge.operators import rules as R
from leadforge.operators.features import spec as S
from leadforge.operators.features import tradelines as T
from leadforge.operators.mapping import apply_mapping, map_offers

QUERIES: dict = {}
ORACLES: dict = {}


def _register(key, query, sql, *views):
    QUERIES[key] = lambda spark, folder: comparable(query(Views(spark, folder)))
    ORACLES[key] = oracle(sql, *views)


MAPPING = {"columns": [
    {"source": "customer_id", "target": "CUSTOMER_ID"},
    {"source": "amount", "target": "AMOUNT"},
    {"source": "inq_date", "target": "INQ_DATE", "transform": "TO_CHAR(inq_date,'DD/MM/YYYY')"},
    {"source": "inq_purp_cd", "target": "PURPOSE", "transform": "case when inq_purp_cd = '13' then 'personal' else 'other' end"},
    {"source": None, "default": "", "target": "NAME"},
    {"target": "NOTHING"},
]}
_register(
    "dynamic_mapping",
    lambda v: apply_mapping(v.enquiries, MAPPING, id_prefix="XX"),
    f"""select 'XX' || customer_id as CUSTOMER_ID, {dbl('amount')} as AMOUNT, strftime(inq_date, '%d/%m/%Y') as INQ_DATE,
 case when inq_purp_cd = '13' then 'personal' else 'other' end as PURPOSE, '' as NAME, cast(null as varchar) as NOTHING from enquiries""",
    "enquiries",
)


def _text_day(expression: str) -> str:
    return f"strftime({expression}, '%d/%m/%Y')"


# Source frames of the lender views; columns that no view has are NULL in every engine.
SOURCES = {
    "AR": ("tradelines_dpd", lambda v: v.tradelines_dpd),
    "ADDRESS": ("addresses", lambda v: v.addresses),
    "ENQ": ("enquiries", lambda v: v.enquiries),
    "SCORE": ("scores", lambda v: v.scores),
    "NAME_DOB": ("name_dob", lambda v: v.name_dob),
    "PHONE": ("phones", lambda v: v.phones),
    "ID": ("ids", lambda v: v.ids),
    "EMAIL": ("emails", lambda v: v.emails),
}
# Columns each source view has, with the SQL of their comparable form.
HAVE = {
    "AR": {"customer_id": "{c}", "acct_key": "{c}", "m_sub_id": "{c}", "acct_type_cd": "{c}", "open_dt": day("{c}"), "closed_dt": day("{c}"),
           "balance_am": "{c}", "credit_limit_am": "{c}", "orig_loan_am": "{c}", "past_due_am": dbl("{c}"), "created_at": day("{c}"),
           **{f"days_past_due_{n:02d}": "cast({c} as bigint)" for n in range(1, 37)}},
    "ADDRESS": {"customer_id": "{c}", "address": "{c}", "pincode": "{c}", "date_reported": day("{c}")},
    "ENQ": {"customer_id": "{c}", "inq_purp_cd": "{c}", "inq_date": day("{c}"), "amount": dbl("{c}"), "m_sub_id": "{c}"},
    "SCORE": {"customer_id": "{c}", "score_v3": dbl("{c}")},
    "NAME_DOB": {"customer_id": "{c}", "full_name": "{c}", "dob": day("{c}"), "gender": "{c}"},
    "PHONE": {"customer_id": "{c}", "phone": "{c}", "date_reported": day("{c}")},
    "ID": {"customer_id": "{c}", "pan": "{c}"},
    "EMAIL": {"customer_id": "{c}", "email": "{c}", "date_reported": day("{c}")},
}


def _view_sql(layout: dict, prefix: str, table: str, view: str) -> str:
    columns = []
    for rule in layout["columns"]:
        source, target = rule.get("source"), rule["target"]
        if source and source.lower() == "customer_id":
            sql = f"'{prefix}' || customer_id"
        elif source and source.lower() not in HAVE[table]:
            sql = "cast(null as varchar)"
        elif "TO_CHAR" in rule.get("transform", ""):
            sql = _text_day(source)
        elif "SHA2" in rule.get("transform", ""):
            sql = f"sha256({source})"
        elif source:
            sql = HAVE[table][source.lower()].format(c=source)
        else:
            sql = f"'{rule['default']}'"
        columns.append(f"{sql} as {target}")
    return f"select {', '.join(columns)} from {view}"


def _needs(view: str) -> tuple[str, ...]:
    return ("tradelines", "tradelines_dpd") if view == "tradelines_dpd" else (view,)


for _table in LV.PREFR:
    _view, _frame = SOURCES[_table]
    _register(
        f"lender_view_prefr_{_table.lower()}",
        lambda v, t=_table, f=_frame: LV.lender_view(f(v), "prefr", "experian", t),
        _view_sql(LV.PREFR[_table], "PRFR", _table, _view), *_needs(_view),
    )
for _table in LV.ZYPE_EXPERIAN:
    _view, _frame = SOURCES[_table]
    _register(
        f"lender_view_zype_ex_{_table.lower()}",
        lambda v, t=_table, f=_frame: LV.lender_view(f(v), "zype", "experian", t),
        _view_sql(LV.ZYPE_EXPERIAN[_table], "ZPEX", _table, _view), *_needs(_view),
    )


def _equifax_frame(v: Views, table: str):
    """Equifax-shaped rows over the views."""
    if table == "AR":
        return v.equifax_ar.selectExpr("reference_no", "score", "batch_no as sector")
    if table == "ENQ":
        return v.enquiries.selectExpr("customer_id as reference_no", "inq_purp_cd as inq_purpose", "cast(amount as string) as tran_amt", "m_sub_id as sector")
    return v.ids.join(v.name_dob, "customer_id").selectExpr("customer_id as reference_no", "pan", "full_name as in_name", "gender as gender_cd")


_EQUIFAX_SQL = {
    "AR": ("(select reference_no, score, batch_no as sector from equifax_ar)", ("equifax_ar",), {"score", "sector"}),
    "ENQ": ("(select customer_id as reference_no, inq_purp_cd as inq_purpose, cast(amount as varchar) as tran_amt, m_sub_id as sector from enquiries)",
            ("enquiries",), {"inq_purpose", "tran_amt", "sector"}),
    "PII": ("(select i.customer_id as reference_no, i.pan, n.full_name as in_name, n.gender as gender_cd from ids i join name_dob n on n.customer_id = i.customer_id)",
            ("ids", "name_dob"), {"pan", "in_name", "gender_cd"}),
}
for _table, (_from, _views, _have) in _EQUIFAX_SQL.items():
    _targets = [r["target"] for r in LV.ZYPE_EQUIFAX[_table]["columns"]]
    _columns = ", ".join(
        "'ZPEQ' || reference_no as CUSTOMER_ID" if t == "CUSTOMER_ID" else (f"{t.lower()} as {t}" if t.lower() in _have else f"cast(null as varchar) as {t}")
        for t in _targets
    )
    _register(
        f"lender_view_zype_eq_{_table.lower()}",
        lambda v, t=_table: LV.lender_view(_equifax_frame(v, t), "zype", "equifax", t),
        f"select {_columns} from {_from}", *_views,
    )

# -- rules -------------------------------------------------------------------------------------------

PREFR_CRITERIA = {
    "logic": "AND",
    "rules": [
        {"field": "score", "operator": ">=", "value": 690},
        {"field": "nbr_cc", "operator": ">=", "value": 1},
        {"field": "dpd_m03_all", "operator": "=", "value": 10},
    ],
    "version": "v0",
}
_register(
    "score_rule_shortlist",
    lambda v: R.shortlist_ids(v.scores, PREFR_CRITERIA, "customer_id", score_col="score_v3", score_only=True),
    "select distinct customer_id as id from scores where score_v3 >= 690", "scores",
)
_register(
    "distinct_ids",
    lambda v: R.shortlist_ids(v.tradelines.join(v.scores.select("customer_id", "score_v3"), "customer_id"), PREFR_CRITERIA, "customer_id", score_col="score_v3", score_only=True),
    "select distinct t.customer_id as id from tradelines t join scores s on s.customer_id = t.customer_id where s.score_v3 >= 690", "tradelines", "scores",
)


def _scored_features(v: Views):
    names = {"nbr_cc"}
    features = [f for f in S.tradeline_catalogue() if f.name in names] + [f for f in T.dpd_catalogue() if f.name == "max_dpd_l3m_all"]
    return v.scores.select("customer_id", F.col("score_v3").alias("score")).join(T.block_features(v.tradelines_dpd, features), "customer_id", "left")


RULE_FEATURES = [f for f in S.tradeline_catalogue() if f.name == "nbr_cc"] + [f for f in T.dpd_catalogue() if f.name == "max_dpd_l3m_all"]
_register(
    "criteria_all_rules",
    lambda v: R.shortlist_ids(_scored_features(v), PREFR_CRITERIA, "customer_id", aliases={"dpd_m03_all": "max_dpd_l3m_all"}),
    f"""select distinct s.customer_id as id from scores s join ({features_sql(RULE_FEATURES, 'tradelines_dpd')}) f on f.customer_id = s.customer_id
 where s.score_v3 >= 690 and f.nbr_cc >= 1 and f.max_dpd_l3m_all = 10""",
    "tradelines", "tradelines_dpd", "scores",
)
_register(
    "shortlist_record",
    lambda v: R.shortlist_record(
        v.scores.filter("score_v3 >= 690").select(F.concat(F.lit("PRFR"), "customer_id").alias("CUSTOMER_ID")), "CUSTOMER_ID", "lender_batch_1", "prefr", "experian", AS_OF),
    """select '2002-01-01' as created_at, customer_id as bureau_id, 'PRFR' || customer_id as lender_uid, 'lender_batch_1' as lender_batch, 'prefr' as lender_name, 'experian' as bureau_type
 from scores where score_v3 >= 690""", "scores",
)
_register(
    "shortlist_filter_files",
    lambda v: R.filter_by_ids(
        v.enquiries.select("customer_id", "inq_purp_cd", "amount"),
        R.shortlist_ids(v.scores, PREFR_CRITERIA, "customer_id", score_col="score_v3", score_only=True), "customer_id"),
    f"select customer_id, inq_purp_cd, {dbl('amount')} as amount from enquiries where customer_id in (select customer_id from scores where score_v3 >= 690)",
    "enquiries", "scores",
)

# One criteria text per lender name found in the customers' market segments; some are empty or broken.
CRITERIA_TEXT = json.dumps(PREFR_CRITERIA)
LENDERS_SQL = f"""select c_mktsegment || '-' || cast(c_nationkey as string) as lender_name, 'experian' as bureau_type,
 case when c_nationkey % 5 = 0 then null when c_nationkey % 5 = 1 then 'not json' else '{CRITERIA_TEXT}' end as eligible_criteria
 from {{customer}} group by c_mktsegment, c_nationkey"""


def _lenders(v: Views):
    escaped = LENDERS_SQL.replace("{", "{{").replace("}", "}}").replace("{{customer}}", "{customer}")
    return v.spark.sql(escaped, customer=v.table("customer"))


_register(
    "json_criteria",
    lambda v: R.criteria_rows(_lenders(v)),
    f"""with lenders as ({LENDERS_SQL.replace('{customer}', 'customer')}),
 rules as (select lender_name, bureau_type, 'AND' as logic, 'v0' as version, unnest(['score', 'nbr_cc', 'dpd_m03_all']) as field, unnest(['>=', '>=', '=']) as operator,
 unnest([690.0::double, 1.0::double, 10.0::double]) as value from lenders where eligible_criteria is not null and eligible_criteria <> 'not json') select * from rules""",
)

# -- offers ------------------------------------------------------------------------------------------

OFFER_JSON = "'{' || '\"mobile_no\":\"' || mobile_no || '\"' || case when offer_status is not null then ',\"offer_status\":\"' || offer_status || '\"' else '' end || '}'"


def offers_sql(amount: str, expiry: str) -> str:
    return f"""select '2002-01-01' as CREATED_AT, customer_number as LENDER_UID, '0' as LENDER_NAME, {amount} as LOAN_AMOUNT, roi as ROI, max_tenure_by_policy as TENURE,
 {expiry} as OFFER_EXPIRY_DATE, {OFFER_JSON} as LENDERS_ATTRIBUTE from offers_raw"""


_register(
    "map_to_offers_schema", lambda v: map_offers(v.offers_raw, AS_OF),
    offers_sql("approved_loan_amount", "offer_expiry_date"), "offers_raw",
)
_register(
    "object_to_json",
    lambda v: v.offers_raw.select("customer_number", F.to_json(F.struct("mobile_no", "offer_status")).alias("attributes")),
    f"select customer_number, {OFFER_JSON} as attributes from offers_raw", "offers_raw",
)


def _parsed_offers(v: Views):
    upper = v.offers_raw.toDF(*[c.upper() for c in v.offers_raw.columns])
    return C.parse_offer_columns(upper)


_register(
    "offers_parsed",
    lambda v: _parsed_offers(v).select("CUSTOMER_NUMBER", "APPROVED_LOAN_AMOUNT", "OFFER_EXPIRY_DATE"),
    f"select customer_number as CUSTOMER_NUMBER, {dbl(amount_sql('approved_loan_amount'))} as APPROVED_LOAN_AMOUNT, {day(parsed_day('trim(offer_expiry_date)', OFFER_MASKS))} as OFFER_EXPIRY_DATE from offers_raw",
    "offers_raw",
)
