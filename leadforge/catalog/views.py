"""Domain views over the given tables, in SQL that Spark and DuckDB both read.

The given tables are orders, line items, customers and events; these views give them the shape of leads,
bureau exchanges, tradelines, enquiries and identity records. Every view covers its whole tables; rows
that are meant to match nothing have keys of their own.
"""

from __future__ import annotations

import datetime as dt
import json
import re

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(2002, 1, 1)

VIEWS = {
    "phone_base": """
select 'L' || lpad(cast(c_custkey as string), 8, '0') as lead_id,
       (case when c_custkey % 10 = 0 then 'x9' else 'h9' end) || lpad(cast(c_custkey as string), 9, '0') as hashed_phone,
       (case when c_custkey % 10 = 0 then '8' else '9' end) || lpad(cast(c_custkey as string), 9, '0') as phone
from {customer}
""",
    "partners_raw": """
select 'P' || cast(o_orderkey as string) as partner_reference_id,
       case when o_orderkey % 97 = 0 then null else 'h9' || lpad(cast(o_custkey as string), 9, '0') end as hashed_phone,
       '9' || lpad(cast(o_custkey as string), 9, '0') as phone,
       'ABC' || (case when o_custkey % 4 = 0 then 'C' else 'P' end) || 'X' || lpad(cast(o_custkey % 10000 as string), 4, '0') || 'Z' as pan_no,
       'Name ' || cast(o_custkey as string) as name,
       case o_orderkey % 3 when 0 then 'alpha' when 1 then 'beta' else 'gamma' end as partner_name,
       'batch_' || cast(o_orderkey % 4 + 1 as string) as batch_no,
       o_orderkey % 5 as file_seq, 'file_' || cast(o_orderkey % 5 as string) || '.csv' as filename,
       o_orderkey as row_seq, cast(o_orderdate as date) as created_at
from {orders}
""",
    "partners_status": """
select 'P' || cast(o_orderkey as string) as partner_reference_id,
       case when o_orderkey % 97 = 0 then null else 'h9' || lpad(cast(o_custkey as string), 9, '0') end as hashed_phone,
       case o_orderkey % 3 when 0 then 'alpha' when 1 then 'beta' else 'gamma' end as partner_name,
       case when o_orderkey % 41 = 0 then 'batch_x' else 'batch_' || cast(o_orderkey % 4 + 1 as string) end as batch_no,
       'file_' || cast(o_orderkey % 5 as string) || '.csv' as filename,
       case when o_orderkey % 4 = 2 then (case when o_orderkey % 2 = 0 then 'processed' else 'duplicate' end)
            when o_orderkey % 7 = 0 then 'duplicate' when o_orderkey % 11 = 0 then 'processed' else 'not processed' end as status,
       cast(o_orderdate as date) as created_at
from {orders}
""",
    "partners_processed": """
select 'P' || cast(o.o_orderkey as string) as partner_reference_id,
       (case when o.o_custkey % 10 = 0 then 'U' else 'L' end) || lpad(cast(o.o_custkey as string), 8, '0') as lead_id,
       'h9' || lpad(cast(o.o_custkey as string), 9, '0') as hashed_phone,
       '9' || lpad(cast(o.o_custkey as string), 9, '0') as phone,
       'PAN' || cast(o.o_custkey as string) as pan_no,
       'Name ' || cast(o.o_custkey as string) as name,
       case o.o_orderkey % 3 when 0 then 'alpha' when 1 then 'beta' else 'gamma' end as partner_name,
       'batch_' || cast(o.o_orderkey % 4 + 1 as string) as batch_no,
       o.o_orderstatus = 'F' as sent_to_scrub,
       case when o.o_orderstatus = 'F' then cast(o.o_orderdate as date) else null end as scrub_date
from {orders} o
""",
    "equifax_exchange": """
select (case when c_custkey % 10 = 0 then 'V' else 'L' end) || lpad(cast(c_custkey as string), 8, '0') as lead_id,
       (case when c_custkey % 10 = 0 then 'EQ31122001' else 'EQ01012002' end) || lpad(cast(c_custkey + 1 as string), 12, '0') as bureau_id,
       'h9' || lpad(cast(c_custkey as string), 9, '0') as hashed_phone,
       '9' || lpad(cast(c_custkey as string), 9, '0') as phone,
       'PAN' || cast(c_custkey as string) as pan_no,
       'batch_' || cast(c_custkey % 3 + 1 as string) as scrub_batch_no,
       cast('2001-10-01' as date) + cast(c_custkey % 90 as int) as scrub_date,
       c_custkey % 2 = 0 as sent_to_experian
from {customer}
""",
    "equifax_ar": """
select (case when o_custkey % 7 = 0 then 'EQ30122001' else 'EQ01012002' end) || lpad(cast(o_custkey + 1 as string), 12, '0') as reference_no,
       cast(300 + (o_custkey * 37) % 601 as string) as score,
       'batch_' || cast(o_custkey % 3 + 1 as string) as batch_no, cast(o_orderdate as date) as created_at
from {orders}
""",
    "experian_exchange": """
select (case when c_custkey % 4 = 1 then 'L' else 'W' end) || lpad(cast(c_custkey as string), 8, '0') as lead_id,
       (case when c_custkey % 4 = 1 then 'EX01012002' else 'EX31122001' end) || lpad(cast(c_custkey + 1 as string), 12, '0') as bureau_id,
       'batch_' || cast(c_custkey % 3 + 1 as string) as scrub_batch_no, cast('2001-12-01' as date) as scrub_date
from {customer}
""",
    "experian_ar": """
select (case when o_custkey % 8 = 1 then 'EX01012002' else 'EX30122001' end) || lpad(cast(o_custkey + 1 as string), 12, '0') as customer_id, cast(o_orderdate as date) as created_at
from {orders}
""",
    "tradelines": """
select 'C' || cast(o.o_custkey as string) as customer_id,
       cast(l.l_orderkey as string) || '-' || cast(l.l_linenumber as string) as acct_key,
       case l.l_partkey % 24 when 0 then '123' when 1 then '123' when 2 then '123' when 3 then '189' when 4 then '195' when 5 then '58'
            when 6 then '47' when 7 then '191' when 8 then '240' when 9 then '130' when 10 then '227' when 11 then '121' when 12 then '999'
            when 13 then '175' when 14 then '228' when 15 then '221' when 16 then '245' when 17 then '5' when 18 then '5' when 19 then '5'
            when 20 then '173' when 21 then '200' when 22 then '204' else '205' end as acct_type_cd,
       case l.l_suppkey % 11 when 0 then 'NBF' when 1 then 'NBF' when 2 then 'PVT' when 3 then 'FOR' when 4 then 'PUB' when 5 then 'MFI'
            when 6 then 'SFI' when 7 then 'RRB' when 8 then 'SFB' when 9 then 'HFC' else null end as m_sub_id,
       case when l.l_orderkey % 31 = 0 then 'n/a'
            else cast(cast(l.l_extendedprice as decimal(12,2)) * (case when l.l_partkey % 24 = 5 then 50 else 10 end) as string) end as orig_loan_am,
       cast(cast(l.l_extendedprice as decimal(12,2)) * l.l_linenumber as string) as balance_am,
       case when l.l_quantity > 25 then cast(cast(l.l_extendedprice as decimal(12,2)) * 12 as string) else null end as credit_limit_am,
       cast(case when l.l_returnflag = 'A' then l.l_quantity * 10 else 0 end as decimal(10,2)) as past_due_am,
       cast(l.l_shipdate as date) as open_dt,
       case when l.l_returnflag = 'R' then cast(l.l_shipdate as date) + 400 else null end as closed_dt,
       o.o_custkey % 3 as dpd_class, l.l_orderkey as k1, l.l_linenumber as k2,
       date '2002-01-01' as created_at, 'batch_1' as batch_no
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
""",
    "enquiries": """
select 'C' || cast(o_custkey as string) as customer_id,
       case o_orderkey % 8 when 0 then '13' when 1 then '18' when 2 then '3' when 3 then '14' when 4 then '2' when 5 then '16' when 6 then '7' else '99' end as inq_purp_cd,
       cast(o_orderdate as date) as inq_date, cast(o_totalprice as decimal(10,2)) as amount,
       case o_orderkey % 3 when 0 then 'NBF' when 1 then 'PVT' else null end as m_sub_id,
       date '2002-01-01' as created_at, 'batch_' || cast(o_orderkey % 2 + 1 as string) as batch_no
from {orders}
""",
    "scores": """
select (case when c_custkey % 17 = 0 then 'D' else 'C' end) || cast(c_custkey as string) as customer_id, cast(300 + (c_custkey * 37) % 601 as decimal(10,2)) as score_v3, 'batch_1' as batch_no,
       date '2002-01-01' as created_at
from {customer}
""",
    "bureau_sent": """
select 'L' || lpad(cast(c_custkey as string), 8, '0') as lead_id, (case when c_custkey % 13 = 0 then 'E' else 'C' end) || cast(c_custkey as string) as bureau_id,
       case when c_custkey % 5 = 0 then null else '9' || lpad(cast(c_custkey as string), 9, '0') end as phone,
       case when c_custkey % 19 = 0 then 'batch_2' else 'batch_1' end as scrub_batch_no
from {customer}
""",
    "phones": """
select 'C' || cast(user_id as string) as customer_id,
       (case when event_id % 5 = 0 then '+91' else '' end) || cast(event_id % 10 as string)
         || lpad(cast(event_id as string), case when event_id % 11 = 0 then 7 else 9 end, '0') as phone,
       cast(ts as date) as date_reported, date '2002-01-01' as created_at
from {events}
""",
    "addresses": """
select 'C' || cast(user_id as string) as customer_id,
       cast(event_id % 300 as string) || ' ' || event_type || ' street' as address,
       lpad(cast(100000 + (event_id * 7919) % 900000 as string), case when event_id % 13 = 0 then 5 else 6 end, '0') as pincode,
       case when event_id % 29 = 0 then null else cast(ts as date) end as date_reported
from {events}
""",
    "emails": """
select 'C' || cast(user_id as string) as customer_id,
       case event_id % 5 when 0 then 'A.B' || cast(event_id as string) || '@Gmail.con' when 1 then '"x y' || cast(event_id as string) || '"@mail.org;'
            when 2 then 'q' || cast(event_id as string) || '@gmail.co' when 3 then 'Z@GMAIL.COM,' else null end as email,
       cast(ts as date) as date_reported
from {events}
""",
    "name_dob": """
select 'C' || cast(c_custkey as string) as customer_id, c_name as full_name, cast(c_custkey % 5 as string) as gender,
       cast('1890-06-15' as date) + cast((c_custkey * 97) % 42000 as int) as dob, date '2002-01-01' as created_at
from {customer}
""",
    "ids": """
select 'C' || cast(c_custkey as string) as customer_id,
       case when c_custkey % 6 = 0 then null
            else 'abc' || (case when c_custkey % 4 = 0 then 'c' else 'p' end) || 'x' || lpad(cast(c_custkey % 10000 as string), 4, '0') || 'z' end as pan
from {customer}
""",
    "dirty_text": """
select event_id,
       case event_id % 9 when 0 then '31/12/2001' when 1 then '05-11-2000' when 2 then '07.08.1999' when 3 then '2001/02/03' when 4 then '1998-07-30'
            when 5 then '2000.01.09' when 6 then '12/25/2001' when 7 then '99/99/2001' else null end as date_text,
       case event_id % 6 when 0 then 'Rs 1,234.50' when 1 then '-17' when 2 then '12.345' when 3 then '99999999999' when 4 then 'abc' else null end as amount_text,
       case event_id % 5 when 0 then 'A.B@Gmail.con' when 1 then '"x y"@mail.org;' when 2 then 'q@gmail.co' when 3 then 'Z@GMAIL.COM,' else null end as email_text,
       case event_id % 4 when 0 then '05-JAN-24 10:00' when 1 then '28-Feb-23' when 2 then 'bad' else null end as inq_time_text,
       case when event_id % 50 = 0 then 'BALANCE_DT' when event_id % 51 = 0 then 'balance_dt' when event_id % 7 = 0 then null else '01/01/2001' end as balance_dt,
       event_type, user_id
from {events}
""",
    "offers_raw": """
select 'C' || cast(o_custkey as string) as customer_number, '9' || lpad(cast(o_custkey as string), 9, '0') as mobile_no,
       'Rs ' || cast(cast(o_totalprice as decimal(12,2)) as string) as approved_loan_amount,
       case o_orderkey % 3 when 0 then '31/12/2001' when 1 then '05-Nov-2000' else ' 2001-07-04 ' end as offer_expiry_date,
       cast(9 + o_orderkey % 15 as string) as roi, cast(12 + o_orderkey % 48 as string) as max_tenure_by_policy,
       case when o_orderkey % 4 = 0 then null else o_orderpriority end as offer_status
from {orders}
""",
}

# Extra months of delinquency on top of ``tradelines``: one column per month n.
DPD_TEMPLATE = """case when (k1 + {n}) % 13 = 0 then null
     when dpd_class = 0 then 0
     when dpd_class = 1 then ((k1 * 7 + k2 * 3 + {n}) % 3) * 5
     else ((k1 * 7 + k2 * 3 + {n}) % 9) * 5 end"""


# The same for Spark, where 36 such cases make a method too large to be compiled: an account's months are one row of a small table of
# all patterns, by class and remainders. Keys that are missing or negative, whose remainders differ, go through the plain cases.
MONTHS = range(1, 37)
DPD_PATTERNS = [
    [None if (rest + n) % 13 == 0 else 5 * ((turn + n) % cycle) for n in MONTHS]
    for cycle in (1, 3, 9) for rest in range(13) for turn in range(cycle)
]
DPD_MONTHS = f"""case when k1 >= 0 and k1 * 7 + k2 * 3 >= 0
     then get(from_json('{json.dumps(DPD_PATTERNS, separators=(",", ":"))}', 'array<array<bigint>>'), cast(case dpd_class
       when 0 then k1 % 13 when 1 then 13 + 3 * (k1 % 13) + (k1 * 7 + k2 * 3) % 3 else 52 + 9 * (k1 % 13) + (k1 * 7 + k2 * 3) % 9 end as int))
     else transform(sequence(1, 36), n -> {DPD_TEMPLATE.format(n="n")}) end"""


def dpd_projection() -> str:
    return ", ".join(f"{DPD_TEMPLATE.format(n=n)} as days_past_due_{n:02d}" for n in range(1, 37))


def _tables_of(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


class Views:
    """The domain views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        sql = VIEWS[name]
        return self.spark.sql(sql, **{t: self.table(t) for t in _tables_of(sql)})

    @property
    def tradelines_dpd(self) -> DataFrame:
        given = self.tradelines
        months = [f"get(_months, {n - 1}) as days_past_due_{n:02d}" for n in MONTHS]
        return given.selectExpr("*", f"{DPD_MONTHS} as _months").selectExpr(*given.columns, *months)


def oracle(body: str, *names: str) -> str:
    """The given views as common table expressions in front of ``body``, for DuckDB."""
    ctes = []
    for name in names:
        if name == "tradelines_dpd":
            ctes.append(f"tradelines_dpd as (select *, {dpd_projection()} from tradelines)")
        else:
            sql = VIEWS[name]
            ctes.append(f"{name} as ({sql.format(**{t: t for t in _tables_of(sql)}).strip()})")
    joined = ",\n".join(ctes)
    body = body.strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return f"with {joined},\n{body[5:]}"
    return f"with {joined}\n{body}"
