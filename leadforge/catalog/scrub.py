"""Registered bureau-export and monitoring queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadforge.catalog.shape import comparable, day
from leadforge.catalog.views import AS_OF, Views, oracle
from leadforge.functions import status as ST
from leadforge.operators import scrub as S
from leadforge.plans import export as E

QUERIES: dict = {}
ORACLES: dict = {}


def _register(key, query, sql, *views):
    QUERIES[key] = lambda spark, folder: comparable(query(Views(spark, folder)))
    ORACLES[key] = oracle(sql, *views)


DUE = """due as (select * from partners_processed where (sent_to_scrub = false or scrub_date < date '2002-01-01' - 90) and lead_id is not null)"""
BATCHES = ["batch_1", "batch_3", "batch_9"]
IN_BATCHES = "('batch_1', 'batch_3', 'batch_9')"

_register(
    "due_for_scrub",
    lambda v: S.due_for_scrub(v.partners_processed, AS_OF).select("partner_reference_id", "lead_id", "batch_no", "sent_to_scrub", "scrub_date"),
    f"with {DUE} select partner_reference_id, lead_id, batch_no, sent_to_scrub, {day('scrub_date')} as scrub_date from due",
    "partners_processed",
)
_register(
    "batch_selection",
    lambda v: S.batch_selection_report(S.due_for_scrub(v.partners_processed, AS_OF), BATCHES),
    f"""with {DUE}, asked as (select unnest(['batch_1', 'batch_3', 'batch_9']) as batch_no)
 select a.batch_no, count(d.lead_id) as record_count, case when count(d.lead_id) = 0 then 'Batch ' || a.batch_no || ': No pending records found' end as warning
 from asked a left join due d on d.batch_no = a.batch_no group by a.batch_no""",
    "partners_processed",
)
_register(
    "union_batches",
    lambda v: S.union_batches([S.select_batches(S.due_for_scrub(v.partners_processed, AS_OF), [b]).select("lead_id", "hashed_phone", "phone", "pan_no") for b in BATCHES]),
    f"with {DUE} " + " union ".join(f"select lead_id, hashed_phone, phone, pan_no from due where batch_no = '{b}'" for b in BATCHES),
    "partners_processed",
)
_register(
    "max_bureau_index",
    lambda v: S.max_bureau_index(v.equifax_exchange, "EQ", AS_OF),
    "select max(cast(substr(bureau_id, 11, 12) as bigint)) as max_index from equifax_exchange where bureau_id like 'EQ01012002%'",
    "equifax_exchange",
)
NUMBERED = f"""{DUE}, picked as (select distinct * from due where batch_no in {IN_BATCHES}),
numbered as (select p.*, 'EQ01012002' || lpad(cast(row_number() over (order by lead_id, partner_reference_id) + (select max(cast(substr(bureau_id, 11, 12) as bigint)) from equifax_exchange where bureau_id like 'EQ01012002%') as varchar), 12, '0') as bureau_id from picked p)"""


def _numbered(v: Views):
    picked = S.select_batches(S.due_for_scrub(v.partners_processed, AS_OF), BATCHES).distinct()
    start = S.next_bureau_index(v.equifax_exchange, "EQ", AS_OF)
    return S.assign_bureau_ids(picked, "EQ", AS_OF, start, ["lead_id", "partner_reference_id"])


_register(
    "assign_bureau_ids",
    lambda v: _numbered(v).select("lead_id", "partner_reference_id", "bureau_id"),
    f"with {NUMBERED} select lead_id, partner_reference_id, bureau_id from numbered", "partners_processed", "equifax_exchange",
)
_register(
    "bureau_export",
    lambda v: E.bureau_export(v.partners_processed, v.equifax_exchange, BATCHES, "batch_4", AS_OF)[1],
    f"""with {NUMBERED} select lead_id, bureau_id, hashed_phone, phone, pan_no, 'batch_4' as scrub_batch_no, '2002-01-01' as scrub_date, false as sent_to_experian from numbered""",
    "partners_processed", "equifax_exchange",
)
_register(
    "bureau_export_flags",
    lambda v: E.bureau_export(v.partners_processed, v.experian_exchange, BATCHES, "batch_4", AS_OF, bureau="experian")[2].select(
        "partner_reference_id", "sent_to_scrub", "sent_to_experian", "scrub_date"),
    f"""with {DUE}, ids as (select distinct lead_id from due where batch_no in {IN_BATCHES})
 select p.partner_reference_id, p.sent_to_scrub or i.lead_id is not null as sent_to_scrub, i.lead_id is not null as sent_to_experian,
 case when i.lead_id is not null then '2002-01-01' else {day('p.scrub_date')} end as scrub_date
 from partners_processed p left join ids i on i.lead_id = p.lead_id""",
    "partners_processed",
)


def _flags(table: str):
    return f"""select p.partner_reference_id, p.sent_to_scrub or i.lead_id is not null as sent_to_scrub, i.lead_id is not null as sent_to_bureau,
 case when i.lead_id is not null then '2002-01-01' else {day('p.scrub_date')} end as scrub_date
 from partners_processed p left join (select distinct lead_id from {table} where scrub_batch_no = 'batch_2') i on i.lead_id = p.lead_id"""


for _bureau in ("equifax", "experian"):
    _register(
        "update_flags_from_batch" if _bureau == "equifax" else f"update_flags_from_batch_{_bureau}",
        lambda v, b=_bureau: S.mark_sent(v.partners_processed, getattr(v, f"{b}_exchange"), "batch_2", AS_OF, b).select(
            "partner_reference_id", "sent_to_scrub", F.col(f"sent_to_{b}").alias("sent_to_bureau"), "scrub_date"),
        _flags(f"{_bureau}_exchange"), "partners_processed", f"{_bureau}_exchange",
    )
_register(
    "update_sent_to_experian",
    lambda v: S.mark_sent_to_second(v.equifax_exchange, v.experian_exchange).select("lead_id", "bureau_id", "sent_to_experian"),
    """select e.lead_id, e.bureau_id, e.sent_to_experian or e.lead_id in (select lead_id from experian_exchange) as sent_to_experian from equifax_exchange e""",
    "equifax_exchange", "experian_exchange",
)
GATED = """select lead_id, bureau_id, hashed_phone, phone, pan_no, scrub_batch_no, {date} from equifax_exchange e
 where {batch} lead_id is not null and exists (select 1 from equifax_ar a where a.reference_no = e.bureau_id and try_cast(a.score as double) >= 600)"""
_register(
    "score_gate",
    lambda v: S.score_gate(v.equifax_exchange, v.equifax_ar, None, 600),
    GATED.format(date=day("scrub_date") + " as scrub_date", batch=""), "equifax_exchange", "equifax_ar",
)
_register(
    "send_all_batch",
    lambda v: S.send_all(v.equifax_exchange, "batch_2"),
    f"select lead_id, bureau_id, hashed_phone, phone, pan_no, scrub_batch_no, {day('scrub_date')} as scrub_date from equifax_exchange where scrub_batch_no = 'batch_2'",
    "equifax_exchange",
)
_register(
    "second_bureau_export",
    lambda v: E.second_bureau_export(v.equifax_exchange, v.equifax_ar, v.experian_exchange, v.partners_processed, "batch_2", AS_OF)[0],
    GATED.format(date=day("scrub_date") + " as scrub_date", batch="scrub_batch_no = 'batch_2' and"), "equifax_exchange", "equifax_ar",
)
_register(
    "second_bureau_export_flags",
    lambda v: E.second_bureau_export(v.equifax_exchange, v.equifax_ar, v.experian_exchange, v.partners_processed, "batch_2", AS_OF)[1].select("lead_id", "bureau_id", "sent_to_experian"),
    """with gated as (""" + GATED.format(date="scrub_date", batch="scrub_batch_no = 'batch_2' and") + """)
 select lead_id, bureau_id, sent_to_experian or lead_id in (select lead_id from experian_exchange) or lead_id in (select lead_id from gated) as sent_to_experian from equifax_exchange""",
    "equifax_exchange", "equifax_ar", "experian_exchange",
)
_register(
    "second_bureau_report",
    lambda v: E.second_bureau_report(v.equifax_exchange, ["batch_1", "batch_2", "batch_8"]),
    """select a.scrub_batch_no, count(e.lead_id) as record_count, case when count(e.lead_id) > 0 then 'success' else 'failed' end as outcome,
 case when count(e.lead_id) > 0 then null else 'No data found for this batch' end as error
 from (select unnest(['batch_1', 'batch_2', 'batch_8']) as scrub_batch_no) a left join equifax_exchange e on e.scrub_batch_no = a.scrub_batch_no group by a.scrub_batch_no""",
    "equifax_exchange",
)


def _summary(v: Views, bureau: str):
    if bureau == "equifax":
        return S.batch_summary(v.partners_processed, v.partners_raw, v.equifax_exchange, v.equifax_ar, "reference_no", v.experian_exchange, v.experian_ar)
    return S.batch_summary(v.partners_processed, v.partners_raw, v.experian_exchange, v.experian_ar, "customer_id", v.experian_exchange, v.experian_ar)


def _summary_sql(bureau: str) -> str:
    table, responses, column = {"equifax": ("equifax_exchange", "equifax_ar", "reference_no"), "experian": ("experian_exchange", "experian_ar", "customer_id")}[bureau]
    return f"""arrived as (select partner_reference_id, max(created_at) as arrived_on from partners_raw group by 1),
known as (select partner_name, batch_no, lead_id, max(arrived_on) as arrived_on from partners_processed join arrived using (partner_reference_id) group by 1, 2, 3),
own as (select partner_name, batch_no, count(distinct lead_id) as sent_count, count(distinct case when answered then bureau_id end) as response_count, max(scrub_batch_no) as scrub_batch_no
 from known join (select lead_id, bureau_id, scrub_batch_no from {table}) using (lead_id) left join (select distinct {column} as bureau_id, true as answered from {responses}) using (bureau_id) group by 1, 2),
second as (select partner_name, batch_no, count(distinct lead_id) as sent_to_experian_count, count(distinct case when answered then bureau_id end) as experian_response_count
 from known join (select lead_id, bureau_id from experian_exchange) using (lead_id) left join (select distinct customer_id as bureau_id, true as answered from experian_ar) using (bureau_id) group by 1, 2),
whole as (select partner_name, batch_no, max(arrived_on) as received_date, count(distinct lead_id) as total_records from known group by 1, 2),
summary as (select * replace (coalesce(sent_count, 0) as sent_count, coalesce(response_count, 0) as response_count, coalesce(sent_to_experian_count, 0) as sent_to_experian_count,
 coalesce(experian_response_count, 0) as experian_response_count) from whole left join own using (partner_name, batch_no) left join second using (partner_name, batch_no))"""


SUMMARY_VIEWS = ("partners_processed", "partners_raw", "equifax_exchange", "equifax_ar", "experian_exchange", "experian_ar")
SUMMARY_COLUMNS = f"partner_name, batch_no, {day('received_date')} as received_date, total_records, sent_count, response_count, scrub_batch_no, sent_to_experian_count, experian_response_count"
for _key, _bureau in (("batch_summary", "equifax"), ("batch_summary_experian", "experian"), ("summary_joins", "equifax")):
    _register(_key, lambda v, b=_bureau: _summary(v, b), f"with {_summary_sql(_bureau)} select {SUMMARY_COLUMNS} from summary", *SUMMARY_VIEWS)
_register(
    "order_by_agg",
    lambda v: _summary(v, "equifax").select("partner_name", "batch_no", "received_date"),
    f"with {_summary_sql('equifax')} select partner_name, batch_no, {day('received_date')} as received_date from summary order by received_date desc",
    *SUMMARY_VIEWS,
)
_register(
    "pending_summary",
    lambda v: S.pending_summary(v.partners_processed, v.partners_raw, v.equifax_exchange, AS_OF),
    f"""with arrived as (select partner_reference_id, max(created_at) as arrived_on from partners_raw group by 1),
 last_batch as (select lead_id, max(scrub_batch_no) as scrub_batch_no from equifax_exchange group by 1),
 waiting as (select partner_name, batch_no, lead_id, partner_reference_id from partners_processed where not sent_to_scrub or scrub_date < date '2002-01-01' - 90)
 select partner_name, batch_no, {day('max(arrived_on)')} as received_date, count(distinct lead_id) as pending_records, max(scrub_batch_no) as last_scrub_batch
 from waiting join arrived using (partner_reference_id) left join last_batch using (lead_id) group by 1, 2 having count(lead_id) > 0""",
    "partners_processed", "partners_raw", "equifax_exchange",
)
MONITOR = """recent as (select scrub_batch_no, scrub_date, lead_id, bureau_id from equifax_exchange where scrub_date >= date '2002-01-01' - 60),
answers as (select reference_no as bureau_id, true as hit, max(created_at) as answered_on, max(try_cast(score as double)) as best from equifax_ar group by 1),
first as (select scrub_batch_no, max(scrub_date) as scrub_date, max(answered_on) as equifax_response_date, count(distinct lead_id) as sent_to_equifax,
 count(distinct case when hit then bureau_id end) as equifax_hits, count(distinct case when best >= 600 then lead_id end) as score_gte_input from recent left join answers using (bureau_id) group by 1),
second as (select scrub_batch_no, count(distinct lead_id) as sent_to_experian, count(distinct case when heard then second_id end) as experian_response
 from recent join (select lead_id, bureau_id as second_id from experian_exchange) using (lead_id) left join (select distinct customer_id as second_id, true as heard from experian_ar) using (second_id) group by 1),
monitor as (select * replace (coalesce(sent_to_experian, 0) as sent_to_experian, coalesce(experian_response, 0) as experian_response), sent_to_equifax - equifax_hits as no_hits
 from first left join second using (scrub_batch_no))"""
MONITOR_VIEWS = ("equifax_exchange", "equifax_ar", "experian_exchange", "experian_ar")
MONITOR_COLUMNS = f"scrub_batch_no, {day('scrub_date')} as scrub_date, {day('equifax_response_date')} as equifax_response_date, sent_to_equifax, equifax_hits, no_hits, score_gte_input, sent_to_experian, experian_response"


def _monitor(v: Views):
    return S.scrub_monitor(v.equifax_exchange, v.equifax_ar, v.experian_exchange, v.experian_ar, AS_OF, 600, 60)


_register("scrub_batch_monitor", _monitor, f"with {MONITOR} select {MONITOR_COLUMNS} from monitor", *MONITOR_VIEWS)
_register(
    "response_status",
    lambda v: S.response_status(v.equifax_ar, "batch_2"),
    "select count(*) as record_count, count(*) > 0 as has_response from equifax_ar where batch_no = 'batch_2'", "equifax_ar",
)
_register(
    "status_single_bureau",
    lambda v: _summary(v, "equifax").select(
        "partner_name", "batch_no", ST.single_bureau_status(F.col("total_records"), F.col("sent_count"), F.col("response_count")).alias("status")),
    f"""with {_summary_sql('equifax')} select partner_name, batch_no, case when response_count > 0 and response_count >= sent_count then 'Response Received'
 when sent_count > 0 and sent_count >= total_records then 'Sent (Awaiting Response)' when sent_count > 0 then 'Partially Sent (' || sent_count || '/' || total_records || ')' else 'Pending' end as status from summary""",
    *SUMMARY_VIEWS,
)
_register(
    "status_two_bureau",
    lambda v: _summary(v, "equifax").select(
        "partner_name", "batch_no", ST.two_bureau_status(
            F.col("total_records"), F.col("sent_count"), F.col("response_count"), F.col("sent_to_experian_count"), F.col("experian_response_count")).alias("status")),
    f"""with {_summary_sql('equifax')} select partner_name, batch_no, case when experian_response_count > 0 then 'Response Received from Experian' when sent_to_experian_count > 0 then 'Sent to Experian'
 when response_count > 0 then 'Response Received from Equifax' when sent_count > 0 and sent_count >= total_records then 'Sent to Equifax'
 when sent_count > 0 then 'Partially Sent to Equifax (' || sent_count || '/' || total_records || ')' else 'Pending' end as status from summary""",
    *SUMMARY_VIEWS,
)


def _scrub_status(v: Views):
    counts = S.response_counts(v.equifax_ar.withColumn("batch_no", F.replace("batch_no", F.lit("batch_3"), F.lit("batch_30"))))
    joined = _monitor(v).join(counts, "scrub_batch_no", "left")
    answered = F.coalesce(F.col("record_count"), F.lit(0)) > 0
    status = ST.scrub_batch_status(answered, F.col("experian_response"), F.col("sent_to_experian"))
    return joined.select("scrub_batch_no", "equifax_hits", status.alias("status")).withColumn(
        "ready", ST.ready_for_second_bureau(F.col("status"), F.col("equifax_hits")))


_register(
    "status_scrub_batch", _scrub_status,
    f"""with {MONITOR}, labelled as (select m.scrub_batch_no, m.equifax_hits, case when r.n > 0 then 'Response Received from Equifax' when m.experian_response > 0 then 'Response Received from Experian'
 when m.sent_to_experian > 0 then 'Sent to Experian' else 'Pending' end as status from monitor m left join (select replace(batch_no, 'batch_3', 'batch_30') as batch_no, count(*) as n from equifax_ar group by 1) r on r.batch_no = m.scrub_batch_no)
 select *, status = 'Response Received from Equifax' or (status = 'Pending' and equifax_hits > 0) as ready from labelled""",
    *MONITOR_VIEWS,
)




_register(
    "exclude_other_bureau_only",
    lambda v: S.exclude_other_bureau_only(
        v.partners_processed.groupBy("lead_id").agg(F.count(F.lit(1)).alias("leads"))
        .join(v.equifax_exchange.groupBy("lead_id").agg(F.count(F.lit(1)).alias("own")), "lead_id", "left")
        .join(v.experian_exchange.groupBy("lead_id").agg(F.count(F.lit(1)).alias("other")), "lead_id", "left")
        .fillna(0, ["own", "other"]), "other", "own"),
    """with counted as (select p.lead_id, count(*) as leads from partners_processed p group by 1),
 j as (select c.lead_id, c.leads, (select count(*) from equifax_exchange e where e.lead_id = c.lead_id) as own,
 (select count(*) from experian_exchange x where x.lead_id = c.lead_id) as other from counted c) select * from j where not (other > 0 and own = 0)""",
    "partners_processed", "equifax_exchange", "experian_exchange",
)
