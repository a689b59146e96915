"""Registered partner-lead queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadforge.catalog.shape import comparable
from leadforge.catalog.views import AS_OF, Views, oracle
from leadforge.operators import leads as L
from leadforge.plans import partner as P
from leadforge.sources.partner_files import standardise

QUERIES: dict = {}
ORACLES: dict = {}


def _register(key, query, sql, *views):
    QUERIES[key] = lambda spark, folder: comparable(query(Views(spark, folder)))
    ORACLES[key] = oracle(sql, *views)


NOT_NEW = "status = 'not processed'"

_register(
    "match_phone",
    lambda v: L.match_phone(v.partners_status, v.phone_base).select("partner_reference_id", "hashed_phone", "lead_id", "batch_no"),
    f"""select t.partner_reference_id, t.hashed_phone, p.lead_id, t.batch_no from partners_status t
 join phone_base p on p.hashed_phone = t.hashed_phone where t.{NOT_NEW}""",
    "partners_status", "phone_base",
)
_register(
    "mark_missing_ids",
    lambda v: L.mark_missing(v.partners_status, v.phone_base).select("partner_reference_id", "status"),
    """select t.partner_reference_id, case when t.status = 'not processed' and (t.hashed_phone is null or not exists
 (select 1 from phone_base p where p.hashed_phone = t.hashed_phone)) then 'error: lead id not found' else t.status end as status from partners_status t""",
    "partners_status", "phone_base",
)
_register(
    "mark_processed",
    lambda v: L.mark_processed(v.partners_status, v.partners_processed).select("partner_reference_id", "batch_no", "status"),
    """select t.partner_reference_id, t.batch_no, case when t.status = 'not processed' and exists (select 1 from partners_processed p
 where p.partner_reference_id = t.partner_reference_id and p.batch_no = t.batch_no and p.partner_name = t.partner_name) then 'processed' else t.status end as status
 from partners_status t""",
    "partners_status", "partners_processed",
)
_register(
    "raw_batch_counts",
    lambda v: L.raw_batch_counts(v.partners_status, "alpha", "batch_1"),
    f"""select count(*) as total, cast(sum(case when {NOT_NEW} then 1 else 0 end) as bigint) as not_processed,
 cast(count(*) - sum(case when {NOT_NEW} then 1 else 0 end) as bigint) as duplicates from partners_status where partner_name = 'alpha' and batch_no = 'batch_1'""",
    "partners_status",
)
PENDING = f"""select partner_name, try_cast(replace(batch_no, 'batch_', '') as int) as batch_no,
 cast(case when sum(case when {NOT_NEW} then 1 else 0 end) > 0 then sum(case when {NOT_NEW} then 1 else 0 end) else count(*) end as bigint) as no_of_records,
 case when sum(case when {NOT_NEW} then 1 else 0 end) = 0 then 'processed' else 'not processed' end as status
 from partners_status group by partner_name, batch_no having try_cast(replace(batch_no, 'batch_', '') as int) is not null"""
PENDING = f"select partner_name, cast(batch_no as bigint) as batch_no, no_of_records, status from ({PENDING})"
_register("pending_batches", lambda v: L.pending_batches(v.partners_status), PENDING, "partners_status")
_register(
    "sort_batches",
    lambda v: L.pending_batches(v.partners_status).select("partner_name", "batch_no"),
    f"select partner_name, batch_no from ({PENDING}) order by partner_name, batch_no", "partners_status",
)
_register(
    "files_for_batch",
    lambda v: L.files_for_batch(v.partners_status, "beta", "batch_2"),
    f"""select filename, cast(case when sum(case when {NOT_NEW} then 1 else 0 end) > 0 then sum(case when {NOT_NEW} then 1 else 0 end) else count(*) end as bigint) as no_of_records,
 case when sum(case when {NOT_NEW} then 1 else 0 end) = 0 then 'processed' else 'not processed' end as status
 from partners_status where partner_name = 'beta' and batch_no = 'batch_2' group by filename""",
    "partners_status",
)

MARKED_SQL = """marked as (select *, case when hashed_phone is null or hashed_phone = '' then 'not processed' when rn = 1 then 'not processed' else 'duplicate' end as status,
 case when hashed_phone is null or hashed_phone = '' or rn = 1 then null when first_file = file_seq then 'in_file' else 'in_batch' end as duplicate_kind
 from (select *, row_number() over w as rn, first_value(file_seq) over w as first_file from partners_raw
       window w as (partition by partner_name, batch_no, hashed_phone order by file_seq, row_seq)))"""
_register(
    "mark_duplicates",
    lambda v: L.mark_duplicates(v.partners_raw).select("partner_reference_id", "filename", "status", "duplicate_kind"),
    f"with {MARKED_SQL} select partner_reference_id, filename, status, duplicate_kind from marked", "partners_raw",
)
_register(
    "duplicate_log",
    lambda v: L.duplicate_log(L.mark_duplicates(v.partners_raw)),
    f"""with {MARKED_SQL} select partner_name, batch_no, filename, count(*) as original_count,
 cast(sum(case when duplicate_kind = 'in_file' then 1 else 0 end) as bigint) as infile_dropped,
 cast(sum(case when duplicate_kind = 'in_batch' then 1 else 0 end) as bigint) as inbatch_dropped from marked group by all""",
    "partners_raw",
)
_register(
    "raw_enrich_if_absent",
    lambda v: L.enrich_if_absent(
        v.partners_raw, batch_no=F.lit("unused"), status=F.lit(L.NEW), partner_id=F.lit(None).cast("string"), filename=F.lit("unused"),
    ).select("partner_reference_id", "batch_no", "filename", "status", "partner_id"),
    "select partner_reference_id, batch_no, filename, 'not processed' as status, cast(null as varchar) as partner_id from partners_raw",
    "partners_raw",
)


def _partners(v: Views):
    """Partner master derived from the leads; one partner stands there under a name that no lead has."""
    names = v.partners_raw.selectExpr("replace(partner_name, 'gamma', 'gamma inc') as partner_name").distinct()
    return names.selectExpr("partner_name", "'id-' || partner_name as partner_id")


PARTNERS_SQL = "partners as (select distinct replace(partner_name, 'gamma', 'gamma inc') as partner_name, 'id-' || replace(partner_name, 'gamma', 'gamma inc') as partner_id from partners_raw)"
_register(
    "partner_lookup",
    lambda v: L.lookup_partner(v.partners_raw, _partners(v)).select("partner_reference_id", "partner_name", "partner_id"),
    f"""with {PARTNERS_SQL} select r.partner_reference_id, r.partner_name, p.partner_id from partners_raw r
 left join partners p on p.partner_name = r.partner_name""",
    "partners_raw",
)
_register(
    "header_standardise",
    lambda v: standardise(
        v.partners_raw.selectExpr("partner_reference_id as ` PId `", "'  ' || name || ' ' as name", "phone", "hashed_phone", "pan_no as `Pan No`")
    ),
    "select partner_reference_id as \"PARTNER_REFERENCE_ID\", name as \"NAME\", phone as \"PHONE\", hashed_phone as \"HASHED_PHONE\", pan_no as \"PAN NO\" from partners_raw",
    "partners_raw",
)


def _uploaded(v: Views):
    return v.partners_raw.selectExpr(
        "' ' || partner_reference_id || ' ' as partner_reference_id", "hashed_phone", "phone", "pan_no", "name",
        "partner_name", "batch_no", "filename", "file_seq", "row_seq",
    )


_register(
    "partner_ingest",
    lambda v: P.ingest(_uploaded(v), _partners(v), AS_OF).select(
        "partner_reference_id", "hashed_phone", "partner_name", "partner_id", "batch_no", "filename", "status", "masked_phone", "created_at"),
    f"""with {PARTNERS_SQL}, {MARKED_SQL} select m.partner_reference_id, m.hashed_phone, m.partner_name, p.partner_id, m.batch_no, m.filename, m.status,
 cast(null as varchar) as masked_phone, '2002-01-01' as created_at from marked m left join partners p on p.partner_name = m.partner_name""",
    "partners_raw",
)


def _raw(v: Views):
    return L.mark_duplicates(v.partners_raw)


STAGE1_SQL = f"""with {MARKED_SQL}, final as (select m.*, p.lead_id, case when m.status <> 'not processed' then m.status when p.lead_id is null then 'error: lead id not found' else 'processed' end as final_status
 from marked m left join phone_base p on p.hashed_phone = m.hashed_phone) """
_register(
    "partner_process",
    lambda v: P.process_batch(_raw(v), v.phone_base, AS_OF)[0].select("partner_reference_id", "partner_name", "batch_no", "status"),
    STAGE1_SQL + "select partner_reference_id, partner_name, batch_no, final_status as status from final",
    "partners_raw", "phone_base",
)
_register(
    "process_batch_summary",
    lambda v: P.process_batch(_raw(v), v.phone_base, AS_OF)[2],
    STAGE1_SQL + """select partner_name, batch_no, count(*) as original_count,
 cast(sum(case when final_status = 'duplicate' then 1 else 0 end) as bigint) as duplicates_found,
 cast(sum(case when final_status = 'error: lead id not found' then 1 else 0 end) as bigint) as missing_id_count,
 cast(sum(case when final_status = 'processed' then 1 else 0 end) as bigint) as cleaned_count from final group by all""",
    "partners_raw", "phone_base",
)
_register(
    "partner_processed_rows",
    lambda v: P.process_batch(_raw(v), v.phone_base, AS_OF, "alpha", "batch_3")[1].select("partner_reference_id", "lead_id", "batch_no", "sent_to_scrub", "created_at"),
    STAGE1_SQL + """select partner_reference_id, lead_id, batch_no, false as sent_to_scrub, '2002-01-01' as created_at from final
 where final_status = 'processed' and partner_name = 'alpha' and batch_no = 'batch_3'""",
    "partners_raw", "phone_base",
)

# Log lines as the ingest writes them, one per order; some name the partner in other case, some are noise.
LOG_SQL = """select o_orderkey as line_no, case when o_orderkey % 5 = 0 then 'info: nothing'
 else (case when o_orderkey % 2 = 0 then 'Partner: ' else 'partner: ' end) || o_orderpriority || ', Batch no: ' || cast(o_orderkey % 7 + 1 as string)
      || ', date: ' || (case when o_orderkey % 9 = 0 then '2002-01-01' else cast(cast(o_orderdate as date) as string) end) || ' 10:00' end as value from {orders}"""
NUMBER_LOG_SQL = """select case when o_orderkey % 3 = 0 then 'Scrub_Batch_no.: ' || cast(o_orderkey % 100 as string) when o_orderkey % 3 = 1 then 'lender_batch_no: ' || cast(o_orderkey % 50 as string)
 else 'noise ' || cast(o_orderkey as string) end as value from {orders}"""


def _log(sql):
    return lambda v: v.spark.sql(sql, orders=v.table("orders"))


_register(
    "next_partner_batch",
    lambda v: L.next_partner_batch(_log(LOG_SQL)(v), AS_OF),
    """with lines as (select o_orderpriority as partner_name, o_orderkey % 7 + 1 as batch, row_number() over (partition by o_orderpriority order by o_orderkey desc) as age,
 o_orderkey % 9 = 0 or cast(o_orderdate as date) = date '2002-01-01' as today from orders where o_orderkey % 5 <> 0)
 select partner_name, cast(case when today then batch else batch + 1 end as bigint) as next_batch from lines where age = 1""",
)
_register(
    "next_scrub_batch",
    lambda v: L.next_numbered_batch(_log(NUMBER_LOG_SQL)(v), "scrub_batch_no"),
    "select cast(coalesce(max(case when o_orderkey % 3 = 0 then o_orderkey % 100 end), 0) + 1 as bigint) as next_batch from orders",
)
_register(
    "next_lender_batch",
    lambda v: L.next_numbered_batch(_log(NUMBER_LOG_SQL)(v), "lender_batch_no"),
    "select cast(coalesce(max(case when o_orderkey % 3 = 1 then o_orderkey % 50 end), 0) + 1 as bigint) as next_batch from orders",
)
