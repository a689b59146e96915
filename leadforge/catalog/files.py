"""Registered file, table and pipeline queries: views are written out, read back and processed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge.catalog.cleaning import OFFER_MASKS, amount_sql, parsed_day
from leadforge.catalog.features import features_sql
from leadforge.catalog.lenders import OFFER_JSON, PREFR_CRITERIA, RULE_FEATURES
from leadforge.catalog.shape import comparable, day, dbl
from leadforge.catalog.views import AS_OF, Views, oracle
from leadforge.operators import rules as R
from leadforge.operators.features.tradelines import block_features
from leadforge.plans import bureau as PB
from leadforge.plans import lenders as PL
from leadforge.plans import partner as PP
from leadforge.session import durable, scratch_path
from leadforge.sources import files as SF
from leadforge.sources import ledger as LG
from leadforge.sources import partner_files as PF
from leadforge.sources import schemas as SC
from leadforge.sources import sinks as SK
from leadforge.streaming.ingest import incremental_ingest

QUERIES: dict = {}
ORACLES: dict = {}

PARTS = 8


def _register(key, query, sql, *views):
    QUERIES[key] = lambda spark, folder: comparable(query(Views(spark, folder)))
    ORACLES[key] = oracle(sql, *views)


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def write_named(df: DataFrame, folder: str, stem: str, *, sep: str = "|", ending: str = "txt", **options) -> None:
    """A frame as ``PARTS`` text files ``stem_0.txt``, ``stem_1.txt``, ... in a folder."""
    spark = df.sparkSession
    staging = scratch_path(spark, "staging")
    df.repartition(PARTS).write.options(header=True, sep=sep, **options).csv(staging)
    fs, source = _filesystem(spark, staging)
    _, target = _filesystem(spark, folder)
    fs.mkdirs(target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    parts = sorted(s.getPath().getName() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))
    for index, name in enumerate(parts):
        fs.rename(path(source, name), path(target, f"{stem}_{index}.{ending}"))


def _enq(v: Views, condition: str = "true") -> DataFrame:
    """Enquiries as a landing file: text cells, missing sectors spelled in three ways."""
    return v.enquiries.filter(condition).select(
        F.col("customer_id").alias("CUSTOMER_ID"), F.col("inq_purp_cd").alias("INQ_PURP_CD"),
        F.date_format("inq_date", "dd/MM/yyyy").alias("INQ_DATE"),
        F.coalesce("m_sub_id", F.when(F.col("inq_purp_cd") == "13", "NULL").when(F.col("inq_purp_cd") == "18", "NUL")).alias("M_SUB_ID"),
        F.col("amount").cast("string").alias("AMOUNT"),
    )


def _score(v: Views, condition: str = "true") -> DataFrame:
    return v.scores.filter(condition).select(F.col("customer_id").alias("CUST_ID"), F.col("score_v3").cast("string").alias("SCORE_V3"))


def _written(v: Views, label: str, **files: tuple) -> tuple[str, DataFrame]:
    """(root, inventory) after writing ``batch__stem=frame`` files."""
    root = scratch_path(v.spark, label)
    for key, frame in files.items():
        batch, stem = key.split("__")
        write_named(frame, f"{root}/{batch}", stem)
    return root, SF.file_inventory(v.spark, root)


# -- scans -------------------------------------------------------------------------------------------

def _scan_bureau(v: Views):
    _, inventory = _written(v, "scan", batch_1__enq=_enq(v))
    good, _ = SF.scan_delimited(v.spark, inventory, SC.EXPERIAN["ENQ"])
    return good.drop("file_path")


ENQ_SQL = "select customer_id as CUSTOMER_ID, inq_purp_cd as INQ_PURP_CD, strftime(inq_date, '%d/%m/%Y') as INQ_DATE, m_sub_id as M_SUB_ID, cast(amount as varchar) as AMOUNT from enquiries"
_register("scan_bureau_pipe", _scan_bureau, ENQ_SQL, "enquiries")


def _scan_reference(v: Views):
    root = scratch_path(v.spark, "reference")
    write_named(v.partners_raw.selectExpr(
        "partner_reference_id as MEMBER_REFERENCE", "name || ', Mr' as NAME", "pan_no as PAN_NO", "phone as PHONE_NUMBER"), f"{root}/batch_1", "reference", sep=",", ending="csv")
    good, _ = SF.scan_delimited(v.spark, SF.file_inventory(v.spark, root), SC.REFERENCE, sep=",")
    return good.drop("file_path")


_register(
    "scan_reference_csv", _scan_reference,
    """select partner_reference_id as MEMBER_REFERENCE, name || ', Mr' as NAME, pan_no as PAN_NO, cast(null as varchar) as DATE_OF_BIRTH, phone as PHONE_NUMBER, cast(null as varchar) as PIN from partners_raw""",
    "partners_raw",
)


def _scan_header(v: Views):
    _, inventory = _written(v, "lender", batch_1__score=_score(v))
    return SF.scan_delimited(v.spark, inventory)[0].drop("file_path")


_register("scan_lender_header", _scan_header, "select customer_id as CUST_ID, cast(score_v3 as varchar) as SCORE_V3 from scores", "scores")


def _offer_files(v: Views) -> DataFrame:
    root = scratch_path(v.spark, "offers")
    upper = v.offers_raw.toDF(*[c.upper() for c in v.offers_raw.columns])
    write_named(upper, f"{root}/lender", "offers", sep=",", ending="csv", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return SF.file_inventory(v.spark, root)


def _scan_offers(v: Views):
    rows, _ = SF.scan_delimited(v.spark, _offer_files(v), SC.LENDER_OFFERS, sep=",", tolerant=True)
    return rows.select("CUSTOMER_NUMBER", "MOBILE_NO", "APPROVED_LOAN_AMOUNT", "ROI", "OFFER_EXPIRY_DATE", "OFFER_STATUS", "GENDER")


_register(
    "scan_lender_offers", _scan_offers,
    """select customer_number as CUSTOMER_NUMBER, mobile_no as MOBILE_NO, approved_loan_amount as APPROVED_LOAN_AMOUNT, roi as ROI, offer_expiry_date as OFFER_EXPIRY_DATE, offer_status as OFFER_STATUS,
 cast(null as varchar) as GENDER from offers_raw""", "offers_raw",
)


def _partner_files(v: Views):
    """One upload in three encodings and two header layouts."""
    root = scratch_path(v.spark, "partner")
    rows = v.partners_raw.selectExpr("partner_reference_id as PId", "hashed_phone", "phone", "name || ' é' as NAME", "partner_name")
    for partner, encoding in (("alpha", "UTF-8"), ("beta", "ISO-8859-1"), ("gamma", "UTF-16")):
        own = rows.filter(F.col("partner_name") == partner)
        own = own.drop("hashed_phone") if partner == "beta" else own
        write_named(own, f"{root}/upload", partner, sep=",", ending="csv", encoding=encoding)
    return SF.file_inventory(v.spark, root)


_register(
    "scan_partner_csv",
    lambda v: PF.scan_partner_csv(v.spark, _partner_files(v)).select("PARTNER_REFERENCE_ID", "HASHED_PHONE", "PHONE", "NAME", "PARTNER_NAME"),
    """select partner_reference_id as PARTNER_REFERENCE_ID, case when partner_name <> 'beta' then hashed_phone else phone end as HASHED_PHONE, phone as PHONE, name || ' é' as NAME, partner_name as PARTNER_NAME from partners_raw""",
    "partners_raw",
)



def _partner_ingest(v: Views):
    """Rows per status after the ingest of one upload; files without a reference id are turned away."""
    inventory = _partner_files(v)
    broken = scratch_path(v.spark, "partner-broken")
    write_named(v.partners_raw.select("phone", "name"), f"{broken}/upload", "broken", sep=",", ending="csv")
    everything = inventory.unionByName(SF.file_inventory(v.spark, broken))
    partners = v.partners_raw.select("partner_name").distinct().selectExpr("partner_name", "'id-' || partner_name as partner_id")
    rows, report = PP.ingest_files(v.spark, everything, partners, "alpha", "batch_1", AS_OF)
    turned_away = report.filter(~F.col("is_valid")).agg(F.lit("turned away files").alias("status"), F.count(F.lit(1)).alias("row_count"))
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("row_count")).unionByName(turned_away)


_register(
    "partner_ingest_files", _partner_ingest,
    f"""with rows as (select case when partner_name <> 'beta' then hashed_phone else phone end as hashed_phone from partners_raw)
 select 'not processed' as status, count(distinct hashed_phone) + count(*) - count(hashed_phone) as row_count from rows
 union all select 'duplicate', count(hashed_phone) - count(distinct hashed_phone) from rows
 union all select 'turned away files', cast({PARTS} as bigint) from (select count(*) from rows)""",
    "partners_raw",
)

# -- inventory and reports ---------------------------------------------------------------------------


def _two_batches(v: Views):
    return _written(
        v, "batches", batch_1__enq=_enq(v, "batch_no = 'batch_1'"), batch_2__enq=_enq(v, "batch_no = 'batch_2'"), batch_1__score=_score(v),
    )



def _stem():
    return F.regexp_replace("file_name", r"_\d+\.txt$", "").alias("stem")


_register(
    "file_inventory",
    lambda v: _two_batches(v)[1].groupBy("batch", _stem()).agg(F.count_distinct("file_name").alias("files")),
    f"select distinct batch_no as batch, 'enq' as stem, cast({PARTS} as bigint) as files from enquiries union all select distinct batch_no, 'score', cast({PARTS} as bigint) from scores",
    "enquiries", "scores",
)
_register(
    "common_unique_files",
    lambda v: SF.common_unique(_two_batches(v)[1]).select(
        "file_name", F.array_join("batches", ",").alias("batches"), "batch_count", "kind"),
    f"""select stem || '_' || i || '.txt' as file_name, string_agg(batch, ',' order by batch) as batches, count(*) as batch_count, case when count(*) > 1 then 'common' else 'unique' end as kind
 from (select distinct batch_no as batch, 'enq' as stem from enquiries union all select distinct batch_no, 'score' from scores), range({PARTS}) r(i) group by stem, i""",
    "enquiries", "scores",
)
_register(
    "format_report",
    lambda v: SF.format_report(_partner_files(v), SF.BUREAU_ENDINGS[1:]).unionByName(SF.format_report(_two_batches(v)[1], SF.BUREAU_ENDINGS))
    .groupBy("batch", "is_valid").agg(F.count(F.lit(1)).alias("files")),
    f"""select batch, batch <> 'upload' as is_valid, cast(sum({PARTS}) as bigint) as files from (select distinct 'upload' as batch, partner_name as stem from partners_raw
 union all select distinct batch_no, 'enq' from enquiries union all select distinct batch_no, 'score' from scores) group by batch""",
    "partners_raw", "enquiries", "scores",
)


def _joined(column: str):
    return F.array_join(F.array_sort(column), ",").alias(column)


def _header_report(v: Views):
    root, inventory = _written(v, "headers", batch_1__enq=_enq(v), batch_1__short=_enq(v).drop("CUSTOMER_ID").withColumn("EXTRA", F.lit("x")))
    report = SF.header_report(SF.header_columns(SF.header_lines(inventory)), SC.EXPERIAN["ENQ"])
    return report.groupBy(_stem(), _joined("missing_columns"), _joined("extra_columns"), _joined("missing_required"), "is_valid").agg(
        F.count(F.lit(1)).alias("files"))


_register(
    "header_report", _header_report,
    f"""select distinct stem, missing_columns, extra_columns, missing_required, is_valid, cast({PARTS} as bigint) as files from enquiries,
 (values ('enq', '', '', '', true), ('short', 'CUSTOMER_ID', 'EXTRA', 'CUSTOMER_ID', false)) t(stem, missing_columns, extra_columns, missing_required, is_valid)""",
    "enquiries",
)


def _partner_header_report(v: Views):
    root = scratch_path(v.spark, "partner-headers")
    rows = v.partners_raw.selectExpr("partner_reference_id as PId", "phone", "name as NAME")
    for stem, frame in (("good", rows), ("no_phone", rows.drop("phone")), ("no_id", rows.drop("PId"))):
        write_named(frame, f"{root}/upload", stem, sep=",")
    headers = SF.header_columns(SF.header_lines(SF.file_inventory(v.spark, root)), ",")
    report = SF.partner_header_report(headers, PF.HEADER_ALIASES)
    return report.groupBy(_stem(), _joined("found_columns"), _joined("missing_columns"), "is_valid").agg(F.count(F.lit(1)).alias("files"))


_register(
    "header_report_partner", _partner_header_report,
    f"""select distinct stem, found_columns, missing_columns, is_valid, cast({PARTS} as bigint) as files from partners_raw,
 (values ('good', 'NAME,PARTNER_REFERENCE_ID,PHONE', '', true), ('no_phone', 'NAME,PARTNER_REFERENCE_ID', 'PHONE or HASHED_PHONE', false), ('no_id', 'NAME,PHONE', 'PARTNER_REFERENCE_ID', false)) t(stem, found_columns, missing_columns, is_valid)""",
    "partners_raw",
)


def _empty_report(v: Views):
    """Every file of two tables, scanned by the layout of one of them."""
    root, inventory = _written(v, "empty", batch_1__enq=_enq(v), batch_1__score=_score(v))
    headers = SF.header_columns(SF.header_lines(inventory))
    rows, _ = SF.scan_delimited(v.spark, inventory, SC.EXPERIAN["ENQ"])
    report = SF.empty_file_report(inventory, rows, SF.header_report(headers, SC.EXPERIAN["ENQ"]))
    return report.groupBy("batch", _stem(), "message").agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count"))


_register(
    "empty_file_report", _empty_report,
    f"""select 'batch_1' as batch, 'enq' as stem, cast(null as varchar) as message, cast({PARTS} as bigint) as files, count(*) as row_count from enquiries
 union all select 'batch_1', 'score', 'schema mismatched', cast({PARTS} as bigint), count(*) from scores""",
    "enquiries", "scores",
)

# -- tables and exports ------------------------------------------------------------------------------

_register("table_scan", lambda v: v.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "select o_orderkey, o_custkey, o_orderstatus from orders")


def _stored(v: Views) -> str:
    path = scratch_path(v.spark, "enq-table")
    rows = v.enquiries.drop("batch_no", "created_at", "m_sub_id")
    for batch in ("batch_1", "batch_2"):
        own = rows.filter(f"inq_purp_cd {'=' if batch == 'batch_2' else '<>'} '13'")
        SK.append_by_name(SK.with_audit(own, batch, AS_OF), path, ["customer_id", "inq_date", "inq_purp_cd", "m_sub_id", "amount", "batch_no", "created_at"])
    return path


STORED_SQL = f"""select customer_id, {day('inq_date')} as inq_date, inq_purp_cd, cast(null as varchar) as m_sub_id, {dbl('amount')} as amount, '2002-01-01' as created_at,
 case when inq_purp_cd = '13' then 'batch_2' else 'batch_1' end as batch_no from enquiries"""
_register("append_by_name", lambda v: v.spark.read.parquet(_stored(v)), STORED_SQL, "enquiries")
_register("batch_slice", lambda v: SK.batch_slice(v.spark, _stored(v), "batch_2"), f"select * from ({STORED_SQL}) where batch_no = 'batch_2'", "enquiries")


def _exported(v: Views):
    path = scratch_path(v.spark, "export")
    SK.export_delimited(v.partners_raw.select("partner_reference_id", "name", "phone"), path, "|")
    return v.spark.read.options(header=True, sep="|").csv(path)


_register("export_delimited", _exported, "select partner_reference_id, name, phone from partners_raw", "partners_raw")


def _summary_json(v: Views):
    path = scratch_path(v.spark, "summary")
    summary = v.partners_processed.groupBy("partner_name", "batch_no").agg(
        F.count(F.lit(1)).alias("record_count"), F.count_if("sent_to_scrub").alias("sent_count"))
    SK.export_summary(summary, path)
    return v.spark.read.schema("partner_name string, batch_no string, record_count bigint, sent_count bigint").json(path)


_register(
    "export_summary_json", _summary_json,
    "select partner_name, batch_no, count(*) as record_count, cast(sum(case when sent_to_scrub then 1 else 0 end) as bigint) as sent_count from partners_processed group by all",
    "partners_processed",
)


def _id_table(v: Views):
    """One written id list filters two files."""
    ids = durable(R.shortlist_ids(v.scores, PREFR_CRITERIA, "customer_id", score_col="score_v3", score_only=True))
    first = R.filter_by_ids(v.enquiries.select("customer_id", F.lit("enq").alias("source")), ids, "customer_id")
    second = R.filter_by_ids(v.tradelines.select("customer_id", F.lit("ar").alias("source")), ids, "customer_id")
    return first.unionByName(second).groupBy("customer_id", "source").agg(F.count(F.lit(1)).alias("row_count"))


_register(
    "temp_id_table", _id_table,
    """select customer_id, source, count(*) as row_count from (select customer_id, 'enq' as source from enquiries union all select customer_id, 'ar' as source from tradelines)
 where customer_id in (select customer_id from scores where score_v3 >= 690) group by all""",
    "enquiries", "tradelines", "scores",
)

# -- pipelines ---------------------------------------------------------------------------------------


def _phones(v: Views, condition: str = "true") -> DataFrame:
    return v.phones.filter(condition).select(
        F.col("customer_id").alias("CUSTOMER_ID"), F.col("phone").alias("PHONE"), F.date_format("date_reported", "dd/MM/yyyy").alias("DATE_REPORTED"))


LATE_HEADER = "INQ_PURP_CD|CUSTOMER_ID|AMOUNT|M_SUB_ID|INQ_DATE"


def _late_lines(v: Views) -> DataFrame:
    """Lines of a later delivery: another column order, and a row of two cells for every score."""
    cells = [F.coalesce(c, F.lit("")) for c in LATE_HEADER.split("|")]
    good = _enq(v, "batch_no <> 'batch_1'").select(F.concat_ws("|", *cells).alias(LATE_HEADER))
    return good.unionByName(v.scores.select(F.concat("customer_id", F.lit("|13")).alias(LATE_HEADER)))


def _deliveries(v: Views) -> tuple[str, list[DataFrame]]:
    """Two deliveries of bureau files: the listing after the first, and after the second.

    The second brings files of the same names in another folder, and a folder and names with blanks.
    """
    root = scratch_path(v.spark, "bureau")
    early, late = "customer_id < 'C5'", "not customer_id < 'C5'"
    for stem, frame in (("enq", _enq(v, "batch_no = 'batch_1'")), ("score", _score(v)), ("phone", _phones(v, early)), ("other", _score(v))):
        write_named(frame, f"{root}/batch_1", stem)
    first = durable(SF.file_inventory(v.spark, root))
    write_named(_late_lines(v), f"{root}/second delivery", "enq of today", sep="\t", quote="")
    write_named(_phones(v, late), f"{root}/second delivery", "phone")
    return root, [first, SF.file_inventory(v.spark, root)]


def _ingested(v: Views):
    """Both deliveries loaded, each with the lender's export; a third run finds nothing new."""
    _, listings = _deliveries(v)
    base = scratch_path(v.spark, "warehouse")
    results = [
        PB.bureau_ingest(v.spark, files, f"{base}/ledger", f"{base}/tables", "batch_1", "experian", AS_OF, lender="prefr", lender_target=f"{base}/lender")
        for files in (*listings, listings[-1])
    ]
    return base, listings[-1], durable(reduce(lambda a, b: a.unionByName(b), results))


STORED_ENQ = ("CUSTOMER_ID", "INQ_PURP_CD", "INQ_DATE", "M_SUB_ID", "AMOUNT")
STORED_ENQ_SQL = f"select customer_id as CUSTOMER_ID, inq_purp_cd as INQ_PURP_CD, {day('inq_date')} as INQ_DATE, m_sub_id as M_SUB_ID, {dbl('amount')} as AMOUNT"
_register(
    "bureau_ingest",
    lambda v: PB.stored_rows(v.spark, f"{_ingested(v)[0]}/tables", "ENQ").select(*STORED_ENQ, "batch_no", "created_at"),
    STORED_ENQ_SQL + ", 'batch_1' as batch_no, '2002-01-01' as created_at from enquiries", "enquiries",
)


def _replaced(v: Views):
    """Files delivered again under their names, with other rows: theirs replace the former ones, other files' stay."""
    first, second, target = (scratch_path(v.spark, kind) for kind in ("first", "again", "warehouse"))
    write_named(_enq(v, "batch_no = 'batch_1'"), f"{first}/day", "enq")
    write_named(_enq(v, "batch_no <> 'batch_1' and customer_id < 'C5'"), f"{first}/day", "kept enq")
    write_named(_enq(v, "batch_no <> 'batch_1' and not customer_id < 'C5'"), f"{second}/day", "enq")
    for root in (first, second):
        files = durable(SF.file_inventory(v.spark, root))
        durable(PB.load_table(v.spark, files, target, "ENQ", "experian", "batch_1", AS_OF, bucket_bytes=1 << 16))
    return PB.stored_rows(v.spark, target, "ENQ").select(*STORED_ENQ, "batch_no")


_register(
    "bureau_replaced_files", _replaced, STORED_ENQ_SQL + ", 'batch_1' as batch_no from enquiries where batch_no <> 'batch_1'", "enquiries",
)


def _ingest_report(v: Views):
    return _ingested(v)[2].groupBy("batch", _stem(), "status").agg(
        F.count(F.lit(1)).alias("files"), *[F.sum(c).alias(c) for c in ("original_count", "bad_count", "final_count")])


_register(
    "bureau_ingest_report", _ingest_report,
    f"""select batch, stem, 'Processed' as status, cast({PARTS} as bigint) as files, cast(n + bad as bigint) as original_count, cast(bad as bigint) as bad_count, cast(n as bigint) as final_count from (
 select 'batch_1' as batch, 'enq' as stem, count(*) as n, 0 as bad from enquiries where batch_no = 'batch_1'
 union all select 'second delivery', 'enq of today', count(*), (select count(*) from scores) from enquiries where batch_no <> 'batch_1'
 union all select 'batch_1', 'score', count(*), 0 from scores
 union all select 'batch_1', 'phone', count(*), 0 from phones where customer_id < 'C5'
 union all select 'second delivery', 'phone', count(*), 0 from phones where not customer_id < 'C5')""",
    "enquiries", "scores", "phones",
)


def _ledger(v: Views):
    base, inventory, _ = _ingested(v)
    ledger = LG.read_ledger(v.spark, f"{base}/ledger")
    left = LG.unprocessed(inventory, ledger).groupBy("batch").agg(F.count(F.lit(1)).alias("files_left"))
    return LG.batch_status(inventory, ledger).join(left, "batch", "left").fillna(0, ["files_left"])


_register(
    "processed_file_ledger", _ledger,
    f"""select batch, cast((loaded + other) * {PARTS} as bigint) as files_listed, cast(loaded * {PARTS} as bigint) as files_loaded, cast(other * {PARTS} as bigint) as files_left,
 case when other > 0 then 'failed' else 'success' end as final_status
 from (select 'batch_1' as batch, 3 as loaded, 1 as other, count(*) as n from scores union all select 'second delivery', 2, 0, count(*) from scores)""",
    "scores",
)


def _incremental(v: Views):
    """Two deliveries of files, loaded by two runs of the stream; the second binds another column order."""
    base = scratch_path(v.spark, "stream")
    folder, target, checkpoint = f"{base}/in", f"{base}/tables", f"{base}/checkpoint"
    for run, (frame, options) in enumerate(((_enq(v, "batch_no = 'batch_1'"), {}), (_late_lines(v), {"sep": "\t", "quote": ""}))):
        write_named(frame, f"{folder}/run {run}", "enq", **options)
        incremental_ingest(v.spark, folder, target, checkpoint, "ENQ", "experian", "batch_1", AS_OF).awaitTermination()
    rows = PB.stored_rows(v.spark, target, "ENQ").select("folder", *STORED_ENQ)
    bad = PB.stored_rows(v.spark, target, PB.BAD_ROWS).select("folder", F.split_part("line", F.lit("|"), F.lit(1)).alias("CUSTOMER_ID"))
    return rows.unionByName(bad, allowMissingColumns=True)


_register(
    "incremental_file_ingest", _incremental,
    STORED_ENQ_SQL + """, case when batch_no = 'batch_1' then 'run 0' else 'run 1' end as folder from enquiries
 union all select customer_id, null, null, null, null, 'run 1' from scores""",
    "enquiries", "scores",
)


def _lender_root(v: Views):
    prefixed = [F.concat(F.lit("PRFR"), "CUSTOMER_ID").alias("CUSTOMER_ID")]
    enq = _enq(v)
    score = _score(v).withColumnRenamed("CUST_ID", "CUSTOMER_ID")
    odd = F.pmod(F.crc32("CUSTOMER_ID"), F.lit(2)) == 1
    as_sent = lambda df: df.select(*prefixed, *[c for c in df.columns if c != "CUSTOMER_ID"])
    return _written(
        v, "lender", batch_1__enq=as_sent(enq.filter(odd)), batch_2__enq=as_sent(enq.filter(~odd)),
        batch_1__score=as_sent(score.filter(odd)), batch_2__score=as_sent(score.filter(~odd)),
    )


def _merged(v: Views):
    merged = PL.merge_batches(v.spark, _lender_root(v)[1], ["batch_1", "batch_2"])
    enq = reduce(lambda a, b: a.unionByName(b), [df for name, df in merged.items() if name.startswith("enq")])
    return enq.select("CUSTOMER_ID", "INQ_PURP_CD", "AMOUNT")


_register(
    "merge_batch_files", _merged,
    "select 'PRFR' || customer_id as CUSTOMER_ID, inq_purp_cd as INQ_PURP_CD, cast(amount as varchar) as AMOUNT from enquiries", "enquiries",
)


def _lender_export(v: Views):
    """Shortlisted rows of all score files of two batches, in the record layout."""
    inventory = _lender_root(v)[1]
    return PL.lender_export(v.spark, inventory, ["batch_1", "batch_2"], PREFR_CRITERIA, "prefr", "experian", "lender_batch_1", AS_OF)[1]


_register(
    "lender_export", _lender_export,
    """select '2002-01-01' as created_at, customer_id as bureau_id, 'PRFR' || customer_id as lender_uid, 'lender_batch_1' as lender_batch, 'prefr' as lender_name, 'experian' as bureau_type
 from scores where score_v3 >= 690""", "scores",
)


def _stored_features(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "rule-features")
    block_features(v.tradelines_dpd, RULE_FEATURES).write.parquet(path)
    return v.spark.read.parquet(path)


def _rules_export(v: Views, logic: str):
    """The record where all of prefr's rules act, on score files and stored features."""
    done = PL.lender_export(
        v.spark, _lender_root(v)[1], ["batch_1", "batch_2"], PREFR_CRITERIA | {"logic": logic}, "prefr", "experian", "lender_batch_1", AS_OF,
        features=_stored_features(v), feature_id=F.concat(F.lit("PRFR"), "customer_id"), aliases={"dpd_m03_all": "max_dpd_l3m_all"})
    return done[1]


for _logic, _rules in (
    ("AND", "s.score_v3 >= 690 and s.customer_id in (select customer_id from f where nbr_cc >= 1 and max_dpd_l3m_all = 10)"),
    ("OR", "s.score_v3 >= 690 or s.customer_id in (select customer_id from f where nbr_cc >= 1 or max_dpd_l3m_all = 10)"),
):
    _register(
        f"lender_export_rules_{_logic.lower()}", lambda v, logic=_logic: _rules_export(v, logic),
        f"""with f as ({features_sql(RULE_FEATURES, 'tradelines_dpd')})
 select '2002-01-01' as created_at, s.customer_id as bureau_id, 'PRFR' || s.customer_id as lender_uid, 'lender_batch_1' as lender_batch, 'prefr' as lender_name, 'experian' as bureau_type
 from scores s where {_rules}""",
        "tradelines", "tradelines_dpd", "scores",
    )
_register(
    "lender_offers",
    lambda v: PL.lender_offers(v.spark, _offer_files(v), AS_OF).drop("LENDERS_ATTRIBUTE"),
    f"""select '2002-01-01' as CREATED_AT, customer_number as LENDER_UID, '0' as LENDER_NAME, {dbl(amount_sql('approved_loan_amount'))} as LOAN_AMOUNT, roi as ROI, max_tenure_by_policy as TENURE,
 {day(parsed_day('trim(offer_expiry_date)', OFFER_MASKS))} as OFFER_EXPIRY_DATE from offers_raw""",
    "offers_raw",
)
_register(
    "lender_offers_attributes",
    lambda v: PL.lender_offers(v.spark, _offer_files(v), AS_OF).select("LENDER_UID", "LENDERS_ATTRIBUTE"),
    f"select customer_number as LENDER_UID, {OFFER_JSON.replace('mobile_no', 'MOBILE_NO', 1).replace('offer_status', 'OFFER_STATUS', 2)} as LENDERS_ATTRIBUTE from offers_raw",
    "offers_raw",
)
