"""Partner and bureau stages on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadforge.operators import leads as L
from leadforge.operators import scrub as S
from leadforge.plans import export as E
from leadforge.plans import partner as P

AS_OF = dt.date(2002, 1, 1)


def test_ids_are_unique_gap_free_and_continue(spark):
    df = spark.range(5000).select(F.concat(F.lit("L"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("lead_id"))
    numbered = S.assign_bureau_ids(df.repartition(13), "EQ", AS_OF, 41, ["lead_id"])
    rows = numbered.orderBy("lead_id").collect()
    assert [r["bureau_id"] for r in rows] == [f"EQ01012002{n:012d}" for n in range(41, 5041)]


def test_ids_do_not_pass_through_one_partition(spark):
    df = spark.range(100).withColumn("lead_id", F.col("id").cast("string"))
    plan = df.repartitionByRange("lead_id")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan.lower()


def test_next_index_reads_all_twelve_digits(spark):
    exchange = spark.createDataFrame([("EQ01012002000012345678",), ("EQ02012002999999999999",), ("EX01012002000099999999",)], "bureau_id string")
    assert S.next_bureau_index(exchange, "EQ", AS_OF) == 12345679
    assert S.next_bureau_index(exchange, "EQ", dt.date(2003, 1, 1)) == 1


def test_score_gate_gives_each_lead_once(spark):
    exchange = spark.createDataFrame(
        [("l1", "b1", None, None, None, "batch_1", AS_OF), (None, "b2", None, None, None, "batch_1", AS_OF)],
        "lead_id string, bureau_id string, hashed_phone string, phone string, pan_no string, scrub_batch_no string, scrub_date date")
    responses = spark.createDataFrame([("b1", "650"), ("b1", "700"), ("b1", "bad"), ("b2", "800")], "reference_no string, score string")
    assert [r["lead_id"] for r in S.score_gate(exchange, responses, "batch_1", 600).collect()] == ["l1"]


def test_batches_without_due_leads_get_a_warning(spark):
    due = spark.createDataFrame([("l", "batch_1")], "lead_id string, batch_no string")
    report = {r["batch_no"]: (r["record_count"], r["warning"]) for r in S.batch_selection_report(due, ["batch_1", "batch_7"]).collect()}
    assert report == {"batch_1": (1, None), "batch_7": (0, "Batch batch_7: No pending records found")}


def _raw(spark):
    rows = [("P1", "h1"), ("P2", "h1"), ("P3", None), ("P4", "h9"), ("P5", "")]
    df = spark.createDataFrame([(a, b, "alpha", "batch_1", "f.csv", 0, i) for i, (a, b) in enumerate(rows)],
                               "partner_reference_id string, hashed_phone string, partner_name string, batch_no string, filename string, file_seq int, row_seq int")
    return L.mark_duplicates(df)


def test_missing_and_matched_add_up_to_new(spark):
    raw = _raw(spark)
    base = spark.createDataFrame([("h1", "lead-1")], "hashed_phone string, lead_id string")
    updated, processed, summary = P.process_batch(raw, base, AS_OF)
    status = {r["partner_reference_id"]: r["status"] for r in updated.collect()}
    assert status == {"P1": "processed", "P2": "duplicate", "P3": L.MISSING_ID, "P4": L.MISSING_ID, "P5": L.MISSING_ID}
    assert [r["lead_id"] for r in processed.collect()] == ["lead-1"]
    row = summary.first()
    assert (row["original_count"], row["cleaned_count"], row["duplicates_found"], row["missing_id_count"]) == (5, 1, 1, 3)


def test_settling_equals_the_two_single_steps(spark):
    raw = _raw(spark)
    base = spark.createDataFrame([("h1", "lead-1"), ("h7", "lead-7")], "hashed_phone string, lead_id string")
    processed = L.processed_rows(L.match_phone(raw, base), AS_OF)
    steps = L.mark_processed(L.mark_missing(raw, base), processed)
    pick = lambda df: sorted(map(str, df.select("partner_reference_id", "status").collect()))
    assert pick(L.settle(raw, base)) == pick(steps)


def test_a_second_run_changes_nothing(spark):
    base = spark.createDataFrame([("h1", "lead-1")], "hashed_phone string, lead_id string")
    updated, _, _ = P.process_batch(_raw(spark), base, AS_OF)
    again, processed, _ = P.process_batch(updated, base, AS_OF)
    assert processed.count() == 0
    assert sorted(map(str, again.select("partner_reference_id", "status").collect())) == sorted(map(str, updated.select("partner_reference_id", "status").collect()))


def test_stored_batches_are_replaced_in_place(spark, tmp_path):
    raw_path, leads_path = str(tmp_path / "raw"), str(tmp_path / "leads")
    other = _raw(spark).withColumn("batch_no", F.lit("batch_2"))
    _raw(spark).unionByName(other).write.partitionBy(*P.RAW_PARTITIONS).parquet(raw_path)
    base = spark.createDataFrame([("h1", "lead-1")], "hashed_phone string, lead_id string")
    for _ in range(2):
        raw = spark.read.parquet(raw_path).filter("batch_no = 'batch_1'")
        updated, processed, _ = P.process_batch(raw, base, AS_OF, "alpha", "batch_1")
        P.store_batch(updated, processed, raw_path, leads_path)
    stored = spark.read.parquet(raw_path)
    assert stored.count() == 10
    assert stored.filter("status = 'processed'").select("batch_no", "partner_reference_id").collect() == [("batch_1", "P1")]
    assert spark.read.parquet(leads_path).count() == 1


def test_a_run_cut_short_between_leads_and_raw_rows_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    raw_path, leads_path = str(tmp_path / "raw"), str(tmp_path / "leads")
    _raw(spark).write.partitionBy(*P.RAW_PARTITIONS).parquet(raw_path)
    base = spark.createDataFrame([("h1", "lead-1")], "hashed_phone string, lead_id string")

    def store():
        updated, processed, _ = P.process_batch(spark.read.parquet(raw_path), base, AS_OF, "alpha", "batch_1")
        P.store_batch(updated, processed, raw_path, leads_path)

    def broken(*_):
        raise OSError("cut short")

    with monkeypatch.context() as patch:
        patch.setattr(P, "overwrite_partitions", broken)
        with pytest.raises(OSError):
            store()
    store()
    assert spark.read.parquet(leads_path).count() == 1
    assert spark.read.parquet(raw_path).filter("status = 'processed'").count() == 1


def test_second_bureau_export_marks_both_tables(spark):
    exchange = spark.createDataFrame(
        [("l1", "b1", None, None, None, "batch_1", AS_OF, False), ("l2", "b2", None, None, None, "batch_1", AS_OF, False)],
        "lead_id string, bureau_id string, hashed_phone string, phone string, pan_no string, scrub_batch_no string, scrub_date date, sent_to_experian boolean")
    responses = spark.createDataFrame([("b1", "650"), ("b2", "100")], "reference_no string, score string")
    second = spark.createDataFrame([], "lead_id string, scrub_batch_no string")
    processed = spark.createDataFrame([("l1", False, None), ("l2", False, None)], "lead_id string, sent_to_scrub boolean, scrub_date date")
    rows, flagged, leads = E.second_bureau_export(exchange, responses, second, processed, "batch_1", AS_OF)
    assert [r["lead_id"] for r in rows.collect()] == ["l1"]
    assert {r["lead_id"]: r["sent_to_experian"] for r in flagged.collect()} == {"l1": True, "l2": False}
    assert {r["lead_id"]: r["sent_to_scrub"] for r in leads.collect()} == {"l1": True, "l2": False}
    everyone, _, _ = E.second_bureau_export(exchange, responses, second, processed, "batch_1", AS_OF, min_score=None)
    assert everyone.count() == 2


def test_next_partner_batch_keeps_the_number_on_the_same_day(spark):
    lines = [(1, "Partner: a, Batch no: 3, date: 2001-12-31 10:00"), (2, "partner: a, batch: 4, date: 2002-01-01 09:00"),
             (3, "x partner: b, batch no: 7, date: 2001-06-01"), (4, "partner: b, batch no: 9, date: someday"), (5, "noise")]
    log = spark.createDataFrame(lines, "line_no int, value string")
    assert {r["partner_name"]: r["next_batch"] for r in L.next_partner_batch(log, AS_OF).collect()} == {"a": 4, "b": 8}
    assert L.next_numbered_batch(log, "scrub_batch_no").first()["next_batch"] == 1
