"""Stages over stored tables, cut short and run again."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from leadforge.operators import rules as R
from leadforge.plans import bureau as PB
from leadforge.plans import lenders as PL
from leadforge.plans import stored as ST
from leadforge.sources.files import decoded, file_inventory
from leadforge.sources.schemas import TABLES
from leadforge.sources.sinks import FEW_BYTES, OPEN_FILES, OPEN_WRITERS, TASK_BYTES, in_table_layout, overwrite_partitions

AS_OF = dt.date(2002, 1, 1)


@pytest.fixture
def leads(spark, tmp_path):
    rows = [("P1", "l1", "h1", "batch_1", False), ("P2", "l2", "h2", "batch_1", False),
            ("P3", "l1", "h1", "batch_2", False), ("P4", "l9", "h9", "batch_3", False), ("P5", None, None, "batch_1", None)]
    frame = spark.createDataFrame(rows, "partner_reference_id string, lead_id string, hashed_phone string, batch_no string, sent_to_scrub boolean")
    overwrite_partitions(in_table_layout(frame, ST.PROCESSED), str(tmp_path / "leads"), ("batch_no",))
    return tmp_path


def _export(spark, base, batch="s1", **options):
    ST.store_bureau_export(spark, str(base / "leads"), str(base / "equifax"), str(base / "file"), ["batch_1"], batch, AS_OF, **options)


def _flags(spark, base):
    stored = ST.read_table(spark, str(base / "leads"), ST.PROCESSED)
    return {r["partner_reference_id"]: r["sent_to_equifax"] for r in stored.collect()}


def _exchange(spark, base):
    rows = ST.read_table(spark, str(base / "equifax"), TABLES["equifax_exchange"]).collect()
    return sorted((r["lead_id"], r["bureau_id"], r["scrub_batch_no"], r["sent_to_experian"]) for r in rows)


def test_an_export_cut_short_before_the_flags_is_completed(spark, leads, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(ST, "_store_sent", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            _export(spark, leads)
    first = _exchange(spark, leads)
    assert [r[0] for r in first] == ["l1", "l2"] and not any(_flags(spark, leads).values())
    _export(spark, leads)
    assert _exchange(spark, leads) == first
    assert _flags(spark, leads) == {"P1": True, "P2": True, "P3": True, "P4": None, "P5": False}
    assert spark.read.option("header", True).csv(str(leads / "file" / "s1")).count() == 2


def test_ids_of_a_second_batch_continue(spark, leads):
    _export(spark, leads)
    _export(spark, leads, "s2", days=-1)  # all are due again
    numbers = [int(r[1][-12:]) for r in _exchange(spark, leads)]
    assert sorted(numbers) == [1, 2, 3, 4]


def test_handing_on_twice_keeps_rows_and_flags(spark, leads):
    _export(spark, leads)
    (_, good, _, _), _ = _exchange(spark, leads)
    answers = spark.createDataFrame([(good, "700"), (good, "800")], "reference_no string, score string")
    for _ in range(2):
        ST.store_second_export(spark, str(leads / "equifax"), answers, str(leads / "experian"), str(leads / "leads"), str(leads / "file2"), "s1", AS_OF)
    second = ST.read_table(spark, str(leads / "experian"), TABLES["experian_exchange"]).collect()
    assert [(r["lead_id"], r["bureau_id"]) for r in second] == [("l1", good)]
    assert [r[3] for r in _exchange(spark, leads)] == [True, False]
    stored = ST.read_table(spark, str(leads / "leads"), ST.PROCESSED).collect()
    assert {r["partner_reference_id"] for r in stored if r["sent_to_experian"]} == {"P1", "P3"}
    assert _flags(spark, leads)["P2"] is True


def test_an_export_without_due_leads_stores_nothing(spark, leads):
    ST.store_bureau_export(spark, str(leads / "leads"), str(leads / "equifax"), str(leads / "file"), ["batch_7"], "s1", AS_OF)
    assert _exchange(spark, leads) == []
    assert len(_flags(spark, leads)) == 5


def _lenders(spark, *rows):
    return spark.createDataFrame(rows, "lender_name string, bureau_type string, created_at int, is_active boolean, eligible_criteria string")


def test_the_newest_active_readable_criteria_hold(spark):
    rule = lambda value: json.dumps({"logic": "AND", "rules": [{"field": "score", "operator": ">=", "value": value}]})
    lenders = _lenders(
        spark, ("Zype", "Equifax", 1, True, rule(600)), ("ZYPE", "EQUIFAX", 2, True, rule(650)), ("zype", "equifax", 3, False, rule(700)),
        ("zype", "equifax", 4, True, "no json"), ("zype", "equifax", 5, True, None), ("prefr", "experian", 9, True, rule(1)))
    assert R.stored_criteria(lenders, "zype", "equifax")["rules"] == [{"field": "score", "operator": ">=", "value": 650.0}]
    assert R.stored_criteria(lenders, "zype", "experian") is None
    assert PL.export_for_lender(spark, lenders, None, [], "prefr", "equifax", "b", AS_OF) is None


def test_untouched_rows_are_not_shuffled_by_partition(spark, tmp_path):
    """A table of few partitions: finding those that hold a lead puts no whole partition in one task."""
    rows = [(f"l{i}", f"batch_{i % 4 + 1}") for i in range(200)]
    spark.createDataFrame(rows, "lead_id string, batch_no string").write.partitionBy("batch_no").parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = spark.read.parquet(str(tmp_path / "t"))
        found = ST._with_leads(table, table.filter("lead_id in ('l1', 'l2', 'l5')").select("lead_id"), "batch_no")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [coalesce(batch_no" in plan, plan
        assert {r["batch_no"] for r in found.collect()} == {"batch_2", "batch_3"} and found.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_partitioned_write_sorts_nothing(spark, tmp_path, monkeypatch):
    """Files stay open side by side, also where a task meets more partitions than that; the session is left as it was."""
    seen, plain = [], type(spark.range(1).write).parquet
    monkeypatch.setattr(type(spark.range(1).write), "parquet", lambda w, p: (seen.append(spark.conf.get(OPEN_WRITERS)), plain(w, p))[1])
    before = spark.conf.get(OPEN_WRITERS)
    overwrite_partitions(spark.range(100).selectExpr("id", "id % 9 as k").coalesce(1), str(tmp_path / "t"), ("k",))
    assert seen == [str(OPEN_FILES)] and spark.conf.get(OPEN_WRITERS) == before
    assert sorted((r["k"], r["n"]) for r in spark.read.parquet(str(tmp_path / "t")).selectExpr("k", "id % 9 n").distinct().collect()) == [(i, i) for i in range(9)]


def test_a_batch_of_wide_rows_is_written_where_it_lies(spark, tmp_path):
    """Nothing is shuffled for the write: each task writes its own file of the one partition."""
    overwrite_partitions(spark.range(0, 100, 1, 5).selectExpr("id", "'b' as batch_no"), str(tmp_path / "t"), gather=False)
    assert len(list((tmp_path / "t" / "batch_no=b").glob("*.parquet"))) == 5
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100


def test_plain_paths_are_not_decoded_row_by_row(spark):
    rows = spark.createDataFrame([("file:/a b+c/d",), ("file:/a%20b+c%2Bd",), (None,)], "p string").select(decoded(F.col("p")).alias("p"))
    assert "CASE WHEN" in rows._jdf.queryExecution().analyzed().toString()
    assert [r["p"] for r in rows.collect()] == ["file:/a b+c/d", "file:/a b+c+d", None]


def test_loaded_rows_are_not_shuffled_by_file(spark, tmp_path, monkeypatch):
    (tmp_path / "in" / "day").mkdir(parents=True)
    for i in range(3):
        (tmp_path / "in" / "day" / f"score_{i}.txt").write_text(f"CUST_ID|SCORE_V3\nC{i}|700\n")
    plans, store = [], PB.store_files
    monkeypatch.setattr(PB, "store_files", lambda rows, *a: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), store(rows, *a))[1])
    files = file_inventory(spark, str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = PB.load_table(spark, files, str(tmp_path / "t"), "SCORE", "experian", "batch_1", AS_OF).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 2 and not any("SortMergeJoin" in plan or "hashpartitioning(file_path" in plan for plan in plans)
    assert sorted((r["original_count"], r["final_count"]) for r in counts) == [(1, 1)] * 3


def test_the_feature_job_puts_little_of_a_shuffle_together_for_a_task(spark, tmp_path, monkeypatch):
    """Only while it is written: the setting of the session is back afterwards."""
    seen, before = [], spark.conf.get(TASK_BYTES)
    monkeypatch.setattr(ST, "add_tli", lambda *given: spark.range(3).selectExpr("id", "'b' as batch_no"))
    monkeypatch.setattr(ST, "read_table", lambda *given: None)
    monkeypatch.setattr(ST, "overwrite_partitions", lambda *given, **how: (seen.append(spark.conf.get(TASK_BYTES)), overwrite_partitions(*given, **how)))
    stored = ST.store_features("", None, spark.range(1), None, "b", AS_OF, str(tmp_path / "t"))
    assert stored.count() == 3 and seen == [FEW_BYTES] and spark.conf.get(TASK_BYTES) == before
