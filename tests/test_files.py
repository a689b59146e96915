"""Scans, reports, ingest and stream over real files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadforge.operators import rules as R
from leadforge.operators.leads import mark_duplicates
from leadforge.plans import bureau as PB
from leadforge.plans import lenders as PL
from leadforge.plans import partner as PP
from leadforge.sources import filemap as FM
from leadforge.sources import files as SF
from leadforge.sources import ledger as LG
from leadforge.sources import partner_files as PF
from leadforge.sources import schemas as SC
from leadforge.sources import sinks as SK
from leadforge.streaming.ingest import incremental_ingest

AS_OF = dt.date(2002, 1, 1)


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_quotes_nulls_and_ragged_rows(spark, tmp_path):
    put(tmp_path / "b1" / "enq.txt", 'CUSTOMER_ID|INQ_PURP_CD|INQ_DATE|M_SUB_ID|AMOUNT\nC1|13|01/01/2001|"N|BF"|5\nC2|NULL|NUL||\nC3|13\nC4|13|01/01/2001|NBF|5|extra\n')
    good, bad = SF.scan_delimited(spark, SF.file_inventory(spark, str(tmp_path)), SC.EXPERIAN["ENQ"])
    rows = {r["CUSTOMER_ID"]: r for r in good.collect()}
    assert set(rows) == {"C1", "C2"}
    assert rows["C1"]["M_SUB_ID"] == "N|BF" and rows["C2"]["INQ_PURP_CD"] is None and rows["C2"]["AMOUNT"] is None
    assert good.select("CUSTOMER_ID").count() == 2 and good.count() == 2
    assert bad.count() == 2


def test_columns_follow_each_files_header(spark, tmp_path):
    put(tmp_path / "b1" / "a.txt", "SCORE_V3|CUST_ID\n700|C1\n")
    put(tmp_path / "b2" / "a.txt", "CUST_ID|OTHER\nC2|x\n")
    good, _ = SF.scan_delimited(spark, SF.file_inventory(spark, str(tmp_path)), SC.EXPERIAN["SCORE"])
    assert {(r["CUST_ID"], r["SCORE_V3"]) for r in good.collect()} == {("C1", "700"), ("C2", None)}


def test_inventory_and_batch_choice(spark, tmp_path):
    for batch, name in (("b1", "x.txt"), ("b2", "x.txt"), ("b2", "only.txt")):
        put(tmp_path / batch / name, "A\n1\n")
    inventory = SF.file_inventory(spark, str(tmp_path))
    kinds = {r["file_name"]: (r["kind"], r["batches"]) for r in SF.common_unique(inventory).collect()}
    assert kinds == {"x.txt": ("common", ["b1", "b2"]), "only.txt": ("unique", ["b2"])}
    assert SF.file_inventory(spark, str(tmp_path), ["b1"]).count() == 1


def test_empty_and_wrong_files_are_reported(spark, tmp_path):
    put(tmp_path / "b" / "empty.txt", "CUSTOMER_ID|INQ_PURP_CD|INQ_DATE|M_SUB_ID|AMOUNT\n")
    put(tmp_path / "b" / "wrong.txt", "INQ_PURP_CD|NEW\n")
    put(tmp_path / "b" / "fine.txt", "CUSTOMER_ID|INQ_PURP_CD|INQ_DATE|M_SUB_ID|AMOUNT\nC1|1|01/01/2001|X|1\n")
    inventory = SF.file_inventory(spark, str(tmp_path))
    report = SF.header_report(SF.header_columns(SF.header_lines(inventory)), SC.EXPERIAN["ENQ"])
    rows, _ = SF.scan_delimited(spark, inventory, SC.EXPERIAN["ENQ"])
    got = {r["file_name"]: (r["row_count"], r["message"]) for r in SF.empty_file_report(inventory, rows, report).collect()}
    assert got == {"empty.txt": (0, "no records found"), "wrong.txt": (0, "schema mismatched"), "fine.txt": (1, None)}
    strict = SF.header_report(SF.header_columns(SF.header_lines(inventory)), SC.EXPERIAN["ENQ"], strict=True)
    assert strict.filter("file_name = 'wrong.txt' and not is_valid").count() == 1


def test_partner_encodings(spark, tmp_path):
    text = "PId, phone ,NAME\nP1,911,Zoë\nP2,911,Ann\n"
    for name, encoding in (("a.csv", "utf-8"), ("b.csv", "utf-8-sig"), ("c.csv", "latin1"), ("d.csv", "utf-16")):
        put(tmp_path / "up" / name, text, encoding)
    rows = PF.scan_partner_csv(spark, SF.file_inventory(spark, str(tmp_path)))
    got = sorted((r["FILENAME"], r["PARTNER_REFERENCE_ID"], r["PHONE"], r["NAME"]) for r in rows.collect())
    assert got == sorted((f, p, "911", n) for f in ("a.csv", "b.csv", "c.csv", "d.csv") for p, n in (("P1", "Zoë"), ("P2", "Ann")))
    lower = rows.toDF(*[c.lower() for c in rows.columns]).selectExpr("*", "'p' as partner_name", "'b' as batch_no")
    marked = mark_duplicates(lower, "phone", ("filename", "file_offset", "row_seq"))
    assert marked.filter("status = 'not processed'").select("filename", "partner_reference_id").collect() == [("a.csv", "P1")]
    assert marked.filter("duplicate_kind = 'in_file'").count() == 1 and marked.filter("duplicate_kind = 'in_batch'").count() == 6


def test_partner_upload_turns_bad_files_away(spark, tmp_path):
    put(tmp_path / "up" / "a.csv", "PId,phone\nP1,911\nP2,911\n")
    put(tmp_path / "up" / "b.csv", "pid,hashed_phone\nP3,911\nP4,\n")
    put(tmp_path / "up" / "c.csv", "phone\n911\n")
    put(tmp_path / "up" / "d.xlsx", "PId,phone\nP5,912\n")
    partners = spark.createDataFrame([("alpha", "id-1")], "partner_name string, partner_id string")
    rows, report = PP.ingest_files(spark, SF.file_inventory(spark, str(tmp_path)), partners, "alpha", "batch_1", AS_OF)
    got = {r["partner_reference_id"]: (r["status"], r["duplicate_kind"], r["partner_id"]) for r in rows.collect()}
    assert got == {"P1": ("not processed", None, "id-1"), "P2": ("duplicate", "in_file", "id-1"),
                   "P3": ("duplicate", "in_batch", "id-1"), "P4": ("not processed", None, "id-1")}
    verdicts = {r["file_name"]: (r["is_valid"], r["missing_columns"]) for r in report.collect()}
    assert verdicts["c.csv"] == (False, ["PARTNER_REFERENCE_ID"]) and verdicts["d.xlsx"][0] is False and verdicts["a.csv"][0]


HEADER = "CUSTOMER_ID|INQ_PURP_CD|INQ_DATE|M_SUB_ID|AMOUNT\n"


def _bureau(tmp_path):
    put(tmp_path / "in" / "batch_1" / "enq_1.txt", HEADER + "C1|13|01/01/2001|NBF|5\nC1|13|01/01/2001|NBF|5\n|13|01/01/2001|NBF|5\n")
    put(tmp_path / "in" / "batch_1" / "enq_2.txt", HEADER + "C1|13|01/01/2001|NBF|5\nC2|13|bad|NBF|x\n")
    put(tmp_path / "in" / "batch_1" / "x_email.txt", 'CUSTOMER_ID|EMAIL|DATE_REPORTED\nC1|"A@Gmail.con"|01/01/2001\n')
    put(tmp_path / "in" / "batch_1" / "unknown.bin", "?\n")


def _load(spark, tmp_path):
    inventory = SF.file_inventory(spark, str(tmp_path / "in"))
    return inventory, PB.bureau_ingest(
        spark, inventory, str(tmp_path / "ledger"), str(tmp_path / "tables"), "batch_1", "experian", AS_OF,
        lender="prefr", lender_target=str(tmp_path / "lender"))


def test_ingest_loads_once_and_reports(spark, tmp_path):
    _bureau(tmp_path)
    inventory, results = _load(spark, tmp_path)
    got = {r["file_name"]: (r["original_count"], r["final_count"], r["status"]) for r in results.collect()}
    assert got == {"enq_1.txt": (3, 1, "Processed"), "enq_2.txt": (2, 2, "Processed"), "x_email.txt": (1, 1, "Processed")}
    assert spark.read.parquet(str(tmp_path / "tables" / "enq")).count() == 3
    assert spark.read.parquet(str(tmp_path / "tables" / "email")).first()["EMAIL"] == "a@gmail.com"
    ledger = LG.read_ledger(spark, str(tmp_path / "ledger"))
    assert LG.batch_status(inventory, ledger).first()["final_status"] == "failed"
    assert [r["file_name"] for r in LG.unprocessed(inventory, ledger).collect()] == ["unknown.bin"]
    _, again = _load(spark, tmp_path)
    assert again.count() == 0
    assert spark.read.parquet(str(tmp_path / "tables" / "enq")).count() == 3
    sent = spark.read.options(header=True, sep="|").csv(str(tmp_path / "lender" / "batch_1" / "enq"))
    assert {r["CUSTOMER_ID"] for r in sent.collect()} == {"PRFRC1", "PRFRC2"}
    assert LG.reset_batch(ledger, "batch_1").count() == 0


def test_a_second_delivery_completes_the_export(spark, tmp_path):
    _bureau(tmp_path)
    _load(spark, tmp_path)
    put(tmp_path / "in" / "batch_1" / "enq_3.txt", HEADER + "C3|13|01/01/2001|NBF|5\n")
    _, results = _load(spark, tmp_path)
    assert [r["file_name"] for r in results.collect()] == ["enq_3.txt"]
    sent = spark.read.options(header=True, sep="|").csv(str(tmp_path / "lender" / "batch_1" / "enq"))
    assert {r["CUSTOMER_ID"] for r in sent.collect()} == {"PRFRC1", "PRFRC2", "PRFRC3"}


def test_odd_names_orders_and_ragged_rows(spark, tmp_path):
    """One name in two folders, blanks, percent signs and wildcards in names, another column order, a repeated column."""
    put(tmp_path / "in" / "007" / "enq [1]+%20 é.txt", HEADER + "C1|13|01/01/2001|NBF|5\nC2|13\n")
    put(tmp_path / "in" / "day 2" / "enq [1]+%20 é.txt", "INQ_PURP_CD|CUSTOMER_ID|AMOUNT|M_SUB_ID|INQ_DATE\n13|C3|5|NBF|01/01/2001\n")
    put(tmp_path / "in" / "day 2" / "enq_twice.txt", "CUSTOMER_ID|INQ_PURP_CD|AMOUNT|AMOUNT\nC4|13|1|2\n")
    put(tmp_path / "in" / "day 2" / "enq_ragged.txt", HEADER + "C5\n")
    inventory, results = _load(spark, tmp_path)
    got = {(r["folder"], r["file_name"]): (r["original_count"], r["bad_count"], r["final_count"], r["status"]) for r in results.collect()}
    odd = "enq [1]+%20 é.txt"
    assert got == {("007", odd): (2, 1, 1, "Processed"), ("day 2", odd): (1, 0, 1, "Processed"),
                   ("day 2", "enq_twice.txt"): (1, 0, 1, "Processed"), ("day 2", "enq_ragged.txt"): (1, 1, 0, "Failed")}
    stored = PB.stored_rows(spark, str(tmp_path / "tables"), "ENQ")
    assert {(r["CUSTOMER_ID"], r["folder"], r["INQ_PURP_CD"]) for r in stored.collect()} == {("C1", "007", "13"), ("C3", "day 2", "13"), ("C4", "day 2", "13")}
    bad = PB.stored_rows(spark, str(tmp_path / "tables"), PB.BAD_ROWS).collect()
    assert {(r["folder"], r["file_name"], r["line"]) for r in bad} == {("007", odd, "C2|13"), ("day 2", "enq_ragged.txt", "C5")}
    report = SF.header_report(SF.header_columns(SF.header_lines(inventory)), SC.EXPERIAN["ENQ"])
    assert {r["file_name"] for r in report.filter("not is_valid").collect()} == {"enq_twice.txt"}
    target, checkpoint = str(tmp_path / "streamed"), str(tmp_path / "checkpoint")
    incremental_ingest(spark, str(tmp_path / "in"), target, checkpoint, "ENQ", "experian", "batch_1", AS_OF).awaitTermination()
    streamed = PB.stored_rows(spark, target, "ENQ")
    assert sorted(map(str, streamed.collect())) == sorted(map(str, stored.select(*streamed.columns).collect()))
    assert PB.stored_rows(spark, target, PB.BAD_ROWS).count() == 2


def test_a_run_cut_short_is_run_again(spark, tmp_path, monkeypatch):
    _bureau(tmp_path)
    with monkeypatch.context() as broken:
        broken.setattr(LG, "ledger_rows", lambda *_: (_ for _ in ()).throw(RuntimeError("cut short")))
        with pytest.raises(RuntimeError):
            _load(spark, tmp_path)
    assert LG.read_ledger(spark, str(tmp_path / "ledger")).count() == 0
    _, results = _load(spark, tmp_path)
    assert results.count() == 3 and PB.stored_rows(spark, str(tmp_path / "tables"), "ENQ").count() == 3
    sent = spark.read.options(header=True, sep="|").csv(str(tmp_path / "lender" / "batch_1" / "enq"))
    assert sent.count() == 3


def test_partner_files_with_odd_names(spark, tmp_path):
    put(tmp_path / "up load" / "a+b [x] 100%.csv", "PId,phone,phone\nP1,911,912\n")
    rows = PF.scan_partner_csv(spark, SF.file_inventory(spark, str(tmp_path))).collect()
    assert [(r["PARTNER_REFERENCE_ID"], r["PHONE"], r["FILENAME"]) for r in rows] == [("P1", "911", "a+b [x] 100%.csv")]


def test_stream_equals_batch_and_repeats_nothing(spark, tmp_path):
    _bureau(tmp_path)
    source = tmp_path / "stream"
    target, checkpoint = str(tmp_path / "streamed"), str(tmp_path / "checkpoint")

    def run():
        incremental_ingest(spark, str(source), target, checkpoint, "ENQ", "experian", "batch_1", AS_OF).awaitTermination()
        return sorted(map(str, PB.stored_rows(spark, target, "ENQ").select("CUSTOMER_ID", "INQ_DATE", "AMOUNT", "file_name").collect()))

    for name in ("enq_1.txt", "enq_2.txt"):
        put(source / name, (tmp_path / "in" / "batch_1" / name).read_text())
        last = run()
    _load(spark, tmp_path)
    batch = spark.read.parquet(str(tmp_path / "tables" / "enq")).select("CUSTOMER_ID", "INQ_DATE", "AMOUNT", "file_name")
    assert last == run() == sorted(map(str, batch.collect()))


def test_overwrite_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    SK.overwrite_partitions(spark.createDataFrame([("a", "b1"), ("b", "b2")], "v string, batch_no string"), path)
    SK.overwrite_partitions(spark.createDataFrame([("c", "b2")], "v string, batch_no string"), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == ["a", "c"]
    assert SK.batch_slice(spark, path, "b1").count() == 1


def test_lender_export_keeps_shortlisted_rows_of_all_files(spark, tmp_path):
    for batch, people in (("b1", ("1", "2")), ("b2", ("3",))):
        put(tmp_path / batch / "score.txt", "CUSTOMER_ID|SCORE_V3\n" + "".join(f"PRFR{p}|{600 + 50 * int(p)}\n" for p in people))
        put(tmp_path / batch / "enq.txt", "CUSTOMER_ID|AMOUNT\n" + "".join(f"PRFR{p}|{p}\nPRFR{p}|{p}\n" for p in people))
    criteria = {"logic": "AND", "rules": [{"field": "score", "operator": ">=", "value": 700}], "version": "v0"}
    inventory = SF.file_inventory(spark, str(tmp_path))
    kept, record = PL.lender_export(spark, inventory, ["b1", "b2"], criteria, "prefr", "experian", "lb1", AS_OF, str(tmp_path / "out"))
    assert sorted(r["CUSTOMER_ID"] for r in kept["enq.txt"].collect()) == ["PRFR2", "PRFR2", "PRFR3", "PRFR3"]
    assert sorted(r["bureau_id"] for r in record.collect()) == ["2", "3"]
    odd = {"rules": [{"field": "score", "operator": "~", "value": 1}]}
    assert PL.lender_export(spark, inventory, ["b1", "b2"], odd, "prefr", "experian", "lb1", AS_OF) is None


def test_lender_export_plans_layouts_not_names(spark, tmp_path):
    for i in range(200):
        columns, row = (("CUSTOMER_ID|AMOUNT", "7"), ("CUSTOMER_ID|KIND|NOTE", "k|n"), ("NAME|CUSTOMER_ID", None))[i % 3]
        lines = [f"PRFR{p}|{row}" if row else f"n{p}|PRFR{p}" for p in (1, 2)]
        put(tmp_path / f"b{i % 2 + 1}" / f"file{i}.txt", "\n".join([columns, *lines]) + "\n")
    put(tmp_path / "b1" / "score.txt", "CUSTOMER_ID|SCORE_V3\nPRFR1|600\n")
    put(tmp_path / "b2" / "score.txt", "CUSTOMER_ID|SCORE_V3|FILE_NAME\nPRFR2|800|own\n")
    criteria = {"rules": [{"field": "score", "operator": ">=", "value": 700}]}
    out = str(tmp_path / "out")
    kept, record = PL.lender_export(spark, SF.file_inventory(spark, str(tmp_path)), ["b1", "b2"], criteria, "prefr", "experian", "lb", AS_OF, out)
    assert len(kept) == 201 and len(kept.frames) == 4
    assert [r["lender_uid"] for r in record.collect()] == ["PRFR2"]
    assert [tuple(r) for r in kept["score.txt"].collect()] == [("PRFR2", "800", "own")]
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in kept.frames]
    assert sum(p.count("Relation") for p in plans) <= 10  # scans of layouts and of the id list
    written = spark.read.options(header=True, sep="|").csv(f"{out}/prefr/lb/{kept.name}=file2.txt")
    assert [tuple(r) for r in written.collect()] == [("n2", "PRFR2")]
    assert len(list((tmp_path / "out/prefr/lb").glob(f"{kept.name}=*"))) == 201


def test_rules_go_to_the_table_that_has_the_field(spark):
    scores = spark.createDataFrame([("1", 700.0), ("2", 700.0), ("3", 500.0)], "id string, SCORE_V3 double")
    features = spark.createDataFrame([("1", 1, 5), ("2", 0, 5), ("4", 3, 0)], "key string, cards int, late int")
    sources = [R.source(scores, F.col("id"), {"score": "SCORE_V3"}), R.source(features, F.col("key"), {"dpd": "late"})]
    rule = lambda field, op, value: {"field": field, "operator": op, "value": value}
    pick = lambda logic, *rules: sorted(r["id"] for r in R.planned_ids(sources, {"logic": logic, "rules": rules}).collect())
    assert pick("AND", rule("score", ">=", 600), rule("Cards", ">=", 1), rule("dpd", "=", 5)) == ["1"]
    assert pick("OR", rule("score", ">=", 600), rule("cards", ">", 2)) == ["1", "2", "4"]
    assert pick("AND", rule("cards", ">=", 1)) == ["1", "4"]
    assert R.planned_ids(sources, {"rules": [rule("score", "~", 1)]}) is None and R.planned_ids(sources, {}) is None
    with pytest.raises(ValueError, match="income"):
        R.planned_ids(sources, {"rules": [rule("income", ">", 1)]})


@pytest.fixture
def mounted(spark, tmp_path):
    """The test's folder under an address that only Spark's readers know."""
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{tmp_path.name}.link./data", tmp_path.as_uri())
    return f"viewfs://{tmp_path.name}/data"


def test_files_in_a_store_that_only_spark_opens(spark, tmp_path, mounted):
    put(tmp_path / "bureau" / "b1" / "enq é+.txt", "CUSTOMER_ID|INQ_PURP_CD|INQ_DATE|M_SUB_ID|AMOUNT\nC1|13|01/01/2001|NBF|5\n")
    inventory = SF.file_inventory(spark, f"{mounted}/bureau")
    assert SF.scan_delimited(spark, inventory, SC.EXPERIAN["ENQ"])[0].count() == 1
    assert [r["is_valid"] for r in SF.header_report(SF.header_columns(SF.header_lines(inventory)), SC.EXPERIAN["ENQ"]).collect()] == [True]
    put(tmp_path / "partner" / "p.csv", "pid,phone\nP1,é\n", "utf-16")
    put(tmp_path / "partner" / "q.csv", "\ufeffPID,PHONE\nP2,1\n")
    rows = PF.scan_partner_csv(spark, SF.file_inventory(spark, f"{mounted}/partner"))
    assert sorted((r["PARTNER_REFERENCE_ID"], r["HASHED_PHONE"]) for r in rows.collect()) == [("P1", "é"), ("P2", "1")]
    put(tmp_path / "lender" / "b1" / "score.txt", "CUSTOMER_ID|SCORE_V3\nPRFR1|600\nPRFR2|800\n")
    criteria = {"rules": [{"field": "score", "operator": ">=", "value": 700}]}
    done = PL.lender_export(spark, SF.file_inventory(spark, f"{mounted}/lender"), ["b1"], criteria, "prefr", "experian", "lb", AS_OF)
    assert [r["lender_uid"] for r in done[1].collect()] == ["PRFR2"]


def test_of_a_large_file_only_the_head_is_read(spark, tmp_path):
    body = "x|y\n" * 5_000_000
    put(tmp_path / "b" / "large.txt", "A|B\n" + body)
    put(tmp_path / "b" / "small.txt", "C\r\n1\r\n")
    before = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file").getLong("bytesRead") or 0
    got = {r["path"].rsplit("/", 1)[1]: r["header"] for r in SF.header_lines(SF.file_inventory(spark, str(tmp_path))).collect()}
    read = (spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file").getLong("bytesRead") or 0) - before
    assert got == {"large.txt": "A|B", "small.txt": "C"}
    assert read < len(body) // 2


def _buckets(path):
    return {p.name: {f.name: f.stat().st_mtime_ns for f in p.glob("part-*")} for p in path.glob("batch_no=batch_1/bucket=*")}


def _enq_file(n):
    return HEADER + "".join(f"C{n}|13|01/01/2001|NBF|{i}\n" for i in range(5))


def _load_enq(spark, tmp_path, bucket_bytes, *names):
    inventory = SF.file_inventory(spark, str(tmp_path / "in"))
    files = inventory.filter(F.col("file_name").isin(*names)) if names else inventory
    return PB.load_table(spark, files, str(tmp_path / "tables"), "ENQ", "experian", "batch_1", AS_OF, bucket_bytes=bucket_bytes).collect()


def test_folders_follow_bytes_and_a_replaced_file_rewrites_its_bucket(spark, tmp_path):
    """60 files make few folders; a file that comes again, with other rows, without any, or with bad rows, touches one."""
    for n in range(60):
        put(tmp_path / "in" / "d" / f"enq_{n}.txt", _enq_file(n))
    room = 20 * len(_enq_file(10))
    results = _load_enq(spark, tmp_path, room)
    assert len(results) == 60 and {(r["original_count"], r["final_count"]) for r in results} == {(5, 5)}
    table, target = tmp_path / "tables" / "enq", str(tmp_path / "tables")
    before = _buckets(table)
    assert set(before) == {"bucket=0", "bucket=1", "bucket=2"}
    own = FM.file_map(spark, target, "ENQ", "batch_1").filter("file_name = 'enq_7.txt'").first()["bucket"]
    put(tmp_path / "in" / "d" / "enq_7.txt", HEADER + "NEW|13|01/01/2001|NBF|1\nshort\n")
    assert [(r["original_count"], r["bad_count"], r["final_count"]) for r in _load_enq(spark, tmp_path, room, "enq_7.txt")] == [(2, 1, 1)]
    after = _buckets(table)
    assert {b for b in before if before[b] != after[b]} == {f"bucket={own}"}
    rows = PB.stored_rows(spark, target, "ENQ")
    assert rows.count() == 59 * 5 + 1 and [r["CUSTOMER_ID"] for r in rows.filter("file_name = 'enq_7.txt'").collect()] == ["NEW"]
    assert [r["CUSTOMER_ID"] for r in FM.file_rows(spark, target, "ENQ", "batch_1", "d", "enq_7.txt").collect()] == ["NEW"]
    assert FM.file_rows(spark, target, "ENQ", "batch_1", "d", "none.txt").count() == 0
    assert PB.stored_rows(spark, target, PB.BAD_ROWS).count() == 1
    put(tmp_path / "in" / "d" / "enq_7.txt", HEADER)
    assert _load_enq(spark, tmp_path, room, "enq_7.txt")[0]["status"] == "Failed"
    assert PB.stored_rows(spark, target, "ENQ").count() == 59 * 5 and not list((tmp_path / "tables" / "bad_rows").rglob("part-*"))


def test_a_bucket_with_room_takes_the_next_files(spark, tmp_path):
    """Files that come one by one fill the last bucket first; a batch whose files hold no good row can be loaded."""
    put(tmp_path / "in" / "d" / "enq_0.txt", HEADER + "short\n")
    assert [(r["bad_count"], r["final_count"], r["status"]) for r in _load_enq(spark, tmp_path, 1000)] == [(1, 0, "Failed")]
    for n in range(1, 8):
        put(tmp_path / "in" / "d" / f"enq_{n}.txt", _enq_file(n))
        assert [r["final_count"] for r in _load_enq(spark, tmp_path, 1000, f"enq_{n}.txt")] == [5]
    entries = FM.file_map(spark, str(tmp_path / "tables"), "ENQ", "batch_1").collect()
    assert len(entries) == 8 and len({e["bucket"] for e in entries}) < 5
    assert PB.stored_rows(spark, str(tmp_path / "tables"), "ENQ").count() == 35
