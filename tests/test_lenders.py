"""Mappings, rules, quality checks and reports."""

import datetime as dt
import json

from pyspark.sql import functions as F

from leadforge.functions import codes
from leadforge.operators import mapping as M
from leadforge.operators import quality as Q
from leadforge.operators import reports as RP
from leadforge.operators import rules as R
from leadforge.operators.lender_views import lender_view

AS_OF = dt.date(2002, 1, 1)


def test_mapping_priorities(spark):
    df = spark.createDataFrame([("1", "x", dt.date(2001, 2, 3))], "customer_id string, a string, d date")
    config = {"columns": [
        {"source": "a", "target": "T", "transform": "TO_CHAR(d,'DD/MM/YYYY')", "default": "no"},
        {"source": "a", "target": "S", "default": "no"}, {"default": "yes", "target": "D"}, {"target": "N"}, {"source": "a"},
    ]}
    row = M.apply_mapping(df, config, id_prefix="ZZ").first()
    assert row.asDict() == {"T": "03/02/2001", "S": "x", "D": "yes", "N": None}
    assert M.apply_mapping(df, {}).columns == df.columns
    assert M.spark_transform("SHA2(pan)") == "sha2(pan, 256)"


def test_lender_views_prefix_and_blank(spark):
    df = spark.createDataFrame([("1", "9111111111")], "CUSTOMER_ID string, PHONE string")
    assert lender_view(df, "prefr", "experian", "PHONE").first().asDict() == {"CUSTOMER_ID": "PRFR1", "PHONE": "", "DATE_REPORTED": ""}
    eq = spark.createDataFrame([("7", "5")], "REFERENCE_NO string, TRAN_AMT string")
    row = lender_view(eq, "zype", "equifax", "ENQ").first().asDict()
    assert row["CUSTOMER_ID"] == "ZPEQ7" and row["TRAN_AMT"] == "5" and "SELF_TRADE" not in row


def test_offers_keep_leftovers_as_json(spark):
    df = spark.createDataFrame([("C1", "5", None, "x")], "customer_number string, roi string, gender string, extra string")
    row = M.map_offers(df, AS_OF).first()
    assert (row["LENDER_UID"], row["ROI"], row["TENURE"], row["LENDER_NAME"]) == ("C1", "5", None, "0")
    assert json.loads(row["LENDERS_ATTRIBUTE"]) == {"extra": "x"}


def _scores(spark):
    return spark.createDataFrame([("a", 700, 0), ("b", 650, 1), ("b", 650, 1), ("c", None, 1)], "id_no string, score int, nbr_cc int")


def _ids(df):
    return sorted(r["id"] for r in df.collect())


def test_rules_and_or_and_score_only(spark):
    criteria = {"logic": "AND", "rules": [{"field": "SCORE_V3", "operator": ">=", "value": 650}, {"field": "nbr_cc", "operator": "=", "value": 1}]}
    assert _ids(R.shortlist_ids(_scores(spark), criteria, "id_no")) == ["b"]
    assert _ids(R.shortlist_ids(_scores(spark), criteria, "id_no", score_only=True)) == ["a", "b"]
    assert _ids(R.shortlist_ids(_scores(spark), {**criteria, "logic": "OR"}, "id_no")) == ["a", "b", "c"]
    assert R.shortlist_ids(_scores(spark), {"rules": [{"field": "nbr_cc", "value": 1}]}, "id_no", score_only=True) is None
    for word, expected in ((">", ["a"]), ("<", []), ("<=", ["b"]), ("===", ["b"])):
        rule = {"rules": [{"field": "score", "operator": word, "value": 650}]}
        assert _ids(R.shortlist_ids(_scores(spark), rule, "id_no")) == expected


def test_unreadable_criteria_are_skipped(spark):
    good = json.dumps({"logic": "AND", "rules": [{"field": "score", "operator": ">=", "value": 650}], "version": "v0"})
    df = spark.createDataFrame([("x", "e", good), ("y", "e", "oops"), ("z", "e", None), ("w", "e", "")], "lender_name string, bureau_type string, eligible_criteria string")
    rows = R.criteria_rows(df).collect()
    assert [(r["lender_name"], r["field"], r["operator"], r["value"]) for r in rows] == [("x", "score", ">=", 650.0)]


def test_quality_reports(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "k string, v string")
    assert {r["column_name"]: (r["null_count"], r["is_valid"]) for r in Q.null_report(df, ["k", "v"]).collect()} == {"k": (0, True), "v": (1, False)}
    assert Q.threshold_report(df, F.col("v").isNull(), 0.5, "v").first()["is_valid"]
    assert not Q.threshold_report(df, F.col("v").isNull(), 0.4, "v").first()["is_valid"]
    assert Q.threshold_report(df.limit(0), F.col("v").isNull(), 0.0, "v").first()["is_valid"]


def test_load_report_folds_names(spark):
    rows = [("Fintech_enq.txt", "b", "Processed", 5, 4), ("enq_2.txt", "b", "Processed", 1, 1), ("odd.txt", "b", "Processed", 2, 2)]
    report = RP.load_report(spark.createDataFrame(rows, "file_name string, batch string, status string, original_count int, final_count int"))
    got = {r["file_name"]: (r["nnr_of_files"], r["duplicates_and_nulls"]) for r in report.collect()}
    assert got == {"ENQ": (2, 1), "odd.txt": (1, 0)}


def test_codes_decode(spark):
    df = spark.createDataFrame([("5",), ("02",), ("zz",)], "c string")
    typed = codes.decode(df, "c", codes.account_types(spark), "t_")
    both = codes.decode(typed, "c", codes.labels(spark, codes.WRITTEN_OFF_CODES), "w_")
    got = {r["c"]: (r["t_account_class"], r["t_is_card"], r["w_description"], r["w_is_decline"]) for r in both.collect()}
    assert got == {"5": ("revolving", True, None, None), "02": (None, None, "Written-off", True), "zz": (None,) * 4}
    assert codes.missing_columns(df, codes.REQUIRED_ENQUIRIES) == codes.REQUIRED_ENQUIRIES
    assert "BCC_DATE" in codes.rename_attributes(df.withColumnRenamed("c", "CREATED_AT")).columns
