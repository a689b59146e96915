"""Traps of dates, amounts, phones, e-mails and identity rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadforge.functions import dates as D
from leadforge.functions import status as ST
from leadforge.functions import text as X
from leadforge.operators import cleaning as C
from leadforge.operators import identity as I
from leadforge.operators import reports as R

AS_OF = dt.date(2002, 1, 1)


def one(spark, value, rule, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(rule(F.col("v")).alias("v")).first()["v"]


@pytest.mark.parametrize("text, expected", [
    ("03/04/2024", dt.date(2024, 4, 3)), ("12/25/2001", dt.date(2001, 12, 25)), ("2000.01.09", dt.date(2000, 1, 9)),
    ("99/99/2001", None), ("1/2/2024", None), ("01/02/24", None), ("", None), (None, None),
])
def test_bureau_dates(spark, text, expected):
    assert one(spark, text, D.parse_date) == expected


def test_lenient_dates_take_one_digit(spark):
    assert one(spark, "1/2/2024", lambda c: D.parse_date(c, lenient=True)) == dt.date(2024, 2, 1)


@pytest.mark.parametrize("text, expected", [
    (" 05-Nov-2000 ", dt.date(2000, 11, 5)), ("05/NOV/2000", dt.date(2000, 11, 5)), ("01-02-24", dt.date(2024, 2, 1)),
    ("01-02-85", dt.date(1985, 2, 1)), ("2001-07-04", dt.date(2001, 7, 4)),
])
def test_offer_dates(spark, text, expected):
    assert one(spark, text, D.parse_offer_date) == expected


@pytest.mark.parametrize("text, expected", [
    ("Rs 1,234.50", "1234.50"), ("12.345", "12.35"), ("99999999999", None), ("abc", None), ("-17", "-17.00"), ("1.2.3", None),
])
def test_amounts(spark, text, expected):
    value = one(spark, text, X.parse_amount)
    assert (None if value is None else str(value)) == expected


def test_month_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1)), (dt.date(2024, 2, 1), dt.date(2024, 1, 31))], "a date, b date")
    assert [r[0] for r in df.select(D.month_diff(F.col("a"), F.col("b"))).collect()] == [1, -1]


def test_short_phone_stays_whole_and_landline_is_blanked(spark):
    assert one(spark, "12345", X.phone_last10) == "12345"
    assert one(spark, "+910123456789", X.mobile_candidate) == ""
    assert one(spark, "+919123456789", X.mobile_candidate) == "9123456789"


@pytest.mark.parametrize("text, expected", [
    ('A.B@Gmail.con', "a.b@gmail.com"), ('"x y"@mail.org;,', "xy@mail.org"), ("q\\@gmail.co", "q@gmail.com"), ("a@gmail.co.in", "a@gmail.co.in"),
])
def test_emails(spark, text, expected):
    assert one(spark, text, X.clean_email) == expected


def test_masks(spark):
    assert one(spark, "9876543210", X.mask_phone) == "9XXXXX3210"
    assert one(spark, "ABCPX1234Z", X.mask_pan) == "XXXXX1234Z"
    assert one(spark, "ABCCX1234Z", X.personal_pan) is None


def test_null_score_is_declined(spark):
    assert one(spark, None, ST.score_status, "double") == "Declined"


def test_repeated_headers_and_null_dates_drop(spark):
    df = spark.createDataFrame([("BALANCE_DT",), ("balance_dt",), (None,), ("01/01/2001",)], "BALANCE_DT string")
    assert [r[0] for r in C.drop_repeated_headers(df).collect()] == ["01/01/2001"]
    assert C.drop_repeated_headers(df, keep_null=True).count() == 2


def test_columns_are_chosen_by_name(spark):
    df = spark.createDataFrame([("01/02/2001", "5.5", "7", "1,000")], "OPEN_DT string, BALANCE_AM_01 string, BALANCE_AM string, AMOUNT string")
    row = C.parse_columns(df).first()
    assert row["OPEN_DT"] == dt.date(2001, 2, 1) and row["BALANCE_AM"] == "7" and str(row["AMOUNT"]) == "1000.00"


def test_names_are_cleaned():
    assert [C.clean_name(n) for n in (" Customer  Id", "INQ-PURP CD", "'AMOUNT'", "SECTOR/x y")] == ["Customer_Id", "INQ_PURP_CD", "AMOUNT", "SECTOR"]


def test_routing_takes_the_first_name_unless_whole_words(spark):
    df = spark.createDataFrame([("march_score.txt",), ("NAME_DOB.txt",), ("unknown.bin",)], "f string")
    assert [r[0] for r in df.select(R.route(F.col("f"), R.EXPERIAN_TABLES)).collect()] == ["AR", "NAME_DOB", None]
    assert [r[0] for r in df.select(R.route(F.col("f"), R.EXPERIAN_TABLES, whole_words=True)).collect()] == ["SCORE", "NAME_DOB", None]


def test_reference_needs_a_phone_column(spark):
    with pytest.raises(ValueError):
        C.rename_reference(spark.createDataFrame([("x",)], "MEMBER_REFERENCE string"))


def test_newest_contact_filters_before_ranking_and_breaks_ties(spark):
    rows = [("c", "9111111111", dt.date(2001, 1, 1)), ("c", "9222222222", dt.date(2001, 1, 1)), ("c", "0333333333", dt.date(2001, 9, 9)),
            ("c", "12", dt.date(2001, 9, 10)), ("d", "9444444444", None)]
    df = spark.createDataFrame(rows, "customer_id string, phone string, date_reported date")
    got = {r["customer_id"]: r for r in I.phone_summary(df).collect()}
    assert got["c"]["latest_mobile"] == "9222222222"
    assert got["c"]["mobile_list"] == "9111111111|2001-01-01,9222222222|2001-01-01,0333333333|2001-09-09,12|2001-09-10"
    assert got["d"]["mobile_list"] == "" and got["d"]["latest_mobile"] == "9444444444"


def test_birth_dates_outside_a_lifetime_are_dropped(spark):
    df = spark.createDataFrame([(dt.date(1902, 5, 1), AS_OF), (dt.date(1903, 5, 1), AS_OF), (dt.date(2002, 1, 1), AS_OF), (None, AS_OF)], "d date, c date")
    assert [r[0] for r in df.select(D.plausible_dob(F.col("d"), F.col("c"), AS_OF)).collect()] == [None, dt.date(1903, 5, 1), None, None]
