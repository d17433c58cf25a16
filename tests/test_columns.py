import datetime as dt
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from deposit_analytics.functions import columns, tenure
from deposit_analytics.operators import balances as balance_ops

from helpers import point, truncated
from helpers import tenure as book_tenure


def test_amount_drops_the_marker_and_keeps_every_digit(spark):
    cases = {
        "500+": Decimal("500.00"),
        "600-": Decimal("600.00"),
        "12.25+": Decimal("12.25"),
        "9999999999.5+": Decimal("9999999999.50"),
        "123456789012345678901234567890+": Decimal("123456789012345678901234567890.00"),
        "+": None,
        "": None,
        "abc+": None,
        None: None,
    }
    frame = spark.createDataFrame([(k,) for k in cases], "text string")
    got = {r.text: r.a for r in frame.select("text", columns.amount(F.col("text")).alias("a")).collect()}
    assert got == cases


def test_amount_reads_a_trailing_sign_when_asked(spark):
    frame = spark.createDataFrame([("500+",), ("600-",), ("-",)], "text string")
    got = [r[0] for r in frame.select(columns.amount(F.col("text"), "bigint", "trailing")).collect()]
    assert got == [500, -600, None]
    with pytest.raises(ValueError):
        columns.amount(F.col("text"), sign="leading")


def test_product_code_keeps_the_leading_zero(spark):
    frame = spark.createDataFrame([("0112345678",), ("08",), ("4",)], "acno string")
    assert [r[0] for r in frame.select(columns.product_code(F.col("acno"))).collect()] == ["01", "08", "4"]


def test_fractional_totals_and_the_two_thresholds(spark):
    frame = spark.createDataFrame([(Decimal("9999999999.5"),)], "total decimal(38,2)")
    total = F.col("total")
    kept = frame.where(columns.reaches(total, 9999999999, inclusive=False)).count()
    dropped = frame.where(columns.reaches(total, 10000000000, inclusive=True)).count()
    assert (kept, dropped) == (1, 0)


def test_tenure_by_hand(spark):
    frame = spark.createDataFrame([("13970131", "950115")], "snapshot string, opened string")
    got = frame.select(
        tenure.as_of_snapshot(F.col("snapshot"), F.col("opened")),
        tenure.as_of_date(dt.date(2018, 4, 21), F.col("opened")),
        tenure.compat_v2(F.col("snapshot"), F.col("opened")),
        tenure.compat_v3(F.col("snapshot"), F.col("opened")),
    ).first()
    # v3: 2 years, and month 97 against month 01.
    assert tuple(got) == (746, 746, None, (36500 * 2 + 3042 * 96) // 100)


def test_tenure_against_exact_fractions(spark):
    random.seed(7)
    day = "{:02d}{:02d}".format
    pairs = [
        (
            f"{random.randint(1391, 1397)}{day(random.randint(1, 12), random.randint(1, 31))}",
            f"{random.randint(50, 99):02d}{day(random.randint(1, 12), random.randint(1, 31))}",
        )
        for _ in range(3000)
    ]
    as_of = dt.date(2016, 2, 29)
    today = point("2016", "2", "29") - Fraction("226746.26")

    def opened_at(opened):
        return point("13" + opened[:2], opened[2:4], opened[4:])

    frame = spark.createDataFrame(pairs, "snapshot string, opened string")
    snapshot, opened = F.col("snapshot"), F.col("opened")
    for row in frame.select(
        "*",
        tenure.as_of_snapshot(snapshot, opened).alias("s"),
        tenure.as_of_date(as_of, opened).alias("d"),
        tenure.compat_v3(snapshot, opened).alias("v3"),
    ).collect():
        assert row.s == book_tenure(row.snapshot, row.opened)
        assert row.d == truncated(today - opened_at(row.opened))
        v3 = point(row.snapshot[:4], row.snapshot[2:4], row.opened[4:]) - opened_at(row.opened)
        assert row.v3 == truncated(v3)


def test_tenure_of_unusable_dates_is_null(spark):
    frame = spark.createDataFrame([(None,), ("",), ("95",), ("95xx15",)], "opened string")
    got = frame.select(
        tenure.as_of_snapshot(F.lit("13970131"), F.col("opened")),
        tenure.as_of_date(dt.date(2018, 4, 21), F.col("opened")),
        tenure.compat_v3(F.lit("13970131"), F.col("opened")),
    ).collect()
    assert all(tuple(row) == (None, None, None) for row in got)


def test_century_is_a_parameter(spark):
    frame = spark.createDataFrame([("010101",)], "opened string")
    got = frame.select(tenure.as_of_snapshot(F.lit("14020101"), F.col("opened"), century="14")).first()[0]
    assert got == 365


@pytest.mark.parametrize("text, money", [("10000000000.50+", "bigint"), ("9" * 40 + "+", "decimal(38,2)"), ("9223372036854775808-", "bigint")])
def test_a_number_that_does_not_fit_is_an_error(spark, text, money):
    frame = spark.createDataFrame([("1+",), (text,)], "remaining string")
    with pytest.raises(Exception, match="does not fit"):
        frame.select(columns.amount(F.col("remaining"), money)).collect()


def test_text_that_is_no_number_is_null(spark):
    frame = spark.createDataFrame([("x+",), ("+",), ("NaN+",), (None,), ("",), ("--1+",), (" 7 +",)], "remaining string")
    for money in ("bigint", "decimal(38,2)"):
        got = [r[0] for r in frame.select(columns.amount(F.col("remaining"), money)).collect()]
        assert got[:6] == [None] * 6
        assert got[6] == 7


def test_money_jobs_refuse_a_session_that_wraps(spark):
    frame = spark.createDataFrame([("a", "01x", "1+", "13960101")], "custno string, acno string, remaining string, snapshot string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            balance_ops.account_projection(frame)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_unreadable_amounts_are_counted(spark):
    rows = [("a", "01x", text, "13960101") for text in ("1+", "x+", "+", None, "2.5-", "", "1e3+")]
    frame = spark.createDataFrame(rows, "custno string, acno string, remaining string, snapshot string")
    assert balance_ops.scan_profile(frame).first().n_unreadable == 4


def test_two_centuries(spark):
    frame = spark.createDataFrame([("990101",), ("000101",), ("490101",), ("500101",), (None,), ("x",)], "opened string")
    days = tenure.as_of_snapshot(F.lit("14050101"), F.col("opened"), cut_year=50)
    got = [r[0] for r in frame.select(days).collect()]
    assert got == [6 * 365, 5 * 365, -44 * 365, 55 * 365, None, None]
