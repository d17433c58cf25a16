import pytest
from pyspark.sql import functions as F

from deposit_analytics.functions.calendar import Calendar, months_back
from deposit_analytics.operators import balances as balance_ops

import helpers


def days(spark, calendar):
    return sorted(r.snapshot for r in calendar.days(spark).collect())


def test_number_of_days(spark):
    assert len(days(spark, Calendar("13960101", "13970301"))) == 428
    assert len(days(spark, Calendar("13910101", "13971229"))) == 2555
    assert days(spark, Calendar("13970101", "13970301", day="31")) == ["13970131", "13970231"]
    firsts = days(spark, Calendar("13960101", "13970301", day="01"))
    assert len(firsts) == 15 and firsts[0] == "13960101" and firsts[-1] == "13970301"


def test_day_31_exists_in_long_months_only(spark):
    found = days(spark, Calendar("13960101", "13961229", day="31"))
    assert [d[4:6] for d in found] == ["01", "02", "03", "04", "05", "06"]


def test_leap_years_are_optional(spark):
    plain, leap = Calendar("13951201", "13951231"), Calendar("13951201", "13951231", leap_years=(1395,))
    assert days(spark, plain)[-1] == plain.last_day() == "13951229"
    assert days(spark, leap)[-1] == leap.last_day() == "13951230"


@pytest.mark.parametrize(
    "calendar",
    [
        Calendar("13910101", "13971229"),
        Calendar("13920515", "13951203", day="01"),
        Calendar("13910101", "13971229", day="31"),
        Calendar("13940101", "13961231", leap_years=(1395,)),
        Calendar("13960131", "13960131"),
    ],
)
def test_membership_agrees_with_the_day_table(spark, calendar):
    every = [f"{n:08d}" for n in range(13901200, 13980200)]
    odd = [None, "", "1396", "1396010A", "139601 1", "139601011", "13960100", "13961301", "1396010", "x3960101"]
    texts = spark.createDataFrame([(t,) for t in every + odd], "snapshot string")
    kept = sorted(r.snapshot for r in texts.where(calendar.contains()).collect())
    assert kept == days(spark, calendar) == calendar.dates()


@pytest.mark.parametrize(
    "first, last, expected",
    [
        ("13960601", "13970231", "13970231"),
        ("13960601", "13960731", "13960730"),
        ("13960601", "13961231", "13961229"),
        ("13960601", "13991231", "13991229"),
    ],
)
def test_last_day(spark, first, last, expected):
    calendar = Calendar(first, last)
    assert calendar.last_day() == expected == days(spark, calendar)[-1]


def test_ranges_without_a_day(spark):
    for calendar in (Calendar("13961230", "13961231"), Calendar("13960201", "13960101")):
        assert days(spark, calendar) == calendar.dates() == []
        texts = spark.createDataFrame([("13961230",), ("13800101",)], "snapshot string")
        assert texts.where(calendar.contains()).count() == 0
        with pytest.raises(ValueError, match="no calendar day"):
            calendar.last_day()


def test_lookback_start(spark):
    cases = {
        "13970231": "13961131",
        "13960730": "13960430",
        "13970301": "13961201",
        "13970401": "13970101",
        "13961229": "13960929",
        "13970131": "13961031",
    }
    frame = spark.createDataFrame([(d,) for d in cases], "snapshot string")
    got = {r[0]: r[1] for r in frame.select("snapshot", months_back(F.col("snapshot"))).collect()}
    assert got == cases


@pytest.mark.parametrize("bad", [("1396", "13970101"), ("13961301", "13970101"), ("13960101", "13960132")])
def test_bad_bounds_are_refused(bad):
    with pytest.raises(ValueError):
        Calendar(*bad)


def test_years_are_those_of_the_range(spark):
    late = Calendar("13970101", "14021229")
    assert late.dates() == days(spark, late)
    assert len(late.dates()) == 6 * 365
    assert Calendar("14000101", "14001229").last_day() == "14001229"
    assert Calendar("13950101", "13971229", years=(1391, 1397)).dates()[-1] == "13971229"


@pytest.mark.parametrize("bad", [("13900101", "13960101"), ("13960101", "13980101")])
def test_a_range_beyond_the_stated_years_is_refused(bad):
    with pytest.raises(ValueError, match="years"):
        Calendar(*bad, years=(1391, 1397))


def test_bad_day_is_refused():
    with pytest.raises(ValueError):
        Calendar("13960101", "13970101", day="1")


def test_coverage_counts_rows_and_shows_empty_days(spark):
    held = helpers.balances(
        spark,
        [("a", "01", "1+", "13960101"), ("b", "01", "1+", "13960101"), ("a", "01", "1+", "13960103")]
        + [("a", "01", "1+", "13960231"), ("a", "01", "1+", "13960732")],
    )
    got = helpers.rows(balance_ops.calendar_coverage(held, Calendar("13960101", "13960104")), "snapshot", "n_rows")
    assert got == [("13960101", 2), ("13960102", 0), ("13960103", 1), ("13960104", 0)]
