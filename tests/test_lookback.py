import random

import pytest

from deposit_analytics.constants import LOOKBACK_CODES
from deposit_analytics.functions.calendar import Calendar
from deposit_analytics.plans import lookback

import helpers
from helpers import rows

CALENDAR = Calendar("13960601", "13970231")
FIRST, LAST = "13961131", "13970231"


def test_each_snapshot_in_the_window_counts(spark):
    held = [("a", "01x", "10+", d) for d in ("13961130", "13961131", "13970101", "13970231", "13970301")]
    got = lookback.lookback_balance(helpers.balances(spark, held), CALENDAR, money="bigint")
    assert rows(got) == [("a", 30, None, None)]


def test_precedence_without_brackets(spark):
    held = [
        (custno, code + "x", "1+", date)
        for custno, date in (("in", "13970101"), ("out", "13910101"))
        for code in ("01", "03", "02", "04", "08", "05")
    ]
    table = helpers.balances(spark, held)
    bracketed = lookback.lookback_balance(table, CALENDAR, money="bigint")
    assert rows(bracketed) == [("in", 2, 1, 2)]
    literal = lookback.lookback_balance(table, CALENDAR, strict_precedence=True, money="bigint")
    assert rows(literal) == [("in", 2, 1, 2), ("out", 1, None, 1)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("literal", [False, True])
def test_random_tables(spark, seed, literal):
    random.seed(seed)
    dates = ["13950101", "13961130", "13961131", "13961229", "13970231", "13970301"]
    held = [
        (f"c{random.randint(0, 9)}", f"{random.randint(1, 9):02d}", f"{random.randint(0, 99)}+", random.choice(dates))
        for _ in range(300)
    ]

    def counts(codes, code, date):
        inside = FIRST <= date <= LAST
        free = codes[:-1] if literal else ()
        return code in free or (code in codes and inside)

    want = []
    for custno in sorted({r[0] for r in held}):
        found = [
            [int(t[:-1]) for c, a, t, d in held if c == custno and counts(codes, a, d)]
            for codes in LOOKBACK_CODES.values()
        ]
        if any(found):
            want.append((custno, *[sum(f) if f else None for f in found]))
    table = helpers.balances(spark, held)
    got = lookback.lookback_balance(table, CALENDAR, strict_precedence=literal, money="bigint")
    assert rows(got) == sorted(want, key=repr)
    if not literal:
        for i, name in enumerate(LOOKBACK_CODES, start=1):
            one = lookback.lookback_group(table, CALENDAR, name, money="bigint")
            assert rows(one) == sorted(((w[0], w[i]) for w in want if w[i] is not None), key=repr)


def test_windows_of_the_snapshots_held(spark):
    held = helpers.balances(
        spark, [("a", "01", "1+", d) for d in ("13970231", "13970231", "13960730", "13960731", "13950101")]
    )
    got = lookback.lookback_window(held, CALENDAR)
    assert rows(got) == [("13960430", "13960730"), ("13961131", "13970231")]


def test_the_order_of_the_codes_must_be_known(spark):
    held = helpers.balances(spark, [("a", "01x", "1+", "13960601")])
    for codes in ({"01", "03"}, "01"):
        with pytest.raises(TypeError, match="order"):
            lookback.lookback_balance(held, Calendar("13960601", "13970231"), groups={"free": codes}, strict_precedence=True)


def test_rows_without_a_date_count_where_the_window_does_not_apply(spark):
    held = helpers.balances(spark, [("a", "01x", "5+", None), ("a", "03x", "7+", None), ("a", "03x", "2+", "13970101")])
    calendar = Calendar("13960601", "13970231")
    assert rows(lookback.lookback_balance(held, calendar, strict_precedence=True)) == [("a", 7, None, None)]
    assert rows(lookback.lookback_balance(held, calendar)) == [("a", 2, None, None)]
