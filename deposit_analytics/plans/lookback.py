"""Balance sums over the months before a snapshot date."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deposit_analytics.constants import LOOKBACK_CODES, LOOKBACK_MONTHS, MONEY
from deposit_analytics.functions import columns
from deposit_analytics.functions.calendar import Calendar, months_back
from deposit_analytics.operators import balances as balance_ops


def window_bounds(calendar: Calendar, months: int = LOOKBACK_MONTHS) -> tuple[Column, Column]:
    """First and last snapshot of the window that ends on the calendar's last day.

    Both are literals once optimized, so a filter on them reaches the files.
    """
    last = F.lit(calendar.last_day())
    return months_back(last, months), last


def lookback_window(balances: DataFrame, calendar: Calendar, months: int = LOOKBACK_MONTHS) -> DataFrame:
    """from_h, to_h for each calendar day the balance table holds."""
    return (
        balances.where(calendar.contains())
        .select("snapshot")
        .distinct()
        .select(months_back(F.col("snapshot"), months).alias("from_h"), F.col("snapshot").alias("to_h"))
    )


def _literal_member(product: Column, codes: Sequence[str], inside: Column) -> Column:
    if isinstance(codes, str) or not isinstance(codes, Sequence):
        raise TypeError("the order of the codes matters here: give a list or a tuple")
    *free, limited = codes
    bounded = (product == limited) & inside
    return columns.in_group(product, free) | bounded if free else bounded


def lookback_balance(
    balances: DataFrame,
    calendar: Calendar,
    *,
    months: int = LOOKBACK_MONTHS,
    groups: Mapping[str, Iterable[str]] = LOOKBACK_CODES,
    strict_precedence: bool = False,
    money: str = MONEY,
    sign: str = "ignore",
) -> DataFrame:
    """custno and one balance sum per product group over the lookback window.

    The window ends on the last day of ``calendar`` and starts ``months``
    earlier. A customer with several snapshots in it has each of them counted
    (balance-days, not an average). Customers without a row in any group are
    absent.

    ``strict_precedence`` applies the window to the last code of each group
    only, which is what ``a OR b AND window`` means when written without
    brackets; the other codes then count on every date.
    """
    accounts = balance_ops.account_projection(balances, money, sign)
    product = F.col("product")
    inside = F.col("snapshot").between(*window_bounds(calendar, months))
    if strict_precedence:
        members = {name: _literal_member(product, codes, inside) for name, codes in groups.items()}
    else:
        accounts = accounts.where(inside)
        members = {name: columns.in_group(product, codes) for name, codes in groups.items()}
    used = accounts.where(reduce(lambda a, b: a | b, members.values()))
    return used.groupBy("custno").agg(
        *[
            columns.sum_where(F.col("amount"), member).cast(money).alias(name)
            for name, member in members.items()
        ]
    )


def lookback_group(balances: DataFrame, calendar: Calendar, name: str, **options) -> DataFrame:
    """custno, balance of one product group over the lookback window."""
    codes = options.pop("groups", LOOKBACK_CODES)[name]
    return lookback_balance(balances, calendar, groups={"balance": codes}, **options)
