"""Wealth reports: balances by product group of customers above a threshold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deposit_analytics.constants import (
    EXCLUDED_TYPE,
    GROUP_JOB_CODES,
    GROUP_THRESHOLD,
    MONEY,
    PIVOT_JOB_CODES,
    PIVOT_THRESHOLD,
)
from deposit_analytics.functions import columns
from deposit_analytics.functions import tenure as tenures
from deposit_analytics.functions.calendar import Calendar
from deposit_analytics.operators import balances as balance_ops
from deposit_analytics.operators import customers as customer_ops

EXPORT_COLUMNS = ("custno", "interest_free", "short_term", "term", "tenure_days", "snapshot")


def _accounts(balances: DataFrame, calendar: Calendar | None, money: str, sign: str) -> DataFrame:
    # Rows without a date are in no report; the test is pushed to the files.
    balances = balances.where(F.col("snapshot").isNotNull())
    if calendar is not None:
        balances = balances.where(calendar.contains())
    return balance_ops.account_projection(balances, money, sign)


def customer_total(
    balances: DataFrame,
    customers: DataFrame,
    calendar: Calendar | None = None,
    *,
    excluded_type: str = EXCLUDED_TYPE,
    dedupe_customers: bool = False,
    money: str = MONEY,
    sign: str = "ignore",
) -> DataFrame:
    """custno, snapshot, date_opened, total."""
    totals = balance_ops.total_balance(_accounts(balances, calendar, money, sign), money)
    opened = customer_ops.openings(customers, excluded_type, dedupe_customers)
    return customer_ops.totals_per_opening(totals, opened, money).select(
        "custno", "snapshot", "date_opened", "total"
    )


def high_value_by_product(
    balances: DataFrame,
    customers: DataFrame,
    calendar: Calendar | None = None,
    *,
    threshold=PIVOT_THRESHOLD,
    inclusive: bool = False,
    tenure: customer_ops.Tenure = tenures.as_of_snapshot,
    excluded_type: str = EXCLUDED_TYPE,
    dedupe_customers: bool = False,
    money: str = MONEY,
    sign: str = "ignore",
) -> DataFrame:
    """custno, snapshot, product, balance, tenure_days of qualifying customers."""
    accounts = _accounts(balances, calendar, money, sign)
    by_product = balance_ops.product_balance(accounts, money)
    # A frame of one customer and snapshot holds one row per product code.
    per_customer = by_product.withColumn(
        "total",
        F.sum("balance").over(Window.partitionBy("custno", "snapshot")).cast(money),
    )
    opened = customer_ops.openings(customers, excluded_type, dedupe_customers)
    rows = customer_ops.qualified(
        per_customer, opened, tenure, threshold, inclusive, dedupe_customers
    )
    return rows.groupBy("custno", "snapshot", "product").agg(
        F.sum("balance").cast(money).alias("balance"),
        F.max("tenure_days").alias("tenure_days"),
    )


def high_value_customers(
    balances: DataFrame,
    customers: DataFrame,
    calendar: Calendar | None = None,
    *,
    threshold=PIVOT_THRESHOLD,
    inclusive: bool = False,
    excluded_type: str = EXCLUDED_TYPE,
    dedupe_customers: bool = False,
    money: str = MONEY,
    sign: str = "ignore",
) -> DataFrame:
    """Distinct custno, snapshot above the threshold."""
    totals = balance_ops.total_balance(_accounts(balances, calendar, money, sign), money)
    opened = customer_ops.openings(customers, excluded_type, dedupe_customers)
    rows = customer_ops.qualified(
        totals, opened, tenures.as_of_snapshot, threshold, inclusive, dedupe_customers
    )
    return rows.select("custno", "snapshot").distinct()


def wealth_pivot(
    balances: DataFrame,
    customers: DataFrame,
    calendar: Calendar | None = None,
    *,
    groups: Mapping[str, Iterable[str]] = PIVOT_JOB_CODES,
    threshold=PIVOT_THRESHOLD,
    inclusive: bool = False,
    tenure: customer_ops.Tenure = tenures.as_of_snapshot,
    excluded_type: str = EXCLUDED_TYPE,
    dedupe_customers: bool = False,
    money: str = MONEY,
    sign: str = "ignore",
) -> DataFrame:
    """custno, snapshot, one column per product group, tenure_days.

    The threshold applies to the total over *all* products, so a customer may
    have NULL in any group. Without ``dedupe_customers`` a customer with two
    qualifying opening dates has its balances counted twice, as a join with the
    customer table gives.
    """
    accounts = _accounts(balances, calendar, money, sign)
    sums = balance_ops.group_balances(accounts, groups, money)
    opened = customer_ops.openings(customers, excluded_type, dedupe_customers)
    rows = customer_ops.qualified(sums, opened, tenure, threshold, inclusive, dedupe_customers)
    return rows.groupBy("custno", "snapshot").agg(
        *[F.sum(name).cast(money).alias(name) for name in groups],
        F.max("tenure_days").alias("tenure_days"),
    )


def wealth_by_group(
    balances: DataFrame,
    customers: DataFrame,
    as_of: dt.date,
    calendar: Calendar | None = None,
    *,
    groups: Mapping[str, Iterable[str]] = GROUP_JOB_CODES,
    threshold=GROUP_THRESHOLD,
    inclusive: bool = True,
    tenure: customer_ops.Tenure | None = None,
    dedupe_customers: bool = False,
    money: str = MONEY,
    sign: str = "ignore",
) -> DataFrame:
    """custno, snapshot, one column per product group, tenure_days.

    The tenure is counted to ``as_of`` unless ``tenure`` says otherwise. A
    customer must hold all groups on that snapshot, and their sum must reach
    the threshold; both are decided before the join. Every customer type
    counts, and each customer row gives a row unless ``dedupe_customers``.
    """
    if tenure is None:

        def tenure(_, opened):
            return tenures.as_of_date(as_of, opened)

    accounts = _accounts(balances, calendar, money, sign)
    sums = _all_groups(balance_ops.group_balances(accounts, groups, money), groups, threshold, inclusive)
    if dedupe_customers:
        latest = customer_ops.latest_opening(F.col("date_opened"))
        people = customers.groupBy("custno").agg(latest.alias("date_opened"))
    else:
        people = customers.select("custno", "date_opened")
    return sums.join(people, "custno").select(
        "custno",
        "snapshot",
        *groups,
        tenure(F.col("snapshot"), F.col("date_opened")).alias("tenure_days"),
    )


def _group_sum(groups: Iterable[str]):
    # NULL as soon as one group is missing.
    first, *others = [F.col(name) for name in groups]
    for other in others:
        first = first + other
    return first


def _all_groups(sums: DataFrame, groups: Iterable[str], threshold, inclusive: bool) -> DataFrame:
    return sums.where(columns.reaches(_group_sum(groups), threshold, inclusive))


def step_counts(
    balances: DataFrame,
    customers: DataFrame,
    calendar: Calendar | None = None,
    *,
    groups: Mapping[str, Iterable[str]] = GROUP_JOB_CODES,
    threshold=GROUP_THRESHOLD,
    inclusive: bool = True,
    money: str = MONEY,
    sign: str = "ignore",
) -> DataFrame:
    """Row count of every step of ``wealth_by_group``: snapshot, step, n.

    Steps are the product groups, ``tenure`` (customer rows) and ``result``.
    All counts of all dates come from one scan of the balances. With a calendar
    every one of its dates is reported, those without balances with zeros;
    without one, the dates that the balances hold.
    """
    accounts = _accounts(balances, calendar, money, sign)
    value, product = F.col("amount"), F.col("product")
    members = {name: columns.in_group(product, codes) for name, codes in groups.items()}
    per_customer = accounts.groupBy("custno", "snapshot").agg(
        *[columns.sum_where(value, member).cast(money).alias(name) for name, member in members.items()],
        *[F.max(F.when(member, 1)).alias(f"has_{name}") for name, member in members.items()],
    )
    copies = customers.groupBy("custno").agg(F.count(F.lit(1)).alias("copies"))
    wealthy = columns.reaches(_group_sum(groups), threshold, inclusive)
    # Only wealthy customers keep their number: the others of a date collapse
    # into one row before anything is shuffled for the join.
    collapsed = (
        per_customer.withColumn("custno", F.when(wealthy, F.col("custno")))
        .groupBy("snapshot", "custno")
        .agg(*[F.count(f"has_{name}").alias(name) for name in groups])
    )
    counts = (
        collapsed.join(copies, "custno", "left")
        .groupBy("snapshot")
        .agg(
            *[F.sum(name).alias(name) for name in groups],
            F.coalesce(F.sum("copies"), F.lit(0)).alias("result"),
        )
    )
    if calendar is not None:
        # One row per date on either side.
        counts = calendar.days(balances.sparkSession).select("snapshot").join(counts, "snapshot", "left")
        counts = counts.fillna(0, [*groups, "result"])
    # Counting rows reads no column; the copies joined above leave out rows
    # without a number, so their sum would need a scan of its own.
    counts = counts.withColumn("tenure", customers.agg(F.count(F.lit(1))).scalar())
    steps = [*groups, "tenure", "result"]
    return counts.unpivot("snapshot", steps, "step", "n")


def export_strings(result: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Result columns as text, cast from the exact types, in export order.

    ``names`` renames columns on the way out.
    """
    names = names or {}
    return result.select(
        *[F.col(name).cast("string").alias(names.get(name, name)) for name in EXPORT_COLUMNS]
    )
