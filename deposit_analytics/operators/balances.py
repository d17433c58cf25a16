"""Aggregations over account balances.

All of them group by ``snapshot`` as well, so one run covers every date. The
sums combine on the map side, so a customer or a date that holds a large part
of the rows reaches its reducer as at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deposit_analytics.constants import MONEY
from deposit_analytics.functions import columns
from deposit_analytics.functions.calendar import Calendar


def account_projection(balances: DataFrame, money: str = MONEY, sign: str = "ignore") -> DataFrame:
    """custno, acno, product, amount, snapshot of every account row."""
    columns.require_exact(balances.sparkSession)
    return balances.select(
        "custno",
        "acno",
        columns.product_code(F.col("acno")).alias("product"),
        columns.amount(F.col("remaining"), money, sign).alias("amount"),
        "snapshot",
    )


def group_balance(accounts: DataFrame, codes: Iterable[str], money: str = MONEY) -> DataFrame:
    """Balance of one product group per customer and snapshot."""
    return (
        accounts.where(columns.in_group(F.col("product"), codes))
        .groupBy("custno", "snapshot")
        .agg(F.sum("amount").cast(money).alias("balance"))
    )


def group_balances(accounts: DataFrame, groups: Mapping[str, Iterable[str]], money: str = MONEY) -> DataFrame:
    """All product groups side by side, plus ``total`` over every product.

    One scan and one shuffle, however many groups there are. A customer without
    accounts in a group gets NULL there.
    """
    value, product = F.col("amount"), F.col("product")
    sums = [
        columns.sum_where(value, columns.in_group(product, codes)).cast(money).alias(name)
        for name, codes in groups.items()
    ]
    return accounts.groupBy("custno", "snapshot").agg(F.sum(value).cast(money).alias("total"), *sums)


def total_balance(accounts: DataFrame, money: str = MONEY) -> DataFrame:
    """Total per customer and snapshot over every product."""
    return accounts.groupBy("custno", "snapshot").agg(F.sum("amount").cast(money).alias("total"))


def product_balance(accounts: DataFrame, money: str = MONEY) -> DataFrame:
    """Balance per customer, snapshot and product."""
    return accounts.groupBy("custno", "snapshot", "product").agg(
        F.sum("amount").cast(money).alias("balance")
    )


def scan_profile(balances: DataFrame) -> DataFrame:
    """n_rows, n_customers, n_unreadable, min_snapshot, max_snapshot of a balance table.

    ``n_unreadable`` counts the amounts that sums skip. Snapshots are compared as numbers: text minima would make Spark sort the
    table, numbers stay in a hash aggregation.
    """
    day = F.col("snapshot").try_cast("int")
    return balances.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("custno").alias("n_customers"),
        F.count_if(~columns.readable(F.col("remaining"))).alias("n_unreadable"),
        F.lpad(F.min(day).cast("string"), 8, "0").alias("min_snapshot"),
        F.lpad(F.max(day).cast("string"), 8, "0").alias("max_snapshot"),
    )


def calendar_coverage(balances: DataFrame, calendar: Calendar) -> DataFrame:
    """The calendar with n_rows, the balance rows each of its days holds.

    Days without a snapshot show 0. The counts are one row per day when they
    meet the calendar, so the join is small on both sides.
    """
    held = (
        balances.where(calendar.contains())
        .groupBy("snapshot")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return (
        calendar.days(balances.sparkSession)
        .join(held, "snapshot", "left")
        .withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    )
