"""Readers for the stored balance and customer tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deposit_analytics.constants import BALANCE_COLUMNS, CUSTOMER_COLUMNS


def _named(table: DataFrame, names: Mapping[str, str]) -> DataFrame:
    # Casting a string column to string is no cast at all, so filters on it
    # still reach the files.
    return table.select(*[F.col(stored).cast("string").alias(name) for stored, name in names.items()])


def read_balances(
    spark: SparkSession,
    path: str,
    first: str | Column | None = None,
    last: str | Column | None = None,
    names: Mapping[str, str] = BALANCE_COLUMNS,
    source: str = "parquet",
) -> DataFrame:
    """custno, acno, remaining, snapshot, all text.

    ``first`` and ``last`` bound the snapshot. Give them here when the files
    keep the snapshot as a number: the bounds are then compared with the stored
    type and still reach the files.
    """
    table = spark.read.format(source).load(path)
    stored = next(column for column, name in names.items() if name == "snapshot")
    kind = table.schema[stored].dataType
    if first is not None:
        table = table.where(F.col(stored) >= F.lit(first).cast(kind))
    if last is not None:
        table = table.where(F.col(stored) <= F.lit(last).cast(kind))
    return _named(table, names)


def read_customers(
    spark: SparkSession,
    path: str,
    names: Mapping[str, str] = CUSTOMER_COLUMNS,
    source: str = "parquet",
) -> DataFrame:
    """custno, cust_type, date_opened, all text."""
    return _named(spark.read.format(source).load(path), names)


def register_views(
    balances: DataFrame,
    customers: DataFrame,
    balances_name: str = "balances",
    customers_name: str = "customers",
) -> None:
    """Temp views for reports written as SQL text.

    Pass values with ``spark.sql(text, args={...})`` rather than splicing them
    in: a snapshot bound as text keeps its filter in the file scan.
    """
    balances.createOrReplaceTempView(balances_name)
    customers.createOrReplaceTempView(customers_name)
