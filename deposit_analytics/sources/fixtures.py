"""Balance and customer tables derived from the TPC-H-like test tables.

The mapping is fixed in FIXTURES.md; every row of the test tables is used.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: years between the order dates and the calendar of the reports.
YEAR_SHIFT = 604

GRAINS = ("day", "month", "year")

# The columns used, with their stored types. Stating them spares
# each query a job that reads file footers.
CUSTOMER_SCHEMA = "c_custkey bigint, c_nationkey int, c_mktsegment string"
ORDERS_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"
LINEITEM_SCHEMA = "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string"


def customers(spark: SparkSession, sf_dir: str, first_year: int = 80) -> DataFrame:
    """custno, cust_type, date_opened from ``customer``.

    Opening years run over 17 years from ``first_year``, with two digits.
    """
    key = F.col("c_custkey")
    year, month, day = (first_year + key % 17) % 100, key % 12 + 1, key % 28 + 1
    return spark.read.schema(CUSTOMER_SCHEMA).parquet(f"{sf_dir}/customer.parquet").select(
        key.cast("string").alias("custno"),
        F.when(F.col("c_nationkey") == 0, None)
        .when(F.col("c_mktsegment") == "MACHINERY", "02")
        .otherwise("01")
        .alias("cust_type"),
        F.lpad((year * 10000 + month * 100 + day).cast("string"), 6, "0").alias("date_opened"),
    )


def repeated_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers, and for three tenths of them a second row.

    A tenth has a second opening date (a year later), a tenth an exact copy and
    a tenth a row of the type that the pivot leaves out.
    """
    once = customers(spark, sf_dir)
    tenth = F.col("custno").cast("bigint") % 10
    later = F.concat(
        F.lpad((F.substring("date_opened", 1, 2).cast("int") + 1).cast("string"), 2, "0"),
        F.substring("date_opened", 3, 4),
    )
    again = once.where(tenth.isin(0, 1, 2)).select(
        "custno",
        F.when(tenth == 2, "02").otherwise(F.col("cust_type")).alias("cust_type"),
        F.when(tenth == 0, later).otherwise(F.col("date_opened")).alias("date_opened"),
    )
    return once.unionByName(again)


def _month_start(text: str, shift: int, months: int = 0) -> dt.date:
    index = int(text[:4]) * 12 + int(text[4:6]) - 1 + months
    return dt.date(index // 12 + shift, index % 12 + 1, 1)


def balances(
    spark: SparkSession,
    sf_dir: str,
    grain: str = "day",
    first: str | None = None,
    last: str | None = None,
    *,
    shift: int = YEAR_SHIFT,
    cents: bool = False,
    null_dates: bool = False,
) -> DataFrame:
    """custno, acno, remaining, snapshot from ``lineitem`` and ``orders``.

    ``shift`` years lie between the order dates and the snapshots. ``cents``
    writes amounts with two decimals instead of as whole cents. ``null_dates``
    takes the snapshot from every tenth order.

    ``first`` and ``last`` are the snapshot bounds a report is going to apply.
    The snapshot is computed from the order date, which hides those bounds from
    the scan, so whole months around them are stated on the order date too.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    date = F.col("o_orderdate")
    orders = spark.read.schema(ORDERS_SCHEMA).parquet(f"{sf_dir}/orders.parquet")
    if first is not None:
        orders = orders.where(date >= F.lit(_month_start(first, shift)))
    if last is not None:
        after = 12 if grain == "year" else 1
        orders = orders.where(date < F.lit(_month_start(last, shift, after)))
    month = F.month(date) if grain != "year" else F.lit(1)
    day = F.day(date) if grain == "day" else F.lit(1)
    snapshot = ((F.year(date) - shift) * 10000 + month * 100 + day).cast("string")
    if null_dates:
        snapshot = F.when(F.col("o_orderkey") % 10 != 3, snapshot)
    # Computed on the order side, once per order instead of once per line.
    owners = orders.select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("custno"), snapshot.alias("snapshot")
    )
    product = (F.col("l_linenumber") + F.col("l_orderkey")) % 8 + 1
    price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    if cents:
        price = F.round(F.col("l_extendedprice"), 2).cast("decimal(18,2)")
    return (
        spark.read.schema(LINEITEM_SCHEMA)
        .parquet(f"{sf_dir}/lineitem.parquet")
        .join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "custno",
            F.concat(
                F.lpad(product.cast("string"), 2, "0"),
                F.lpad(F.col("l_orderkey").cast("string"), 8, "0"),
            ).alias("acno"),
            F.concat(price.cast("string"), F.when(F.col("l_returnflag") == "R", "-").otherwise("+")).alias(
                "remaining"
            ),
            "snapshot",
        )
    )
