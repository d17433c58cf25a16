"""Customer side: openings, totals per opening, qualification."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from deposit_analytics.constants import EXCLUDED_TYPE, MONEY, MOST_SCALE
from deposit_analytics.functions import columns

Tenure = Callable[[Column, Column], Column]


def latest_opening(date_opened: Column) -> Column:
    """The latest of six-digit opening dates; other texts do not count.

    Compared as numbers, which keep the order of such texts: text maxima would
    make Spark sort the table, numbers stay in a hash aggregation.
    """
    number = F.when(date_opened.rlike("^[0-9]{6}$"), date_opened.try_cast("int"))
    return F.lpad(F.max(number).cast("string"), 6, "0")


def openings(customers: DataFrame, excluded_type: str = EXCLUDED_TYPE, dedupe: bool = False) -> DataFrame:
    """custno, date_opened, copies of the customers the pivot job looks at.

    Rows of the excluded type and rows without a type are left out. ``copies``
    counts the customer rows behind one opening date: a join with those rows
    would repeat every balance that often. ``dedupe`` keeps one row per
    customer, with the latest opening date.

    Repeated rows combine before the shuffle, so a customer with very many of
    them burdens no task; the openings then move once more, to the join.
    """
    kept = customers.where((F.col("cust_type") != excluded_type) & F.col("custno").isNotNull())
    if dedupe:
        return kept.groupBy("custno").agg(
            latest_opening(F.col("date_opened")).alias("date_opened"), F.lit(1).cast("bigint").alias("copies")
        )
    return kept.groupBy("custno", "date_opened").agg(F.count(F.lit(1)).alias("copies"))


def totals_per_opening(totals: DataFrame, opened: DataFrame, money: str = MONEY) -> DataFrame:
    """Joins ``total`` per customer and snapshot with that customer's openings.

    The join meets balances that are already summed, so its shuffle carries
    one row per customer and snapshot instead of one per account.
    """
    return (
        totals.join(opened, "custno")
        .withColumn("total", (F.col("total") * F.col("copies")).cast(money))
        .drop("copies")
    )


def qualified(
    balances: DataFrame,
    opened: DataFrame,
    tenure: Tenure,
    threshold,
    inclusive: bool = False,
    dedupe: bool = False,
) -> DataFrame:
    """Balance rows of openings whose total reaches the threshold.

    ``balances`` has ``custno``, ``snapshot`` and ``total`` beside its own
    columns. A row comes out once per qualifying opening and with the tenure of
    that opening.

    Rows that cannot qualify under any opening are dropped before the join. An
    opening multiplies the total by its number of copies, so the bound before
    the join is the threshold over the largest number of copies there is,
    rounded down. With clean customer data that number is 1 and only wealthy
    customers are joined at all.
    """
    total, bound = F.col("total"), F.lit(columns.exact(threshold))
    kind = balances.schema["total"].dataType
    if isinstance(kind, DecimalType) and kind.scale > MOST_SCALE:
        raise ValueError(f"money with more than {MOST_SCALE} decimals cannot be multiplied exactly")
    if not dedupe:
        most = opened.agg(F.max("copies")).scalar()
        bound = F.least(bound, F.call_function("div", bound, most))
    hopeful = balances.where(columns.reaches(total, bound, inclusive))
    # Compared as a decimal: a total that fits its type may not fit once multiplied.
    repeated = total * F.col("copies").cast("decimal(20,0)")
    return (
        hopeful.join(opened, "custno")
        .where(columns.reaches(repeated, threshold, inclusive))
        .withColumn("tenure_days", tenure(F.col("snapshot"), F.col("date_opened")))
    )


def scan_profile(customers: DataFrame) -> DataFrame:
    """n_rows, n_null_type of a customer table."""
    return customers.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("cust_type").isNull()).alias("n_null_type"),
    )
