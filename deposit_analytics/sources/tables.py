"""Result tables in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def create_result_table(spark: SparkSession, name: str, path: str, schema: StructType) -> None:
    """External parquet table over ``path``, unless the table is there already."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def insert_result(result: DataFrame, name: str) -> None:
    """Appends rows to a table; columns are matched by name, not by place."""
    result.select(*result.sparkSession.table(name).columns).write.insertInto(name)


def read_result_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def refresh(spark: SparkSession, name: str) -> None:
    """Drops cached file listings of a table or view that other jobs write to."""
    spark.catalog.refreshTable(name)
