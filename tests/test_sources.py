from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from deposit_analytics.functions.calendar import Calendar
from deposit_analytics.plans import lookback, runs
from deposit_analytics.sources import readers, sinks, tables

import helpers
from helpers import rows

SCHEMA = "custno string, interest_free decimal(38,2), short_term decimal(38,2), term decimal(38,2), tenure_days bigint, snapshot string"
OLD = [("a", Decimal("1.00"), None, None, 10, "13960101"), ("b", None, Decimal("2.50"), None, None, "13960201")]
NEW = [("c", None, None, Decimal("3.00"), 7, "13960201")]


@pytest.fixture
def folder(spark):
    return sinks.work_folder(spark, "test")


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def back(spark, folder):
    return rows(sinks.read_parquet_result(spark, folder, frame(spark, OLD).schema))


def test_append_keeps_what_is_there_and_repeats_reruns(spark, folder):
    sinks.write_parquet(frame(spark, OLD), folder)
    sinks.write_parquet(frame(spark, NEW), folder)
    sinks.write_parquet(frame(spark, NEW), folder)
    assert back(spark, folder) == sorted(OLD + NEW + NEW, key=repr)


def test_overwriting_one_snapshot_leaves_the_others(spark, folder):
    sinks.overwrite_snapshots(frame(spark, OLD), folder)
    sinks.overwrite_snapshots(frame(spark, NEW), folder)
    sinks.overwrite_snapshots(frame(spark, NEW), folder)
    assert back(spark, folder) == sorted(OLD[:1] + NEW, key=repr)


def test_ignore_overwrite_and_error_modes(spark, folder):
    sinks.write_parquet(frame(spark, OLD), folder, "ignore")
    sinks.write_parquet(frame(spark, NEW), folder, "ignore")
    assert back(spark, folder) == sorted(OLD, key=repr)
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_parquet(frame(spark, NEW), folder, "error")
    sinks.write_parquet(frame(spark, NEW), folder, "overwrite")
    assert back(spark, folder) == NEW
    with pytest.raises(ValueError):
        sinks.write_parquet(frame(spark, NEW), folder, "upsert")


def test_flat_layout(spark, folder):
    sinks.write_parquet(frame(spark, OLD), folder, partition_by=())
    assert rows(spark.read.parquet(folder)) == sorted(OLD, key=repr)


def test_stored_run_counts_its_rows(spark, folder):
    stored, n = runs.store_snapshots(frame(spark, OLD), folder)
    assert n == 2 and rows(stored) == sorted(OLD, key=repr)
    stored, n = runs.store_snapshots(frame(spark, NEW), folder, rerun=False)
    assert n == 1 and rows(stored) == sorted(OLD + NEW, key=repr)


def test_one_file_per_snapshot_for_small_results(spark, folder):
    wide = frame(spark, OLD + NEW).repartition(16)
    sinks.overwrite_snapshots(wide, folder)
    files = spark.read.parquet(folder).select(F.input_file_name()).distinct().count()
    assert files == 2


def test_csv_appends_without_header_or_row_numbers(spark, folder):
    text = [("a", "1", None, "سه"), ("b", "2,5", 'q"', None)]
    schema = "custno string, x string, y string, z string"
    for row in text:
        sinks.append_csv(spark.createDataFrame([row], schema), folder)
    lines = sorted(r.value for r in spark.read.text(folder).collect())
    assert lines[0] == "a,1,,سه"
    again = sinks.read_csv_result(spark, folder, spark.createDataFrame(text, schema).schema)
    assert rows(again) == sorted(text, key=repr)


def test_table_is_created_once_filled_and_read_back(spark, folder):
    name = "wealth_" + folder.rsplit("-", 1)[1]
    table = frame(spark, OLD)
    tables.create_result_table(spark, name, folder, table.schema)
    tables.create_result_table(spark, name, folder, table.schema)
    tables.insert_result(table, name)
    turned = frame(spark, NEW).select(*reversed(table.columns))
    tables.insert_result(turned, name)
    tables.refresh(spark, name)
    assert rows(tables.read_result_table(spark, name)) == sorted(OLD + NEW, key=repr)
    spark.sql(f"DROP TABLE {name}")
    assert rows(spark.read.parquet(folder)) == sorted(OLD + NEW, key=repr)


def test_refresh_accepts_a_view(spark):
    frame(spark, OLD).createOrReplaceTempView("wealth_view")
    tables.refresh(spark, "wealth_view")


def test_preview_and_count(spark):
    assert len(sinks.preview(frame(spark, OLD)).collect()) == 1
    observation = Observation("n")
    sinks.counted(frame(spark, OLD), observation).collect()
    assert observation.get["rows"] == 2


@pytest.mark.parametrize("kind", ["string", "int"])
def test_readers_rename_and_push_the_bounds(spark, folder, kind):
    stored = spark.createDataFrame(
        [("a", "01x", "5+", 13960101), ("b", "02x", "6+", 13960201), ("c", "02x", "7+", 13960301)],
        "CUSTNO string, ACNO string, REMAININGAMOUNTEFFECTIVE string, HISDATE int",
    ).withColumn("HISDATE", F.col("HISDATE").cast(kind))
    stored.withColumn("other", F.lit(1)).write.parquet(folder)
    table = readers.read_balances(spark, folder, "13960102", "13960201")
    assert table.columns == ["custno", "acno", "remaining", "snapshot"]
    assert rows(table) == [("b", "02x", "6+", "13960201")]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(HISDATE,13960102)" in plan and "LessThanOrEqual(HISDATE,13960201)" in plan
    assert "other" not in plan


def test_lookback_bounds_reach_files_with_numeric_snapshots(spark, folder):
    spark.createDataFrame(
        [("a", "01x", "5+", 13961131), ("a", "01x", "6+", 13961130)],
        "CUSTNO string, ACNO string, REMAININGAMOUNTEFFECTIVE string, HISDATE int",
    ).write.parquet(folder)
    calendar = Calendar("13960601", "13970231")
    table = readers.read_balances(spark, folder, *lookback.window_bounds(calendar))
    got = lookback.lookback_balance(table, calendar, money="bigint")
    assert rows(got, "custno", "interest_free") == [("a", 5)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(HISDATE,13961131)" in plan


def test_customer_reader(spark, folder):
    spark.createDataFrame(
        [("a", "x", "950115", "01")], "CUSTNO string, name string, DATEOPN string, custype string"
    ).write.parquet(folder)
    assert rows(readers.read_customers(spark, folder)) == [("a", "01", "950115")]


def test_views_take_bound_values(spark):
    held = helpers.balances(spark, [("a", "01x", "5+", "13960101"), ("a", "01x", "6+", "13960102")])
    readers.register_views(held, helpers.customers(spark, [("a", "01", "950115")]))
    got = spark.sql("SELECT remaining FROM balances WHERE snapshot = :d", args={"d": "13960102"})
    assert rows(got) == [("6+",)]
    assert spark.table("customers").count() == 1


def test_work_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = sinks.work_folder(spark, "x"), sinks.work_folder(spark, "x")
    assert one != two and one.startswith(base.rstrip("/") + "/x-")


class FakeSession:
    """Only the settings of a session."""

    def __init__(self, settings):
        self.conf = settings


def test_work_folder_without_the_setting():
    assert sinks.work_folder(FakeSession({"spark.master": "local[2]"}), "x").startswith("/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.work_folder(FakeSession({"spark.master": "yarn"}), "x")
    shared = {"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://host/shared/"}
    assert sinks.work_folder(FakeSession(shared), "x").startswith("hdfs://host/shared/x-")


def test_scratch_folders_go_with_their_block(spark):
    kept = sinks.work_folder(spark, "kept")
    with sinks.scratch(spark, "run") as outer:
        one = sinks.work_folder(spark, "one")
        spark.range(3).write.parquet(one)
        with sinks.scratch(spark) as inner:
            two = sinks.work_folder(spark, "two")
            spark.read.parquet(one).write.parquet(two)
            spark.read.parquet(two).write.parquet(kept)
        assert one.startswith(outer) and inner.startswith(outer) and two.startswith(inner)
        assert Path(one).exists() and not Path(inner).exists()
    assert not Path(outer).exists() and spark.read.parquet(kept).count() == 3
    assert not sinks.work_folder(spark, "after").startswith(outer)
    with pytest.raises(ZeroDivisionError), sinks.scratch(spark) as failed:
        spark.range(1).write.parquet(sinks.work_folder(spark, "x"))
        1 / 0  # noqa: B018
    assert not Path(failed).exists()
    with sinks.scratch(spark):
        pass
    sinks.drop_folder(spark, kept)
    sinks.drop_folder(spark, kept)
    assert not Path(kept).exists()


def test_a_rerun_drops_the_emptied_dates_of_its_calendar(spark, folder):
    one = lambda custno, date: (custno, *OLD[0][1:-1], date)
    first = [one("a", date) for date in ("13960101", "13960102", "13960201")]
    runs.store_snapshots(frame(spark, first), folder)
    calendar = Calendar("13960101", "13960131")
    _, count = runs.store_snapshots(frame(spark, [one("b", "13960102")]), folder, calendar=calendar)
    assert count == 1
    assert back(spark, folder) == sorted([one("a", "13960201"), one("b", "13960102")], key=repr)
    _, count = runs.store_snapshots(frame(spark, []), folder, calendar=calendar)
    assert count == 0
    assert back(spark, folder) == [one("a", "13960201")]
