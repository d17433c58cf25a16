"""The physical plans of the jobs, on stored tables as a user has them."""

import datetime as dt
import re

import pytest

from deposit_analytics.functions.calendar import Calendar
from deposit_analytics.plans import lookback, wealth
from deposit_analytics.sources import fixtures, sinks

SF = "/root/testdata/sf0.001"
RANGE = Calendar("13960101", "13960630")


@pytest.fixture(scope="module")
def stored(spark):
    flat, folders = sinks.work_folder(spark, "flat"), sinks.work_folder(spark, "folders")
    table = fixtures.balances(spark, SF, "month")
    table.write.parquet(flat)
    sinks.write_parquet(table, folders)
    people = sinks.work_folder(spark, "people")
    fixtures.customers(spark, SF).write.parquet(people)
    return {
        "flat": spark.read.parquet(flat),
        "folders": spark.read.schema(table.schema).parquet(folders),
        "people": spark.read.parquet(people),
    }


@pytest.fixture(autouse=True)
def whole_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture
def no_broadcast(spark):
    """Plans as large tables get them."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def first_plan(frame):
    text = re.sub(r"#\d+L?", "", frame._jdf.queryExecution().executedPlan().toString())
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    return text


def pivot(stored, kind, **options):
    return wealth.wealth_pivot(stored[kind], stored["people"], RANGE, threshold=10**7, money="bigint", **options)


def by_group(stored, kind, **options):
    return wealth.wealth_by_group(
        stored[kind], stored["people"], dt.date(2018, 4, 21), RANGE, threshold=10**7, money="bigint", **options
    )


def steps(stored, kind):
    return wealth.step_counts(stored[kind], stored["people"], RANGE, threshold=10**7, money="bigint")


JOBS = {
    "pivot": pivot,
    "deduped": lambda stored, kind: pivot(stored, kind, dedupe_customers=True),
    "by_group": by_group,
    "steps": steps,
}


@pytest.mark.parametrize("job", JOBS)
def test_range_reaches_the_files(spark, stored, job):
    plan = first_plan(JOBS[job](stored, "flat"))
    assert "GreaterThanOrEqual(snapshot,13960101)" in plan
    assert "LessThanOrEqual(snapshot,13960630)" in plan


@pytest.mark.parametrize("job", JOBS)
def test_whole_calendar_prunes_folders(spark, stored, job):
    frame = JOBS[job](stored, "folders")
    plan = first_plan(frame)
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "remaining" in line)
    pruned, pushed = re.search(r"PartitionFilters: \[(.*)\], PushedFilters: \[(.*?)\]", scan).groups()
    assert "(snapshot >= 13960101)" in pruned and "snapshot INSET 13960101" in pruned
    assert "snapshot" not in pushed
    # Nothing about the date is left to test row by row.
    assert not [line for line in plan.splitlines() if " Filter " in line and "(snapshot" in line]


@pytest.mark.parametrize("job", JOBS)
def test_balances_are_scanned_once(spark, stored, job):
    plan = first_plan(JOBS[job](stored, "flat"))
    assert plan.count("remaining") and len(re.findall(r"FileScan parquet \[[^]]*remaining", plan)) == 1


def shuffles(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)


def keys(shuffle):
    return shuffle.split(", ")


def test_pivot_shuffles_without_broadcasts(spark, stored, no_broadcast):
    frame = pivot(stored, "flat")
    plan = first_plan(frame)
    # Sums spread one customer over its snapshots; wealthy rows and openings meet
    # by customer. The openings appear twice, the second time for their maximum.
    assert sorted(keys(s) for s in shuffles(plan)) == [
        ["custno"],
        ["custno"],
        ["custno", "date_opened"],
        ["custno", "date_opened"],
        ["custno", "snapshot"],
    ]
    frame.collect()
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_customer_number_stop_at_the_scan(spark, stored):
    for job in (pivot, by_group):
        assert "IsNotNull(custno)" in first_plan(job(stored, "folders")).split("remaining")[-1]


def test_group_job_joins_only_rows_above_the_threshold(spark, stored, no_broadcast):
    plan = first_plan(by_group(stored, "flat"))
    join = plan.index("SortMergeJoin")
    threshold = plan.index(">= 10000000)")
    assert join < threshold  # the filter sits below the join
    assert sorted(keys(s) for s in shuffles(plan)) == [["custno"], ["custno"], ["custno", "snapshot"]]


def test_sums_combine_before_the_shuffle(spark, stored, no_broadcast):
    plan = first_plan(pivot(stored, "flat"))
    assert "partial_sum" in plan
    assert "SortAggregate" not in plan


def test_results_do_not_depend_on_the_join_strategy(spark, stored, request):
    broadcast = {name: sorted(map(tuple, job(stored, "flat").collect()), key=repr) for name, job in JOBS.items()}
    request.getfixturevalue("no_broadcast")
    for name, job in JOBS.items():
        assert sorted(map(tuple, job(stored, "folders").collect()), key=repr) == broadcast[name]
        assert broadcast[name]


def test_lookback_window_is_a_literal_in_the_scan(spark, stored):
    plan = first_plan(lookback.lookback_balance(stored["flat"], Calendar("13960601", "13970231")))
    assert "GreaterThanOrEqual(snapshot,13961131)" in plan and "LessThanOrEqual(snapshot,13970231)" in plan
    assert len(shuffles(plan)) == 1


@pytest.mark.parametrize("job", [pivot, by_group])
def test_deduped_customers_need_no_sort(spark, stored, no_broadcast, job):
    plan = first_plan(job(stored, "flat", dedupe_customers=True))
    assert "SortAggregate" not in plan
    # The customers move once, to the join.
    assert sorted(keys(s) for s in shuffles(plan))[:2] == [["custno"], ["custno"]]
