"""The command line, from stored tables to stored results."""

import pytest

from deposit_analytics import __main__ as command
from deposit_analytics import constants
from deposit_analytics.plans import wealth
from deposit_analytics.sources import sinks

import helpers
from helpers import rows

BALANCES = [
    ("a", "01x", "9000000000+", 13960101),
    ("a", "02x", "2000000000+", 13960101),
    ("a", "04x", "1+", 13960101),
    ("a", "01x", "9000000000+", 13960102),
    ("b", "01x", "20000000000+", 13960201),
]


@pytest.fixture(scope="module")
def paths(spark):
    held, people = sinks.work_folder(spark, "held"), sinks.work_folder(spark, "people")
    spark.createDataFrame(
        BALANCES, "CUSTNO string, ACNO string, REMAININGAMOUNTEFFECTIVE string, HISDATE int"
    ).write.parquet(held)
    spark.createDataFrame(
        [("a", "950115", "01"), ("b", "960115", "01")], "CUSTNO string, DATEOPN string, custype string"
    ).write.parquet(people)
    return ["--balances", held, "--customers", people, "--first", "13960101", "--last", "13960301"]


def test_pivot_replaces_its_dates(spark, paths, capsys):
    out = sinks.work_folder(spark, "out")
    for _ in range(2):
        command.main(["wealth-pivot", *paths, "--money", "bigint", "--out", out])
    assert capsys.readouterr().out.startswith("2 rows")
    schema = (
        "custno string, interest_free bigint, short_term bigint, term bigint, tenure_days bigint, snapshot string"
    )
    stored = sinks.read_parquet_result(spark, out, spark.createDataFrame([], schema).schema)
    assert rows(stored) == [
        ("a", 9000000000, 2000000000, 1, 351, "13960101"),  # 365 - 14
        ("b", 20000000000, None, None, 16, "13960201"),  # 30.42 - 14
    ]


def test_first_of_month_groups_as_of_a_day(spark, paths):
    out = sinks.work_folder(spark, "out")
    extra = ["--as-of", "2018-04-21", "--day", "01", "--sink", "csv", "--money", "bigint"]
    command.main(["wealth-by-group", *paths, *extra, "--out", out])
    assert [r.value for r in spark.read.text(out).collect()] == ["a,9000000000,2000000000,1,746,13960101"]


def test_lookback(spark, paths):
    out = sinks.work_folder(spark, "out")
    command.main(["lookback", *paths, "--money", "bigint", "--out", out])
    command.main(["lookback", *paths, "--money", "bigint", "--out", out])
    assert rows(spark.read.parquet(out)) == [
        ("a", 18000000000, 2000000000, 1),
        ("b", 20000000000, None, None),
    ]


@pytest.mark.parametrize("drop", ["--customers", "--as-of"])
def test_missing_options_are_reported(paths, drop, capsys):
    given = ["wealth-by-group", *paths, "--as-of", "2018-04-21", "--out", "x"]
    at = given.index(drop)
    with pytest.raises(SystemExit):
        command.main(given[:at] + given[at + 2 :])
    assert drop in capsys.readouterr().err


@pytest.mark.parametrize("names", [constants.GROUP_EXPORT_NAMES, constants.PIVOT_EXPORT_NAMES])
def test_export_under_stored_names(spark, names):
    held = helpers.balances(spark, [("a", "01x", "20000000000+", "13960101")])
    people = helpers.customers(spark, [("a", "01", "950115")])
    out = wealth.export_strings(wealth.wealth_pivot(held, people), names)
    assert out.columns == list(names.values())


WEALTH = ["wealth-pivot", "wealth-by-group", "step-counts"]


@pytest.mark.parametrize(
    "report, option",
    [
        ("lookback", ["--threshold", "5"]),
        ("lookback", ["--day", "01"]),
        ("lookback", ["--dedupe-customers"]),
        ("lookback", ["--as-of", "2018-04-21"]),
        ("wealth-by-group", ["--tenure", "compat-v3"]),
        ("step-counts", ["--dedupe-customers"]),
        ("step-counts", ["--stored-names"]),
        *[(report, ["--strict-precedence"]) for report in WEALTH],
        *[(report, ["--months", "2"]) for report in WEALTH],
    ],
)
def test_options_a_report_would_ignore_are_errors(paths, report, option, capsys):
    with pytest.raises(SystemExit):
        command.main([report, *paths, "--out", "x", *option])
    assert option[0] in capsys.readouterr().err


@pytest.mark.parametrize(
    "options",
    [
        ["--tenure", "compat-v3", "--as-of", "2018-04-21"],
        ["--tenure", "compat-v2", "--century", "14"],
        ["--sink", "table"],
        ["--table", "t"],
        ["--stored-names"],
        ["--group", "free"],
        ["--threshold", "much"],
    ],
)
def test_options_that_do_not_go_together(paths, options):
    with pytest.raises((SystemExit, ArithmeticError)):
        command.main(["wealth-pivot", *paths, "--out", "x", *options])


def test_step_counts_of_every_date(spark, paths):
    out = sinks.work_folder(spark, "out")
    command.main(["step-counts", *paths, "--day", "01", "--money", "bigint", "--out", out])
    stored = spark.read.parquet(out)
    got = {(str(r.snapshot), r.step): r.n for r in stored.collect()}
    assert got["13960101", "result"] == 1
    assert got["13960201", "interest_free"] == 1
    assert got["13960301", "tenure"] == 2
    assert got["13960301", "term"] == 0


def test_table_sink_under_stored_names(spark, paths):
    out = sinks.work_folder(spark, "out")
    name = "stored_by_command"
    given = ["wealth-by-group", *paths, "--as-of", "2018-04-21", "--money", "bigint", "--sink", "table", "--table", name]
    command.main([*given, "--stored-names", "--out", out])
    try:
        table = spark.table(name)
        assert table.columns == list(constants.GROUP_EXPORT_NAMES.values())
        assert [r.MandehGharz for r in table.collect()] == ["9000000000"]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_csv_sink_takes_the_stored_columns_in_order(spark, paths):
    out = sinks.work_folder(spark, "out")
    command.main(["wealth-pivot", *paths, "--money", "bigint", "--sink", "csv", "--stored-names", "--out", out])
    assert sorted(r.value.split(",")[0] for r in spark.read.text(out).collect()) == ["a", "b"]


def test_threshold_sign_groups_century_and_leap_years(spark, paths):
    out = sinks.work_folder(spark, "out")
    extra = ["--threshold", "11000000001", "--bound", "inclusive", "--sign", "trailing", "--century", "12", "--money", "bigint"]
    command.main(["wealth-pivot", *paths, *extra, "--leap-years", "1396", "--group", "all=01,02,04", "--out", out])
    got = {r.custno: (r.all, r.tenure_days) for r in spark.read.parquet(out).collect()}
    assert got == {"a": (11000000001, 351 + 36500), "b": (20000000000, 16 + 36500)}
    strict = sinks.work_folder(spark, "out")
    command.main(["wealth-pivot", *paths, "--threshold", "11000000001", "--money", "bigint", "--cut-year", "96", "--out", strict])
    # Opened in 96, which is not below the cut.
    assert [(r.custno, r.tenure_days) for r in spark.read.parquet(strict).collect()] == [("b", 16)]


def test_partition_number(spark, paths):
    options = command.checked(["lookback", *paths[:2], *paths[4:], "--out", "x", "--shuffle-partitions", "7"])
    assert options.shuffle_partitions == 7
