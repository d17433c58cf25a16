"""Command line: one report over stored tables, all dates in one job.

    python -m deposit_analytics wealth-pivot --balances PATH --customers PATH \\
        --first 13960101 --last 13970301 --out PATH

On a cluster, submit this file and give the package with ``--py-files``.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Mapping
from decimal import Decimal
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deposit_analytics import constants
from deposit_analytics.functions import tenure
from deposit_analytics.functions.calendar import Calendar
from deposit_analytics.plans import lookback, runs, wealth
from deposit_analytics.session import build_session
from deposit_analytics.sources import readers, sinks, tables

TENURES = {
    "as-of-snapshot": tenure.as_of_snapshot,
    "compat-v2": tenure.compat_v2,
    "compat-v3": tenure.compat_v3,
}

# Options that only some reports use; elsewhere they are an error, not ignored.
OWN_OPTIONS = {
    "wealth-pivot": {
        "customers", "threshold", "bound", "tenure", "as_of", "century", "cut_year", "dedupe_customers", "day", "stored_names"
    },
    "wealth-by-group": {
        "customers", "threshold", "bound", "as_of", "century", "cut_year", "dedupe_customers", "day", "stored_names"
    },
    "step-counts": {"customers", "threshold", "bound", "day"},
    "lookback": {"strict_precedence", "months"},
}
STORED_NAMES = {"wealth-pivot": constants.PIVOT_EXPORT_NAMES, "wealth-by-group": constants.GROUP_EXPORT_NAMES}


def _group(text: str) -> tuple[str, tuple[str, ...]]:
    name, _, codes = text.partition("=")
    if not name or not codes:
        raise argparse.ArgumentTypeError(f"give a group as name=code,code, not {text!r}")
    return name, tuple(codes.split(","))


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="deposit_analytics", description=__doc__.splitlines()[0])
    main.add_argument("report", choices=tuple(OWN_OPTIONS))
    main.add_argument("--balances", required=True, help="parquet path of the balance table")
    main.add_argument("--customers", help="parquet path of the customer table")
    main.add_argument("--first", required=True, help="first snapshot date, YYYYMMDD")
    main.add_argument("--last", required=True, help="last snapshot date, YYYYMMDD")
    main.add_argument("--day", help="keep one day of the month only, e.g. 01 or 31")
    main.add_argument("--leap-years", type=int, nargs="+", default=(), help="years with 30 days in month 12")
    main.add_argument("--threshold", type=Decimal, help="total a customer must exceed (pivot) or reach (others)")
    main.add_argument("--bound", choices=("strict", "inclusive"), help="whether the threshold itself counts")
    main.add_argument("--tenure", choices=TENURES, help="tenure of the pivot report, as-of-snapshot by default")
    main.add_argument("--as-of", type=dt.date.fromisoformat, help="Gregorian day the tenure is counted to")
    main.add_argument("--century", help="century of two-digit opening years, 13 by default")
    main.add_argument("--cut-year", type=int, help="opening years below it are of the next century")
    main.add_argument("--group", type=_group, action="append", help="a product group as name=code,code; repeat for each")
    main.add_argument("--sign", choices=("ignore", "trailing"), default="ignore", help="meaning of a trailing -")
    main.add_argument("--money", default=constants.MONEY, help="type of the sums")
    main.add_argument("--dedupe-customers", action="store_true", default=None)
    main.add_argument("--strict-precedence", action="store_true", default=None, help="lookback report only")
    main.add_argument("--months", type=int, help="months the lookback reaches back")
    main.add_argument("--out", required=True, help="folder of the result")
    main.add_argument("--sink", choices=("replace", "append", "csv", "table"), default="replace")
    main.add_argument("--table", help="catalog table of the table sink; its files are in --out")
    main.add_argument("--stored-names", action="store_true", default=None, help="text columns under the stored names")
    main.add_argument("--shuffle-partitions", type=int, help="partitions of a shuffle before adaptive merging")
    return main


def checked(arguments: list[str] | None) -> argparse.Namespace:
    """The options; an error for those missing and for those the report would ignore."""
    usage = parser()
    options = usage.parse_args(arguments)
    own = OWN_OPTIONS[options.report]
    for name in sorted(set().union(*OWN_OPTIONS.values()) - own - {"customers"}):
        if getattr(options, name) is not None:
            usage.error(f"--{name.replace('_', '-')} has no meaning for {options.report}")
    if "customers" in own and options.customers is None:
        usage.error("--customers is needed for the wealth reports")
    if options.report == "wealth-by-group" and options.as_of is None:
        usage.error("--as-of is needed for wealth-by-group")
    if options.tenure is not None and options.as_of is not None:
        usage.error("--tenure and --as-of exclude each other")
    if options.tenure == "compat-v2" and (options.century or options.cut_year is not None):
        usage.error("--century and --cut-year have no meaning for compat-v2")
    if options.tenure == "compat-v3" and options.cut_year is not None:
        usage.error("--cut-year has no meaning for compat-v3")
    if (options.sink == "table") != (options.table is not None):
        usage.error("--table and --sink table belong together")
    if options.stored_names and options.sink in ("replace", "append"):
        usage.error("--stored-names goes with the csv and table sinks")
    return options


def _formula(options: argparse.Namespace):
    years = {"century": options.century, "cut_year": options.cut_year}
    years = {name: value for name, value in years.items() if value is not None}
    if options.as_of is not None:
        return lambda _, opened: tenure.as_of_date(options.as_of, opened, **years)
    return partial(TENURES[options.tenure or "as-of-snapshot"], **years)


def report(spark: SparkSession, options: argparse.Namespace, calendar: Calendar) -> DataFrame:
    shared: dict = {"money": options.money, "sign": options.sign}
    if options.group:
        shared["groups"] = dict(options.group)
    if options.report == "lookback":
        # Without brackets some products count on every date: no bounds then.
        months = {} if options.months is None else {"months": options.months}
        bounds = () if options.strict_precedence else lookback.window_bounds(calendar, **months)
        return lookback.lookback_balance(
            readers.read_balances(spark, options.balances, *bounds),
            calendar,
            strict_precedence=bool(options.strict_precedence),
            **months,
            **shared,
        )
    given = (
        readers.read_balances(spark, options.balances, options.first, options.last),
        readers.read_customers(spark, options.customers),
    )
    if options.threshold is not None:
        shared["threshold"] = options.threshold
    if options.bound is not None:
        shared["inclusive"] = options.bound == "inclusive"
    if options.report == "step-counts":
        return wealth.step_counts(*given, calendar, **shared)
    shared["dedupe_customers"] = bool(options.dedupe_customers)
    if options.report == "wealth-by-group":
        return wealth.wealth_by_group(*given, options.as_of, calendar, tenure=_formula(options), **shared)
    return wealth.wealth_pivot(*given, calendar, tenure=_formula(options), **shared)


def _as_text(result: DataFrame, names: Mapping[str, str]) -> DataFrame:
    if set(wealth.EXPORT_COLUMNS) <= set(result.columns):
        return wealth.export_strings(result, names)
    return result.select(*[F.col(name).cast("string").alias(names.get(name, name)) for name in result.columns])


def store(spark: SparkSession, result: DataFrame, options: argparse.Namespace, calendar: Calendar) -> None:
    names = STORED_NAMES[options.report] if options.stored_names else {}
    if options.sink == "csv":
        sinks.append_csv(result if options.report == "lookback" else _as_text(result, names), options.out)
    elif options.sink == "table":
        rows = _as_text(result, names)
        tables.create_result_table(spark, options.table, options.out, rows.schema)
        tables.insert_result(rows, options.table)
        tables.refresh(spark, options.table)
    elif options.report == "lookback":
        # No snapshot column: one window, one flat folder.
        mode = "overwrite" if options.sink == "replace" else "append"
        sinks.write_parquet(result, options.out, mode, partition_by=())
    else:
        _, rows = runs.store_snapshots(result, options.out, options.sink == "replace", calendar)
        print(f"{rows} rows stored in {options.out}")


def main(arguments: list[str] | None = None) -> None:
    options = checked(arguments)
    calendar = Calendar(options.first, options.last, options.day, leap_years=tuple(options.leap_years))
    spark = build_session(shuffle_partitions=options.shuffle_partitions)
    store(spark, report(spark, options, calendar), options, calendar)


if __name__ == "__main__":
    main()
