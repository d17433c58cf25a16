
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deposit_analytics.constants import GROUP_JOB_CODES, MONEY, WHOLE_MONEY
from deposit_analytics.functions import tenure
from deposit_analytics.functions.calendar import Calendar
from deposit_analytics.operators import balances as balance_ops
from deposit_analytics.operators import customers as customer_ops
from deposit_analytics.plans import lookback, runs, wealth
from deposit_analytics.sources import fixtures, readers, sinks, tables

try:
    from deposit_analytics.llm import queries as corpus
except ImportError:
    corpus = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"

# The test tables hold whole cents, so the thresholds are scaled to them.
PIVOT_OPTIONS = {"threshold": 19999999, "money": WHOLE_MONEY}
GROUP_OPTIONS = {"threshold": 20000000, "money": WHOLE_MONEY}
# The same in units with cents, under the default type.
CENTS_OPTIONS = {"threshold": "199999.99", "money": MONEY}
AS_OF = dt.date(2018, 4, 21)

FIRST_OF_MONTH = Calendar("13960101", "13970301", day="01")
DAILY = Calendar("13960101", "13970301")
DAY31 = Calendar("13910101", "13971229", day="31")
EARLY, LATE = Calendar("13910101", "13941229"), Calendar("13950101", "13971229")
ONE_DATE = Calendar("13960101", "13960101")
# Orders shifted ten years further, past the years of the other reports.
LATE_SHIFT = fixtures.YEAR_SHIFT - 10
LATE_DAILY = Calendar("14060101", "14070301")
LEAP = Calendar("13951101", "13970301", leap_years=(1395,))
CUT_YEAR = 50
LOOKBACK = Calendar("13960601", "13970231")
# First day the lookback of that calendar reaches, for the scan of the tables.
LOOKBACK_FIRST = "13961131"

Query = Callable[[SparkSession, str], DataFrame]


def _balances(spark: SparkSession, sf: str, grain: str, calendar: Calendar | None = None, **kind) -> DataFrame:
    if calendar is None:
        return fixtures.balances(spark, sf, grain, **kind)
    return fixtures.balances(spark, sf, grain, calendar.first, calendar.last, **kind)


def _accounts(spark: SparkSession, sf: str, grain: str = "year") -> DataFrame:
    return balance_ops.account_projection(_balances(spark, sf, grain), WHOLE_MONEY)


def _pivot(grain: str, calendar: Calendar | None = None, kind=None, people=fixtures.customers, **options) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return wealth.wealth_pivot(
            _balances(spark, sf, grain, calendar, **(kind or {})),
            people(spark, sf),
            calendar,
            **{**PIVOT_OPTIONS, **options},
        )

    return query


def _by_group(grain: str, calendar: Calendar | None = None, kind=None, people=fixtures.customers) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return wealth.wealth_by_group(
            _balances(spark, sf, grain, calendar, **(kind or {})),
            people(spark, sf),
            AS_OF,
            calendar,
            **GROUP_OPTIONS,
        )

    return query


def _group_balance(codes) -> Query:
    return lambda spark, sf: balance_ops.group_balance(_accounts(spark, sf), codes, WHOLE_MONEY)


def _tenure_on_snapshots(formula) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        seen = _balances(spark, sf, "day").select("custno", "snapshot").distinct()
        people = fixtures.customers(spark, sf).select("custno", "date_opened")
        days = formula(F.col("snapshot"), F.col("date_opened"))
        return seen.join(people, "custno").select("custno", "snapshot", days.alias("tenure_days"))

    return query


def _tenure_per_customer(formula) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return fixtures.customers(spark, sf).select(
            "custno", formula(F.col("date_opened")).alias("tenure_days")
        )

    return query


def _tenure_two_centuries(spark: SparkSession, sf: str) -> DataFrame:
    seen = _balances(spark, sf, "day").select("custno", "snapshot").distinct()
    people = fixtures.customers(spark, sf, first_year=90).select("custno", "date_opened")
    days = tenure.as_of_snapshot(F.col("snapshot"), F.col("date_opened"), cut_year=CUT_YEAR)
    return seen.join(people, "custno").select("custno", "snapshot", "date_opened", days.alias("tenure_days"))


def _step(job, people=fixtures.customers, calendar: Calendar | None = None, **options) -> Query:
    return lambda spark, sf: job(
        _balances(spark, sf, "year", calendar), people(spark, sf), calendar, **options
    )


def _lookback(**options) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return lookback.lookback_balance(
            fixtures.balances(spark, sf, "day", LOOKBACK_FIRST, LOOKBACK.last),
            LOOKBACK,
            money=WHOLE_MONEY,
            **options,
        )

    return query


def _lookback_group(name: str) -> Query:
    return lambda spark, sf: lookback.lookback_group(
        fixtures.balances(spark, sf, "day", LOOKBACK_FIRST, LOOKBACK.last), LOOKBACK, name, money=WHOLE_MONEY
    )


def _lookback_precedence(spark: SparkSession, sf: str) -> DataFrame:
    # Without brackets some products count on every date: no bounds on the scan.
    return lookback.lookback_balance(
        fixtures.balances(spark, sf, "day"), LOOKBACK, strict_precedence=True, money=WHOLE_MONEY
    )


def _calendar_days(calendar: Calendar) -> Query:
    return lambda spark, sf: balance_ops.calendar_coverage(_balances(spark, sf, "day", calendar), calendar)


def _lookback_window(spark: SparkSession, sf: str) -> DataFrame:
    return lookback.lookback_window(_balances(spark, sf, "day", LOOKBACK), LOOKBACK)


def _sql_view_balance(spark: SparkSession, sf: str) -> DataFrame:
    readers.register_views(_balances(spark, sf, "year"), fixtures.customers(spark, sf))
    return spark.sql(
        """
        SELECT b.custno, b.snapshot, c.cust_type,
               sum(try_cast(substr(b.remaining, 1, length(b.remaining) - 1) AS bigint)) AS balance
        FROM balances b JOIN customers c ON b.custno = c.custno
        WHERE b.snapshot = :snapshot AND substr(b.acno, 1, 2) = :product
        GROUP BY b.custno, b.snapshot, c.cust_type
        """,
        args={"snapshot": ONE_DATE.first, "product": "02"},
    )


def _yearly_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return _pivot("year")(spark, sf)


def _sink_parquet_append(spark: SparkSession, sf: str) -> DataFrame:
    folder = sinks.work_folder(spark, "append")
    result = _yearly_pivot(spark, sf)
    for part in (EARLY, LATE):
        sinks.write_parquet(result.where(part.in_range(F.col("snapshot"))), folder, "append")
    return sinks.read_parquet_result(spark, folder, result.schema)


def _sink_parquet_mode(mode: str) -> Query:
    """Stores the early years, then writes all years over them in ``mode``."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        folder = sinks.work_folder(spark, mode)
        result = _yearly_pivot(spark, sf)
        sinks.write_parquet(result.where(EARLY.in_range(F.col("snapshot"))), folder, mode)
        sinks.write_parquet(result, folder, mode)
        return sinks.read_parquet_result(spark, folder, result.schema)

    return query


def _sink_parquet_dynamic_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    folder = sinks.work_folder(spark, "overwrite")
    result = _yearly_pivot(spark, sf)
    runs.store_snapshots(result, folder)
    again = result.where(ONE_DATE.in_range(F.col("snapshot")))
    stored, _ = runs.store_snapshots(again, folder)
    return stored


def _sink_rerun_emptied_date(spark: SparkSession, sf: str) -> DataFrame:
    """Stores all years, then runs one again with a threshold that nobody reaches."""
    folder = sinks.work_folder(spark, "rerun")
    runs.store_snapshots(_yearly_pivot(spark, sf), folder)
    nobody = _pivot("year", ONE_DATE, threshold=10**15)(spark, sf)
    stored, _ = runs.store_snapshots(nobody, folder, calendar=ONE_DATE)
    return stored


def _sink_csv_append(spark: SparkSession, sf: str) -> DataFrame:
    folder = sinks.work_folder(spark, "csv")
    result = wealth.export_strings(_yearly_pivot(spark, sf))
    for part in (EARLY, LATE):
        sinks.append_csv(result.where(part.in_range(F.col("snapshot"))), folder)
    return sinks.read_csv_result(spark, folder, result.schema)


def _sink_table_insert(spark: SparkSession, sf: str) -> DataFrame:
    folder = sinks.work_folder(spark, "table")
    name = f"wealth_{uuid.uuid4().hex}"
    result = wealth.export_strings(_yearly_pivot(spark, sf))
    tables.create_result_table(spark, name, folder, result.schema)
    tables.insert_result(result, name)
    tables.refresh(spark, name)
    rows = tables.read_result_table(spark, name)
    # The files of an external table stay; only the name goes.
    spark.sql(f"DROP TABLE {name}")
    return rows


def entry(spark: SparkSession) -> DataFrame:
    """Wealth pivot of every yearly snapshot of the smoke tables."""
    return _yearly_pivot(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    """One entry per operator or job; each takes (spark, sf_dir)."""
    return {**_report_queries(), **_corpus_queries()}


def _corpus_queries() -> dict[str, Query]:
    found = {} if corpus is None else dict(corpus.QUERIES)
    if corpus_pipeline is not None:
        found["pipeline"] = corpus_pipeline.run
    return found


def _report_queries() -> dict[str, Query]:
    return {
        "balance_scan_profile": lambda spark, sf: balance_ops.scan_profile(_balances(spark, sf, "day")),
        "customer_scan_profile": lambda spark, sf: customer_ops.scan_profile(fixtures.customers(spark, sf)),
        "account_projection": lambda spark, sf: _accounts(spark, sf, "day"),
        "prod_balance_interest_free": _group_balance(GROUP_JOB_CODES["interest_free"]),
        "prod_balance_short_term": _group_balance(GROUP_JOB_CODES["short_term"]),
        "prod_balance_term": _group_balance(GROUP_JOB_CODES["term"]),
        "tenure_as_of_date": _tenure_per_customer(lambda opened: tenure.as_of_date(AS_OF, opened)),
        "tenure_compat_v2": _tenure_per_customer(lambda opened: tenure.compat_v2(F.lit(None), opened)),
        "tenure_compat_v3": _tenure_on_snapshots(tenure.compat_v3),
        "tenure_as_of_snapshot": _tenure_on_snapshots(tenure.as_of_snapshot),
        "customer_total": _step(wealth.customer_total, money=WHOLE_MONEY),
        "high_value_by_product": _step(wealth.high_value_by_product, **PIVOT_OPTIONS),
        "high_value_customers": _step(wealth.high_value_customers, **PIVOT_OPTIONS),
        "wealth_pivot": _yearly_pivot,
        "wealth_pivot_deduped": _pivot("year", dedupe_customers=True),
        "wealth_pivot_one_date": _pivot("year", ONE_DATE),
        "wealth_pivot_as_of_date": _pivot("year", tenure=lambda _, opened: tenure.as_of_date(AS_OF, opened)),
        "wealth_by_group": _by_group("year"),
        "wealth_pivot_decimal": _pivot("year", kind={"cents": True}, **CENTS_OPTIONS),
        "wealth_pivot_signed": _pivot("year", sign="trailing", threshold=0),
        "wealth_pivot_inclusive": _pivot("year", inclusive=True, threshold=19999999),
        "wealth_pivot_fractional_threshold": _pivot(
            "year", kind={"cents": True}, money=MONEY, threshold="199999.995"
        ),
        "wealth_pivot_repeated": _pivot("year", people=fixtures.repeated_customers),
        "wealth_pivot_repeated_deduped": _pivot(
            "year", people=fixtures.repeated_customers, dedupe_customers=True
        ),
        "customer_total_repeated": _step(
            wealth.customer_total, people=fixtures.repeated_customers, money=WHOLE_MONEY
        ),
        "high_value_by_product_repeated": _step(
            wealth.high_value_by_product, people=fixtures.repeated_customers, **PIVOT_OPTIONS
        ),
        "wealth_by_group_repeated": _by_group("year", people=fixtures.repeated_customers),
        "wealth_by_group_null_dates": _by_group("year", kind={"null_dates": True}),
        "step_counts_repeated": _step(
            wealth.step_counts, people=fixtures.repeated_customers, **GROUP_OPTIONS
        ),
        "step_counts_calendar": _step(wealth.step_counts, calendar=FIRST_OF_MONTH, **GROUP_OPTIONS),
        "account_projection_decimal": lambda spark, sf: balance_ops.account_projection(
            _balances(spark, sf, "day", cents=True)
        ),
        "tenure_two_centuries": _tenure_two_centuries,
        "calendar_days": _calendar_days(DAILY),
        "calendar_days_leap": _calendar_days(LEAP),
        "wealth_daily_late": _pivot("day", LATE_DAILY, kind={"shift": LATE_SHIFT}),
        "sink_rerun_emptied_date": _sink_rerun_emptied_date,
        "wealth_first_of_month": _by_group("month", FIRST_OF_MONTH),
        "wealth_day31": _pivot("day", DAY31),
        "wealth_day31_compat_v2": _pivot("day", DAY31, tenure=tenure.compat_v2),
        "wealth_daily": _pivot("day", DAILY),
        "wealth_daily_compat_v3": _pivot("day", DAILY, tenure=tenure.compat_v3),
        "lookback_window": _lookback_window,
        "lookback_balance": _lookback(),
        "lookback_balance_precedence": _lookback_precedence,
        "lookback_interest_free": _lookback_group("interest_free"),
        "lookback_short_term": _lookback_group("short_term"),
        "lookback_term": _lookback_group("term"),
        "step_counts": _step(wealth.step_counts, **GROUP_OPTIONS),
        "wealth_export_strings": lambda spark, sf: wealth.export_strings(_yearly_pivot(spark, sf)),
        "sql_view_balance": _sql_view_balance,
        "sink_parquet_append": _sink_parquet_append,
        "sink_parquet_ignore": _sink_parquet_mode("ignore"),
        "sink_parquet_overwrite": _sink_parquet_mode("overwrite"),
        "sink_parquet_dynamic_overwrite": _sink_parquet_dynamic_overwrite,
        "sink_csv_append": _sink_csv_append,
        "sink_table_insert": _sink_table_insert,
    }


# --- SQL oracles -----------------------------------------------------------
# Written from the meaning of the reports: the account rows are joined with the
# customer rows first and summed afterwards, and the calendar is a joined table.

def _sql_customers(first_year: int = 80, name: str = "customers") -> str:
    return f"""
{name} AS (
  SELECT CAST(c_custkey AS VARCHAR) AS custno,
         CASE WHEN c_nationkey = 0 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN '02' ELSE '01' END
           AS cust_type,
         lpad(CAST(({first_year} + c_custkey % 17) % 100 AS VARCHAR), 2, '0')
           || lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0')
           || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS date_opened
  FROM customer)"""


_CUSTOMERS = _sql_customers()

_REPEATED = (
    _sql_customers(name="single")
    + """,
customers AS (
  SELECT * FROM single
  UNION ALL
  SELECT custno, cust_type,
         CAST(CAST(substring(date_opened, 1, 2) AS INTEGER) + 1 AS VARCHAR) || substring(date_opened, 3, 4)
  FROM single WHERE CAST(custno AS BIGINT) % 10 = 0
  UNION ALL
  SELECT * FROM single WHERE CAST(custno AS BIGINT) % 10 = 1
  UNION ALL
  SELECT custno, '02', date_opened FROM single WHERE CAST(custno AS BIGINT) % 10 = 2)"""
)

# One row a customer, the latest opening among the types that count.
_DEDUPED = _REPEATED.replace("\ncustomers AS", "\nevery AS") + """,
customers AS (
  SELECT custno, '01' AS cust_type, max(date_opened) AS date_opened
  FROM every WHERE cust_type <> '02' GROUP BY custno)"""

_PLAIN = {"shift": 604, "cents": False, "null_dates": False, "money": "BIGINT", "sign": "ignore"}


def _sql_snapshot(grain: str, kind: dict) -> str:
    year = f"CAST(year(o_orderdate) - {kind['shift']} AS VARCHAR)"
    month, day = (f"lpad(CAST({part}(o_orderdate) AS VARCHAR), 2, '0')" for part in ("month", "day"))
    text = {"day": f"{year} || {month} || {day}", "month": f"{year} || {month} || '01'", "year": f"{year} || '0101'"}
    return f"CASE WHEN l_orderkey % 10 <> 3 THEN {text[grain]} END" if kind["null_dates"] else text[grain]


def _sql_calendar(leap_years: tuple[int, ...] = ()) -> str:
    leap = "".join(f" + (y = {year}) :: INTEGER" for year in leap_years)
    return f"""
calendar AS (
  SELECT CAST(y * 10000 + m * 100 + d AS VARCHAR) AS snapshot,
         CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, CAST(d AS INTEGER) AS day
  FROM range(1391, 1410) AS ys(y), range(1, 13) AS ms(m), range(1, 32) AS ds(d)
  WHERE d <= CASE WHEN m <= 6 THEN 31 WHEN m <= 11 THEN 30 ELSE 29{leap} END)"""


def _sql_balances(grain: str, kind: dict) -> str:
    cast = "CAST(round(l_extendedprice, 2) AS DECIMAL(18, 2))" if kind["cents"] else "CAST(round(l_extendedprice * 100) AS BIGINT)"
    return f"""
balances AS (
  SELECT CAST(o_custkey AS VARCHAR) AS custno,
         lpad(CAST((l_linenumber + l_orderkey) % 8 + 1 AS VARCHAR), 2, '0')
           || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS acno,
         CAST({cast} AS VARCHAR) || CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS remaining,
         {_sql_snapshot(grain, kind)} AS snapshot
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _sql_accounts(dates: str, kind: dict) -> str:
    sign = "CASE WHEN remaining LIKE '%-' THEN -1 ELSE 1 END * " if kind["sign"] == "trailing" else ""
    return f"""
accounts AS (
  SELECT custno, acno, substring(acno, 1, 2) AS product,
         CAST({sign}CAST(substring(remaining, 1, length(remaining) - 1) AS {kind["money"]}) AS {kind["money"]}) AS amount,
         snapshot
  FROM balances {dates})"""


_DATES = "WHERE snapshot IN (SELECT snapshot FROM calendar WHERE snapshot BETWEEN '{0}' AND '{1}'{2})"


def _on(calendar: Calendar) -> str:
    day = "" if calendar.day is None else f" AND day = {int(calendar.day)}"
    return _DATES.format(calendar.first, calendar.last, day)


def _sql(grain: str, select: str, *ctes: str, dates: str = "", people: str = _CUSTOMERS, leap=(), **kind) -> str:
    kind = {**_PLAIN, **kind}
    head = [people, _sql_balances(grain, kind), _sql_calendar(leap), _sql_accounts(dates, kind), *ctes]
    return f"WITH {','.join(head)}\n{select}"


_OPENED = (
    "36500 * CAST(substring('13' || date_opened, 1, 4) AS BIGINT)"
    " + 3042 * CAST(substring(date_opened, 3, 2) AS BIGINT)"
    " + 100 * CAST(substring(date_opened, 5, 2) AS BIGINT)"
)
_TENURE_SNAPSHOT = (
    "(36500 * CAST(substring(snapshot, 1, 4) AS BIGINT) + 3042 * CAST(substring(snapshot, 5, 2) AS BIGINT)"
    f" + 100 * CAST(substring(snapshot, 7, 2) AS BIGINT) - ({_OPENED})) // 100"
)
_TENURE_V3 = (
    "(36500 * CAST(substring(snapshot, 1, 4) AS BIGINT) + 3042 * CAST(substring(snapshot, 3, 2) AS BIGINT)"
    f" + 100 * CAST(substring(date_opened, 5, 2) AS BIGINT) - ({_OPENED})) // 100"
)
_TENURE_CUT = _TENURE_SNAPSHOT.replace(
    "'13' || date_opened", f"CASE WHEN substring(date_opened, 1, 2) < '{CUT_YEAR}' THEN '14' ELSE '13' END || date_opened"
)
_TENURE_DATE = f"(36500 * 2018 + 3042 * 4 + 100 * 21 - 22674626 - ({_OPENED})) // 100"

_TOTALS = """
totals AS (
  SELECT a.custno, a.snapshot, c.date_opened, CAST(sum(a.amount) AS BIGINT) AS total
  FROM accounts a LEFT JOIN customers c ON a.custno = c.custno
  WHERE c.cust_type <> '02'
  GROUP BY a.custno, a.snapshot, c.date_opened)"""


def _by_product(tenure_sql: str, test: str = "> 19999999", money: str = "BIGINT") -> str:
    return f"""
aged AS (SELECT custno, snapshot, total, {tenure_sql} AS tenure_days FROM totals),
by_product AS (
  SELECT a.custno, a.snapshot, a.product, CAST(sum(a.amount) AS {money}) AS balance,
         CAST(max(t.tenure_days) AS BIGINT) AS tenure_days
  FROM accounts a JOIN aged t ON a.custno = t.custno AND a.snapshot = t.snapshot
  WHERE t.total {test}
  GROUP BY a.custno, a.snapshot, a.product)"""


_PIVOT = """
SELECT custno, snapshot,
       CAST(sum(CASE WHEN product IN ('01', '03') THEN balance END) AS BIGINT) AS interest_free,
       CAST(sum(CASE WHEN product = '02' THEN balance END) AS BIGINT) AS short_term,
       CAST(sum(CASE WHEN product IN ('04', '05') THEN balance END) AS BIGINT) AS term,
       CAST(max(tenure_days) AS BIGINT) AS tenure_days
FROM by_product GROUP BY custno, snapshot"""

_GROUPS = "".join(
    f""",
{name} AS (
  SELECT custno, snapshot, CAST(sum(amount) AS BIGINT) AS balance FROM accounts
  WHERE product IN ({codes}) GROUP BY custno, snapshot)"""
    for name, codes in (("gf", "'01', '03'"), ("gs", "'02'"), ("gt", "'04', '08'"))
)[2:]

_BY_GROUP = f"""
SELECT c.custno, coalesce(gs.snapshot, gt.snapshot, gf.snapshot) AS snapshot,
       gf.balance AS interest_free, gs.balance AS short_term, gt.balance AS term,
       CAST({_TENURE_DATE} AS BIGINT) AS tenure_days
FROM customers c
LEFT JOIN gs ON c.custno = gs.custno
LEFT JOIN gt ON c.custno = gt.custno AND gt.snapshot = gs.snapshot
LEFT JOIN gf ON c.custno = gf.custno AND gf.snapshot = gs.snapshot
WHERE gf.balance + gs.balance + gt.balance >= 20000000"""

_STRINGS = """
SELECT custno, CAST(interest_free AS VARCHAR) AS interest_free, CAST(short_term AS VARCHAR) AS short_term,
       CAST(term AS VARCHAR) AS term, CAST(tenure_days AS VARCHAR) AS tenure_days, snapshot
FROM pivoted"""


def _sql_pivot(
    grain: str,
    calendar: Calendar | None = None,
    tenure_sql: str = _TENURE_SNAPSHOT,
    select: str = _PIVOT,
    test: str = "> 19999999",
    **kind,
) -> str:
    dates = "" if calendar is None else _on(calendar)
    money = kind.get("money", "BIGINT")
    ctes = [_TOTALS.replace("BIGINT", money), _by_product(tenure_sql, test, money)]
    # The tenure stays a whole number whatever the money is.
    select = select.replace("balance END) AS BIGINT", f"balance END) AS {money}")
    return _sql(grain, select, *ctes, dates=dates, **kind)


def _sql_by_group(grain: str, calendar: Calendar | None = None, **kind) -> str:
    dates = "" if calendar is None else _on(calendar)
    return _sql(grain, _BY_GROUP, _GROUPS, dates=dates, **kind)


def _sql_days(calendar: Calendar) -> str:
    return _sql(
        "day",
        f"""
SELECT c.snapshot, c.year, c.month, c.day, count(b.custno) AS n_rows
FROM calendar c LEFT JOIN balances b ON c.snapshot = b.snapshot
WHERE c.snapshot BETWEEN '{calendar.first}' AND '{calendar.last}'
GROUP BY c.snapshot, c.year, c.month, c.day""",
        leap=calendar.leap_years,
    )


def _sql_group_balance(codes: str) -> str:
    return _sql(
        "year",
        "SELECT custno, snapshot, CAST(sum(amount) AS BIGINT) AS balance FROM accounts"
        f" WHERE product IN ({codes}) GROUP BY custno, snapshot",
    )


def _sql_tenure_on_snapshots(formula: str) -> str:
    return _sql(
        "day",
        f"SELECT custno, snapshot, CAST({formula} AS BIGINT) AS tenure_days"
        " FROM (SELECT DISTINCT custno, snapshot FROM balances) JOIN customers USING (custno)",
    )


_WINDOW = "snapshot BETWEEN '13961131' AND '13970231'"


def _sql_lookback(free: str, short: str, term: str) -> str:
    return _sql(
        "day",
        f"""
SELECT custno,
       CAST(sum(CASE WHEN {free} THEN amount END) AS BIGINT) AS interest_free,
       CAST(sum(CASE WHEN {short} THEN amount END) AS BIGINT) AS short_term,
       CAST(sum(CASE WHEN {term} THEN amount END) AS BIGINT) AS term
FROM accounts WHERE ({free}) OR ({short}) OR ({term}) GROUP BY custno""",
    )


def _sql_lookback_group(codes: str) -> str:
    return _sql(
        "day",
        "SELECT custno, CAST(sum(amount) AS BIGINT) AS balance FROM accounts"
        f" WHERE product IN ({codes}) AND {_WINDOW} GROUP BY custno",
    )


def _sql_steps(calendar: Calendar | None = None, **kind) -> str:
    dates, of = "", "(SELECT DISTINCT snapshot FROM accounts)"
    if calendar is not None:
        dates = _on(calendar)
        of = f"(SELECT snapshot FROM calendar {dates.replace('FROM calendar', 'FROM calendar AS c')})"
    tables = {"interest_free": "gf", "short_term": "gs", "term": "gt", "result": "result"}
    steps = [
        f"SELECT s.snapshot, '{step}' AS step, (SELECT count(*) FROM {name} t WHERE t.snapshot = s.snapshot) AS n FROM {of} s"
        for step, name in tables.items()
    ]
    steps.append(f"SELECT s.snapshot, 'tenure', (SELECT count(*) FROM customers) FROM {of} s")
    select = f"SELECT snapshot, step, CAST(n AS BIGINT) AS n FROM ({' UNION ALL '.join(steps)})"
    return _sql("year", select, _GROUPS, f"\nresult AS ({_BY_GROUP})", dates=dates, **kind)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express, same keys and column names."""
    found = {**_report_oracles(), **({} if corpus is None else corpus.ORACLES)}
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _report_oracles() -> dict[str, str]:
    pivot = _sql_pivot("year")
    strings = _sql(
        "year", _STRINGS, _TOTALS, _by_product(_TENURE_SNAPSHOT), f"\npivoted AS ({_PIVOT})"
    )
    return {
        "balance_scan_profile": _sql(
            "day",
            "SELECT count(*) AS n_rows, count(DISTINCT custno) AS n_customers,"
            " count(*) FILTER (WHERE try_cast(substring(remaining, 1, length(remaining) - 1) AS DOUBLE) IS NULL)"
            " AS n_unreadable,"
            " min(snapshot) AS min_snapshot, max(snapshot) AS max_snapshot FROM balances",
        ),
        "customer_scan_profile": _sql(
            "day",
            "SELECT count(*) AS n_rows, count(*) FILTER (WHERE cust_type IS NULL) AS n_null_type FROM customers",
        ),
        "account_projection": _sql("day", "SELECT custno, acno, product, amount, snapshot FROM accounts"),
        "prod_balance_interest_free": _sql_group_balance("'01', '03'"),
        "prod_balance_short_term": _sql_group_balance("'02'"),
        "prod_balance_term": _sql_group_balance("'04', '08'"),
        "tenure_as_of_date": _sql(
            "day", f"SELECT custno, CAST({_TENURE_DATE} AS BIGINT) AS tenure_days FROM customers"
        ),
        "tenure_compat_v2": _sql("day", "SELECT custno, CAST(NULL AS BIGINT) AS tenure_days FROM customers"),
        "tenure_compat_v3": _sql_tenure_on_snapshots(_TENURE_V3),
        "tenure_as_of_snapshot": _sql_tenure_on_snapshots(_TENURE_SNAPSHOT),
        "customer_total": _sql("year", "SELECT custno, snapshot, date_opened, total FROM totals", _TOTALS),
        "high_value_by_product": _sql_pivot(
            "year", select="SELECT custno, snapshot, product, balance, tenure_days FROM by_product"
        ),
        "high_value_customers": _sql_pivot("year", select="SELECT DISTINCT custno, snapshot FROM by_product"),
        "wealth_pivot": pivot,
        "wealth_pivot_deduped": pivot,
        "wealth_pivot_one_date": _sql_pivot("year", ONE_DATE),
        "wealth_pivot_as_of_date": _sql_pivot("year", tenure_sql=_TENURE_DATE),
        "wealth_by_group": _sql_by_group("year"),
        "calendar_days": _sql_days(DAILY),
        "calendar_days_leap": _sql_days(LEAP),
        "wealth_pivot_decimal": _sql_pivot("year", test="> 199999.99", cents=True, money="DECIMAL(38, 2)"),
        "wealth_pivot_signed": _sql_pivot("year", test="> 0", sign="trailing"),
        "wealth_pivot_inclusive": _sql_pivot("year", test=">= 19999999"),
        "wealth_pivot_fractional_threshold": _sql_pivot(
            "year", test="> 199999.995", cents=True, money="DECIMAL(38, 2)"
        ),
        "wealth_pivot_repeated": _sql_pivot("year", people=_REPEATED),
        "wealth_pivot_repeated_deduped": _sql_pivot("year", people=_DEDUPED),
        "customer_total_repeated": _sql(
            "year", "SELECT custno, snapshot, date_opened, total FROM totals", _TOTALS, people=_REPEATED
        ),
        "high_value_by_product_repeated": _sql_pivot(
            "year", select="SELECT custno, snapshot, product, balance, tenure_days FROM by_product", people=_REPEATED
        ),
        "wealth_by_group_repeated": _sql_by_group("year", people=_REPEATED),
        "wealth_by_group_null_dates": _sql_by_group("year", null_dates=True),
        "step_counts_repeated": _sql_steps(people=_REPEATED),
        "step_counts_calendar": _sql_steps(FIRST_OF_MONTH),
        "account_projection_decimal": _sql(
            "day",
            "SELECT custno, acno, product, amount, snapshot FROM accounts",
            cents=True,
            money="DECIMAL(38, 2)",
        ),
        "tenure_two_centuries": _sql(
            "day",
            f"""
SELECT custno, snapshot, date_opened, CAST({_TENURE_CUT} AS BIGINT) AS tenure_days
FROM (SELECT DISTINCT custno, snapshot FROM balances) JOIN customers USING (custno)""",
            people=_sql_customers(90),
        ),
        "wealth_daily_late": _sql_pivot("day", LATE_DAILY, shift=LATE_SHIFT),
        "sink_rerun_emptied_date": _sql_pivot("year", select=f"SELECT * FROM ({_PIVOT}) WHERE snapshot <> '13960101'"),
        "wealth_first_of_month": _sql_by_group("month", FIRST_OF_MONTH),
        "wealth_day31": _sql_pivot("day", DAY31),
        "wealth_day31_compat_v2": _sql_pivot("day", DAY31, "CAST(NULL AS BIGINT)"),
        "wealth_daily": _sql_pivot("day", DAILY),
        "wealth_daily_compat_v3": _sql_pivot("day", DAILY, _TENURE_V3),
        "lookback_window": _sql(
            "day",
            f"""
SELECT DISTINCT CASE WHEN substring(snapshot, 5, 2) <= '03'
         THEN CAST(CAST(substring(snapshot, 1, 4) AS INTEGER) - 1 AS VARCHAR)
           || lpad(CAST(CAST(substring(snapshot, 5, 2) AS INTEGER) + 9 AS VARCHAR), 2, '0')
         ELSE substring(snapshot, 1, 4)
           || lpad(CAST(CAST(substring(snapshot, 5, 2) AS INTEGER) - 3 AS VARCHAR), 2, '0') END
         || substring(snapshot, 7, 2) AS from_h,
       snapshot AS to_h
FROM balances {_on(LOOKBACK)}""",
        ),
        "lookback_balance": _sql_lookback(
            f"product IN ('01', '03') AND {_WINDOW}",
            f"product = '02' AND {_WINDOW}",
            f"product IN ('04', '08') AND {_WINDOW}",
        ),
        "lookback_balance_precedence": _sql_lookback(
            f"product = '01' OR product = '03' AND {_WINDOW}",
            f"product = '02' AND {_WINDOW}",
            f"product = '04' OR product = '08' AND {_WINDOW}",
        ),
        "lookback_interest_free": _sql_lookback_group("'01', '03'"),
        "lookback_short_term": _sql_lookback_group("'02'"),
        "lookback_term": _sql_lookback_group("'04', '08'"),
        "step_counts": _sql_steps(),
        "wealth_export_strings": strings,
        "sql_view_balance": _sql(
            "year",
            """
SELECT a.custno, a.snapshot, c.cust_type, CAST(sum(a.amount) AS BIGINT) AS balance
FROM accounts a JOIN customers c ON a.custno = c.custno
WHERE a.snapshot = '13960101' AND a.product = '02'
GROUP BY a.custno, a.snapshot, c.cust_type""",
        ),
        "sink_parquet_append": pivot,
        "sink_parquet_ignore": _sql_pivot("year", EARLY),
        "sink_parquet_overwrite": pivot,
        "sink_parquet_dynamic_overwrite": pivot,
        "sink_csv_append": strings,
        "sink_table_insert": strings,
    }
