"""Small input tables and a by-the-book evaluation of the reports in Python."""

from __future__ import annotations

from collections import defaultdict
from fractions import Fraction

BALANCE_SCHEMA = "custno string, acno string, remaining string, snapshot string"
CUSTOMER_SCHEMA = "custno string, cust_type string, date_opened string"


def balances(spark, rows):
    return spark.createDataFrame(rows, BALANCE_SCHEMA)


def customers(spark, rows):
    return spark.createDataFrame(rows, CUSTOMER_SCHEMA)


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*(columns or frame.columns)).collect()), key=repr)


def number(text):
    try:
        return int(text[:-1])
    except (TypeError, ValueError):
        return None


def add(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def truncated(days: Fraction) -> int:
    return int(days)


def point(year: str, month: str, day: str) -> Fraction:
    return Fraction(int(year)) * 365 + Fraction(int(month)) * Fraction("30.42") + int(day)


def tenure(snapshot, opened):
    if opened is None:
        return None
    seen = point(snapshot[:4], snapshot[4:6], snapshot[6:8])
    return truncated(seen - point("13" + opened[:2], opened[2:4], opened[4:6]))


def pivot_one_date(balance_rows, customer_rows, date, threshold, groups):
    """The pivot report of one date, join by join, on Python lists."""
    day = [r for r in balance_rows if r[3] == date and r[0] is not None]
    joined = defaultdict(list)
    for custno, _, remaining, _ in day:
        for other, kind, opened in customer_rows:
            if other == custno and kind is not None and kind != "02":
                joined[custno, opened].append(number(remaining))
    totals = {key: add(values) for key, values in joined.items()}
    by_product = defaultdict(list)
    for custno, acno, remaining, _ in day:
        for (other, opened), total in totals.items():
            if other == custno and total is not None and total > threshold:
                by_product[custno, acno[:2]].append((number(remaining), tenure(date, opened)))
    result = {}
    for custno in {custno for custno, _ in by_product}:
        mine = {product: pairs for (other, product), pairs in by_product.items() if other == custno}
        sums = [
            add([add([a for a, _ in mine[code]]) for code in codes if code in mine]) for codes in groups.values()
        ]
        ages = [t for pairs in mine.values() for _, t in pairs if t is not None]
        result[custno] = (custno, date, *sums, max(ages) if ages else None)
    return list(result.values())


def by_group_one_date(balance_rows, customer_rows, date, threshold, groups, tenure_of):
    """The group report of one date on Python lists."""
    sums = defaultdict(dict)
    for name, codes in groups.items():
        found = defaultdict(list)
        for custno, acno, remaining, snapshot in balance_rows:
            if snapshot == date and acno[:2] in codes:
                found[custno].append(number(remaining))
        for custno, values in found.items():
            sums[custno][name] = add(values)
    result = []
    for custno, _, opened in customer_rows:
        parts = [sums.get(custno, {}).get(name) for name in groups]
        if custno is not None and None not in parts and sum(parts) >= threshold:
            result.append((custno, date, *parts, tenure_of(opened)))
    return result
