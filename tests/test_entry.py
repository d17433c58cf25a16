"""Every registered query against its SQL oracle, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check_oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


def test_every_query_has_an_oracle():
    reports = entry._report_queries()
    assert set(reports) == set(entry._report_oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["custno", "snapshot", "interest_free", "short_term", "term", "tenure_days"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", entry._report_queries())
def test_query_equals_oracle(spark, con, name):
    same, note = check_oracle.compare(spark, con, SF, name)
    assert same, note
