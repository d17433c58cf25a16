"""The corpus queries that SQL can express against their SQL."""

import pytest

import check_oracle
from deposit_analytics.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", [name for name in queries.ORACLES if name != "op1_source_mix"])
def test_query_equals_sql(spark, con, name):
    same, note = check_oracle.compare(spark, con, SF, name)
    assert same, note


def test_every_operator_has_its_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
