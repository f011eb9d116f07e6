"""Every registered query against its SQL; queries without SQL must return rows with a stable schema."""

import pytest
from check_oracles import compare, connect

import __spark_entry__ as contract

NAMES = sorted(contract.queries())
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [n for n in NAMES if n in ORACLES])
def test_matches_sql(spark, con, sf, name):
    result, _ = compare(spark, con, name, sf)
    assert result.startswith("ok"), result
    assert "types" not in result, result


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ORACLES])
def test_gives_rows(spark, con, sf, name):
    result, _ = compare(spark, con, name, sf)
    assert result.startswith("rows"), result


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(NAMES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["guid", "continuity", "shows"]
