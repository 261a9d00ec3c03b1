"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import differences, sql_engine

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return sql_engine(FOLDER)


def _names():
    from agrometry.plans import oracle

    return sorted(oracle.sql())


def test_every_query_has_sql():
    from agrometry.plans import catalogue

    assert sorted(catalogue.queries()) == _names()
    assert set(_names()) <= set(contract.queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_sql(spark, engine, name):
    assert differences(contract.queries()[name](spark, FOLDER), engine, contract.oracle_sql()[name]) == []


def test_entry_runs(spark):
    assert contract.entry(spark).columns[-1] == "classificacao_risco"
