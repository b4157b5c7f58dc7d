"""Every bound query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as bound
import oracle
from rollcall.suite import registry

FOLDER = os.environ.get("ROLLCALL_TEST_TABLES", "/root/testdata/sf0.001")
QUERIES, SQL = registry.queries(), registry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"no tables at {FOLDER}")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(bound.queries()) and set(SQL) <= set(bound.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_same_rows(spark, con, key):
    difference = oracle.compare(QUERIES[key](spark, FOLDER), con, SQL[key])
    assert difference is None, f"{key}: {difference}"


def test_entry(spark):
    rows = bound.entry(spark).collect()
    assert [r.setor for r in rows] and rows == sorted(rows, key=lambda r: -r.mediana)


def test_quarantine_accounts_for_every_head_office(spark):
    counts = {
        key: QUERIES[key](spark, FOLDER).count()
        for key in ("filter_head_office", "quarantine_rows", "gold_build")
    }
    # Every establishment of these tables has its entity, so nothing else can be lost.
    assert counts["filter_head_office"] == counts["quarantine_rows"] + counts["gold_build"]
