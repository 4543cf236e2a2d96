"""Every registered query against its SQL counterpart, over whole tables."""

import os

import pytest
from compare import assert_same, connect

from __spark_entry__ import entry
from marketloom.plans.oracle import oracle_sql
from marketloom.plans.queries import queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(name, spark, duck):
    assert assert_same(queries()[name](spark, SF_DIR), duck, oracle_sql()[name]) > 0


def test_entry(spark):
    rows = entry(spark).collect()
    months = [(row["purchase_year"], row["purchase_month"]) for row in rows]
    assert months and months == sorted(months)
