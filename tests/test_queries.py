"""Registered queries against their SQL on the smallest given tables."""

from __future__ import annotations

import os

import pytest

from checks import oracles, registry
from checks.compare import database, difference, spark_rows, sql_rows, suspects

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are missing")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracles.all_sql())


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF_DIR)
    assert difference(spark_rows(df), sql_rows(con, oracles.all_sql()[name])) is None
    assert suspects(df) == []


def test_branches_of_the_scope_have_rows(spark):
    c = registry.Context(spark, SF_DIR)
    reasons = {r.razon_inclusion: r.n for r in c.x["proyectos"].groupBy("razon_inclusion")
               .agg({"*": "count"}).toDF("razon_inclusion", "n").collect()}
    assert set(reasons) == {"Por proyecto", "Por contrato"}
    assert sum(reasons.values()) < c.src["proyectos"].count()
    assert c.star["dim_proyectos"].count() < sum(reasons.values())
