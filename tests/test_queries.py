"""Every registered query against its SQL counterpart on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from silverlode.plans.oracles import ORACLES
from silverlode.plans.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    expected = duck.sql(ORACLES[name])
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    got = sorted(tuple(map(plain, row)) for row in df.select(*columns).collect())
    want = sorted(tuple(map(plain, row)) for row in expected.select(*[f'"{c}"' for c in columns]).fetchall())
    assert got == want


def test_every_query_has_a_counterpart():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", ["layer_tables", "quality_gold"])
def test_orders_are_cleaned_once_by_a_query_that_uses_them_often(spark, monkeypatch, name):
    from silverlode.plans import registry

    made = []
    clean = registry.silver.clean_orders
    monkeypatch.setattr(registry.silver, "clean_orders", lambda *args, **options: made.append(1) or clean(*args, **options))
    registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(made) == 1
