"""Every query against its SQL counterpart in DuckDB, on the smallest tables."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest
from lamina.plans import registry

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return float(value) if isinstance(value, Decimal) else value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    found = registry.QUERIES[name](spark, str(DATA))
    rows = found.collect()
    assert rows
    if name in registry.ORACLES:
        wanted = duck.sql(registry.ORACLES[name])
        assert sorted(found.columns) == sorted(wanted.columns)
        assert rows_of(found.columns, rows) == rows_of(wanted.columns, wanted.fetchall())
