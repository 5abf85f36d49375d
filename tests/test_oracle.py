"""Every registered query with SQL against DuckDB over the same tables."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

from framewell import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.7g}") + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    sql = catalog.oracle_sql().get(name)
    if not sql:
        assert rows or name in ("t10_rate_limit",)
        return
    rel = duck.sql(sql)
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=str)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 4 and set(e.oracle_sql()) <= set(e.queries()) and Path(e.__file__).exists()
