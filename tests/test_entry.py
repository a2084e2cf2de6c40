"""The driver contract and its oracles, on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return f"{v:.4f}"
    return "[" + ",".join(map(shown, v)) + "]" if isinstance(v, list | tuple) else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.QUERIES[name](spark, SF)
    cur = db.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(shown(r[names.index(c)]) for c in sorted(names)) for r in cur.fetchall())
    got = sorted(tuple(shown(r[c]) for c in sorted(names)) for r in df.collect())
    assert got == want


def test_entry_and_names(spark):
    found = entry.entry(spark)
    assert found.columns == registry.QUERIES["stories"](spark, SF).columns and found.where("outlet_count < 2").count() == 0 < found.count()
    assert set(entry.oracle_sql()) <= set(entry.queries())
