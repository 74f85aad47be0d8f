"""Driver contract: entry() runs; every query matches its oracle SQL on sf0.001."""
import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.queries import REGISTRY

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["uf", "year", "exports", "avg_rate", "population", "gdp", "per_capita"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(REGISTRY) >= 54


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    rows, cols = df.collect(), df.columns
    # JVM-side only: no Python evaluation in the (final, adaptive) plan
    assert "EvalPython" not in df._jdf.queryExecution().executedPlan().toString()
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(cols) == sorted(rel.columns)
    spark_to_duck = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                     "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    assert {c: spark_to_duck.get(t, t) for c, t in df.dtypes} == \
        {c: str(t) for c, t in zip(rel.columns, rel.types)}
    idx = [rel.columns.index(c) for c in cols]
    expected = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert Counter(tuple(_norm(x) for x in r) for r in rows) == expected
