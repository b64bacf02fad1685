"""Every registered query against its DuckDB oracle on the sf0.001 tables, plus the row
counts computed independently for the test-data mapping."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from ledgerprofile.plans.catalog import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Row counts at sf0.001 for the fixed parameters (period 199501-199612, ratio 0.2).
EXPECTED_ROWS = {
    "taxpayer_monthly": 651,
    "industry_monthly": 571,
    "tag_foreign_trade": 2,
    "tag_industry_leader": 7,
    "tag_fast_growth": 1,
    "tag_periodic": 1,
    "tag_periodic_lag3": 0,
    "tag_periodic_lag6": 2,
    "tag_supply_core": 35,
}


# column types that count as equal in both engines
KINDS = {"string": "text", "VARCHAR": "text", "double": "double", "DOUBLE": "double", "int": "integer",
         "INTEGER": "integer", "bigint": "integer", "BIGINT": "integer", "date": "date", "DATE": "date",
         "HUGEINT": "integer", "boolean": "boolean", "BOOLEAN": "boolean"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck(sf001):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf001, name):
    df = QUERIES[name](spark, sf001)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    duck.execute(f'CREATE OR REPLACE VIEW "oracle of {name}" AS {oracle_sql()[name]}')   # as the driver may store it
    rel = duck.sql(f'SELECT * FROM "oracle of {name}"')
    want = _rows(rel.fetchall(), rel.columns)
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == want
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: KINDS[t] for c, t in df.dtypes} == {c: KINDS[k] for c, k in kinds.items()}
    if name in EXPECTED_ROWS:
        assert len(got) == EXPECTED_ROWS[name]


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["nsr_key", "bq_key", "bq_value", "bq_start_time", "bq_end_time", "tag_time"]
    assert df.count() > 0
