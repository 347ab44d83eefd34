"""Driver contract: entry runs, every query has an oracle, results agree at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from lakelayer.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["order_year_month", "n_items", "n_orders", "revenue"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert len(QUERIES) >= 44


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19].replace("T", " ")
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    rel = con.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in order) for r in sdf.collect()), key=repr)
    drows = sorted((tuple(_norm(r[dcols.index(c)]) for c in order) for r in rel.fetchall()), key=repr)
    assert srows == drows
    from tools.oracle_check import type_mismatches

    assert type_mismatches(sdf, rel) == []
