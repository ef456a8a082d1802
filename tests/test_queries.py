"""Registered queries against their SQL, on the smallest input."""

from __future__ import annotations

import duckdb
import pytest
from tools.oracle import TABLES, value
from weftgraph.plans import catalog


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, sf, db, name):
    df = catalog.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    mine = sorted((repr(tuple(value(r[c]) for c in cols)) for r in df.collect()))
    if name in catalog.SQL:
        rel = db.sql(catalog.SQL[name])
        at = {c: i for i, c in enumerate(rel.columns)}
        assert sorted(at) == cols
        assert mine == sorted(repr(tuple(value(r[at[c]]) for c in cols)) for r in rel.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["source", "target", "weight", "shared_contributors", "collaboration_strength"]


def test_queries_have_sql():
    """All but the walks in a fixed order, a hash that SQL lacks, and what differs between engines."""
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"gr3_gr4_gr5_communities", "gr3_synchronous_communities", "gr6_components", "gr10_gr14_island_layout", "sc9_stable_unit", "snk2_sc17_graphml_lines", "src16_identity"}
