"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, normal

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(normal(row[c]) for c in columns) for row in df.collect())
    result = duck.execute(entry_module.oracle_sql()[name])
    heads = [d[0] for d in result.description]
    assert sorted(heads) == columns
    index = [heads.index(c) for c in columns]
    expected = sorted(tuple(normal(row[i]) for i in index) for row in result.fetchall())
    assert got == expected


def test_entry_gives_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["gse", "ctrl_cluster", "pert_cluster", "ctrl_gsm_ids", "pert_gsm_ids", "microarray_grouping"]
    for row in df.collect():
        assert set(row["microarray_grouping"]) <= set("X01")
        assert row["microarray_grouping"].count("0") == len(row["ctrl_gsm_ids"].split("|"))
        assert row["microarray_grouping"].count("1") == len(row["pert_gsm_ids"].split("|"))
