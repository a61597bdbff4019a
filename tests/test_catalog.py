"""Every catalogue query against its oracle SQL on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def comparable(rows, order):
    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else repr(round(v, 9) + 0.0)
        return None if v is None else str(v)
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_oracle(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    names = sorted(columns)
    assert comparable(df.collect(), [df.columns.index(c) for c in names]) == comparable(cursor.fetchall(), [columns.index(c) for c in names])


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
