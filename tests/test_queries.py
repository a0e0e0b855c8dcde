"""Every query with an oracle, against DuckDB at the smallest scale; and the driver contract."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = {k: v for k, v in entry.oracle_sql().items() if not k.startswith("op") and k != "pipeline"}
OTHERS = [k for k in entry.queries() if not k.startswith("op") and k != "pipeline" and k not in ORACLES]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = [list(want.columns).index(c) for c in columns]
    rows = sorted("|".join(plain(r[c]) for c in columns) for r in got.collect())
    assert rows == sorted("|".join(plain(r[i]) for i in order) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(OTHERS))
def test_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
