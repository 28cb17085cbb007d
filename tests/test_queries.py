"""Every query with an oracle gives the oracle's rows on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, list | tuple):
        return tuple(map(canon, v))
    return v.replace(tzinfo=None) if getattr(v, "tzinfo", None) else v


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def test_keys():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    cols = sorted(df.columns)
    got = sorted((tuple(canon(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = duck.execute(ORACLE[name])
    names = [x[0] for x in cur.description]
    want = sorted((tuple(canon(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
    assert sorted(names) == cols
    assert got == want
