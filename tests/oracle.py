"""Compare a Spark result with the oracle's, cell by cell."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return con


def _order(row):
    return tuple((v is not None, str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def assert_equal(df, con, sql: str) -> int:
    result = con.execute(sql)
    names = sorted(d[0] for d in result.description)
    assert sorted(df.columns) == names
    at = [[d[0] for d in result.description].index(n) for n in names]
    want = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=_order)
    got = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_order)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all(map(_same, g, w)), f"{dict(zip(names, g))} != {dict(zip(names, w))}"
    return len(got)
