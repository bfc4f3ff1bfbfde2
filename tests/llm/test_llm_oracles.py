"""The SQL of the numbered queries against DuckDB on the small tables; skipped where they are absent."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from chatloom.llm.queries import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")


def plain(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.skipif(not DATA.exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = sorted("|".join(map(plain, r)) for r in df.select(*cols).collect())
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    assert got == sorted("|".join(map(plain, r)) for r in want)
