"""Every query that SQL expresses against DuckDB at sf0.001 and sf0.01."""

from __future__ import annotations

import duckdb
import pytest

from wickline.llm.queries import ORACLE, QUERIES

TABLES = "documents embeddings conversations labels benchmark".split()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    df = QUERIES[name](spark, folder)
    res = con.execute(ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(res.fetchall(), key=repr)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr) == want
