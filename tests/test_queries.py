"""Every registered query against its DuckDB oracle (the driver's check), at sf0.01."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001, SF01

from wickline.plans.queries import ORACLE, QUERIES

TABLES = ["events"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF01)
    got_cols, got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[name])
    want_cols, want = _canon([d[0] for d in res.description], res.fetchall())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["symbol", "open_time"]
    assert df.schema == entry.entry(spark).schema


def test_queries_run_at_smallest_scale(spark):
    for name, fn in QUERIES.items():
        if name.startswith("pipeline_"):
            continue
        assert fn(spark, SF001).count() >= 0


@pytest.fixture(scope="module")
def split_events(spark, tmp_path_factory):
    """The events table dealt anew over unordered files."""
    folder = str(tmp_path_factory.mktemp("split"))
    from pyspark.sql import functions as F

    spark.read.parquet(f"{SF01}/events.parquet").repartition(6, F.xxhash64("event_id")).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_results_do_not_depend_on_the_files(spark, duck, split_events, name):
    df = QUERIES[name](spark, split_events)
    _, got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLE[name])
    _, want = _canon([d[0] for d in res.description], res.fetchall())
    assert got == want


def test_the_late_rollup_is_not_the_full_one(spark):
    late, full = (QUERIES[q](spark, SF01).drop("created_at") for q in ("incremental_rollup_late", "rollup_5min"))
    assert full.exceptAll(late.select(*full.columns)).count() > 0
