"""Extract lifecycle, table choice by interval, load-order sort (SRT-3),
created_at default (PRJ-5), backfill estimate (SRC-3) and time-zone independence."""

from __future__ import annotations

import datetime as dt
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF01, candles_df
from wickline.functions.convert import default_created_at
from wickline.operators.slices import backfill_estimate, plan_pages
from wickline.plans.extract import land_pages, read_pages
from wickline.plans.store import CandleStore, newest_load_first
from wickline.streaming.ingest import run_once

PAGE = [
    [1704067200000, "1.5", "2.0", "1.0", "1.75", "10", 1704067259999, "15", 3, "5", "7.5", "0"],
    [1704067260000, "1.75", "2.5", "1.5", "2.25", "20", 1704067319999, "45", 4, "10", "22.5", "0"],
]


def test_extract_then_load(spark, workdir):
    pages = f"{workdir}/pages"
    os.makedirs(pages)
    with open(f"{pages}/p.jsonl", "w") as f:
        f.write(json.dumps({"symbol": "ETHUSDT", "payload": json.dumps(PAGE)}) + "\n")
        f.write(json.dumps({"symbol": "BTCUSDT", "payload": json.dumps(PAGE[:1])}) + "\n")
        f.write(json.dumps({"symbol": "XRPUSDT", "payload": "[]"}) + "\n")
    out = land_pages(read_pages(spark, pages), f"{workdir}/landing", dt.datetime(2024, 1, 1, 1))
    assert sorted(d for d in os.listdir(out) if d.startswith("pair=")) == ["pair=BTCUSDT", "pair=ETHUSDT"]
    store = CandleStore(spark, f"{workdir}/tables")
    run_once(spark, f"{workdir}/landing", store, f"{workdir}/ckpt")
    rows = store.latest().orderBy("symbol", "open_time").collect()
    assert [(r.symbol, r.close_price) for r in rows] == [("BTCUSDT", 1.75), ("ETHUSDT", 1.75), ("ETHUSDT", 2.25)]
    assert rows[0].open_time == dt.datetime(2024, 1, 1, 0, 0)


def test_slice_interval_picks_table(spark, workdir):
    store = CandleStore(spark, workdir)
    rows = [("A", dt.datetime(2025, 3, 1, 0, m), m) for m in range(0, 20)]
    store.append(candles_df(spark, rows), now=dt.datetime(2025, 3, 2))
    store.refresh_rollup("5 minutes")
    base = store.slice("A", dt.datetime(2025, 3, 1), dt.datetime(2025, 3, 1, 1), limit=100)
    five = store.slice("A", dt.datetime(2025, 3, 1), dt.datetime(2025, 3, 1, 1), limit=100, interval="5 minutes")
    assert base.count() == 20
    assert [r.open_price for r in five.collect()] == [4.0, 9.0, 14.0, 19.0]
    assert [r.open_price for r in store.slice("A", interval="5m").collect()] == [4.0, 9.0, 14.0, 19.0]
    assert [r.open_price for r in store.slice("A", limit=2).collect()] == [18.0, 19.0]  # neither bound: the latest
    assert store.slice("A", interval="1m").count() == 20
    empty = store.slice("A", interval="4h")
    assert empty.count() == 0 and empty.columns == base.columns
    for name in ("2x", "", "m", "0m"):
        with pytest.raises(ValueError):
            store.slice("A", interval=name)


def test_newest_load_first_and_created_at_default(spark, workdir):
    store = CandleStore(spark, workdir)
    store.append(candles_df(spark, [("A", dt.datetime(2025, 1, 1), 1)]), now=dt.datetime(2025, 1, 2))
    store.append(candles_df(spark, [("A", dt.datetime(2025, 1, 1), 2)]), now=dt.datetime(2025, 1, 3))
    hist = newest_load_first(store.history()).collect()
    assert [r.open_price for r in hist] == [2.0, 1.0]
    df = candles_df(spark, [("A", dt.datetime(2025, 1, 1), 1)], None).union(
        candles_df(spark, [("B", dt.datetime(2025, 1, 1), 1)], dt.datetime(2020, 1, 1))
    )
    got = {r.symbol: r.created_at for r in default_created_at(df).collect()}
    assert got["B"] == dt.datetime(2020, 1, 1) and got["A"] > dt.datetime(2024, 1, 1)
    assert default_created_at(df.drop("created_at")).filter(F.col("created_at").isNull()).count() == 0


def test_backfill_estimate_matches_readme_arithmetic(spark):
    ranges = spark.createDataFrame(
        [("BTCUSDT", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=788400))],
        "symbol string, start timestamp_ntz, `end` timestamp_ntz",
    )
    pages = plan_pages(ranges, "1 minute", 500)
    est = backfill_estimate(pages, 20).first()
    assert (est.requests, est.candles) == (1577, 788400)
    assert est.seconds == pytest.approx(78.85)
    first, last = pages.orderBy("page").first(), pages.orderBy(F.col("page").desc()).first()
    assert first.page_start == dt.datetime(2024, 1, 1) and last.candles == 400


@pytest.mark.parametrize(
    "name", ["rollup_5min", "rollup_4h", "incremental_rollup", "ticker_projection", "rest_roundtrip", "page_plan", "month_counts", "slice_checks"]
)
def test_results_do_not_depend_on_session_zone(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF01}/events.parquet')")
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = sorted(tuple(str(r[cols.index(c)]) for c in sorted(cols)) for r in res.fetchall())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = entry.queries()[name](spark, SF01)
            got = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
            assert got == want, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_flag_candles_and_stamp_format(spark):
    from wickline.functions.time import stamp_format
    from wickline.operators.quality import flag_candles

    df = candles_df(spark, [("A", dt.datetime(2025, 1, 1, 12, 30, 5, 123456), 1)], dt.datetime(2025, 1, 2))
    bad = df.withColumn("number_of_trades", F.lit(-1).cast("long"))
    r = flag_candles(bad).first()
    assert (r.ok_time_order, r.ok_low_le_high, r.ok_trades_non_negative, r.ok_volume_non_negative) == (True, True, False, True)
    assert df.select(stamp_format("open_time").alias("s")).first().s == "20250101123005123456"


def test_sql_views(spark, workdir):
    store = CandleStore(spark, workdir)
    rows = [("A", dt.datetime(2025, 3, 1, 0, m), m) for m in range(0, 10)]
    store.append(candles_df(spark, rows), now=dt.datetime(2025, 3, 2))
    store.append(candles_df(spark, rows[:3]), now=dt.datetime(2025, 3, 3))
    store.refresh_rollup("5 minutes")
    made = store.register_views("t", ["5 minutes"])
    assert set(made) == {"t_latest", "t_history", "t_5minutes"}
    got = spark.sql(
        "SELECT (SELECT count(*) FROM t_latest) AS latest, (SELECT count(*) FROM t_history) AS history, "
        "(SELECT max(close_price) FROM t_5minutes WHERE symbol = 'A') AS last_close"
    ).first()
    assert (got.latest, got.history, got.last_close) == (10, 13, 9.0)


def test_epoch_millis_in_a_skipped_hour(spark):
    from wickline.functions.time import from_epoch_millis, to_epoch_micros, to_epoch_millis, truncate_second
    from pyspark.sql import functions as F

    start = dt.datetime(2024, 1, 1)
    times = [start + dt.timedelta(hours=h, minutes=30, microseconds=123457) for h in range(0, 366 * 24)] + [dt.datetime(1969, 12, 31, 23, 59, 59, 999500)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Europe/Berlin", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(str(t),) for t in times], "t string").select(F.to_timestamp_ntz("t").alias("t"))
            df = df.select("t", to_epoch_millis("t").alias("ms"), to_epoch_micros("t").alias("us"), from_epoch_millis(to_epoch_millis("t")).alias("back"), truncate_second("t").alias("s"))
            for r in df.collect():
                us = round((r.t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
                assert (r.us, r.ms) == (us, us // 1000), (zone, r)
                assert r.back == dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=us // 1000)
                assert r.s == r.t.replace(microsecond=0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
