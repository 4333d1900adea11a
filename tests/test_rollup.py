"""Rollup semantics (AGG-1..3), the incremental high water (FLT-3, T2, T3) and upsert (DED-4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF01, candles_df, minute
from wickline.functions.time import bucket_start
from wickline.operators.dedup import upsert
from wickline.operators.rollup import (
    after_high_water,
    high_water,
    incremental_rollup,
    rollup_last,
    rollup_last_two_step,
)
from wickline.plans.store import CandleStore
from wickline.sources.events import event_candles

LOAD1 = [("A", minute(10, m), m) for m in range(0, 8)]
LOAD2 = [("A", minute(10, 8), 8), ("A", minute(10, 3), 103), ("B", minute(10, 5), 5), ("B", minute(10, 6), 6), ("C", minute(10, 2), 2)]


def _values(df):
    return sorted((r["symbol"], r["open_time"].strftime("%H:%M"), r["open_price"]) for r in df.collect())


def test_rollup_takes_last_candle_not_ohlc(spark):
    rows = [("A", minute(10, m), v) for m, v in [(0, 50), (1, 99), (2, 1), (3, 7)]]
    out = rollup_last(candles_df(spark, rows, dt.datetime(2025, 1, 16)), "5 minutes").collect()
    assert len(out) == 1
    r = out[0]
    # every column is the last base candle's value, the high included
    assert (r.open_price, r.high_price, r.low_price, r.volume, r.number_of_trades) == (7.0, 7.0, 7.0, 7.0, 7)
    assert r.open_time == minute(10, 0)
    assert r.close_time == minute(10, 3) + dt.timedelta(seconds=59, milliseconds=999)


def test_incremental_golden(spark):
    t1, t2 = dt.datetime(2025, 1, 15, 11), dt.datetime(2025, 1, 15, 12)
    base1 = candles_df(spark, LOAD1, t1)
    target = rollup_last(base1)
    assert _values(target) == [("A", "10:00", 4.0), ("A", "10:05", 7.0)]
    base = base1.unionByName(candles_df(spark, LOAD2, t2))
    new, hw = incremental_rollup(base, target)
    assert hw == minute(10, 5)
    assert _values(upsert(target, new)) == [("A", "10:00", 4.0), ("A", "10:05", 8.0), ("B", "10:05", 6.0)]


def test_incremental_variant_needs_full_rebuild(spark):
    t1, t2 = dt.datetime(2025, 1, 15, 11), dt.datetime(2025, 1, 15, 12)
    load2 = [r for r in LOAD2 if r[2] != 103] + [("A", minute(10, 4), 104)]
    base1 = candles_df(spark, LOAD1, t1)
    target = rollup_last(base1)
    base = base1.unionByName(candles_df(spark, load2, t2))
    new, _ = incremental_rollup(base, target)
    assert ("A", "10:00", 4.0) in _values(upsert(target, new))
    full = _values(rollup_last(base))
    assert ("A", "10:00", 104.0) in full and ("C", "10:00", 2.0) in full


def test_empty_target_high_water_is_epoch(spark):
    empty = candles_df(spark, []).select("open_time")
    assert high_water(empty) == dt.datetime(1970, 1, 1)
    base = candles_df(spark, LOAD1, dt.datetime(2025, 1, 16))
    assert after_high_water(base, high_water(empty)).count() == 8


def test_one_pass_equals_two_step(spark):
    candles = event_candles(spark, SF01)
    for width in ("5 minutes", "4 hours", "1 day"):
        a = rollup_last(candles, width)
        b = rollup_last_two_step(candles, width)
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bucket_widths(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 17, 13, 47, 31),)], "t timestamp_ntz")
    # one window() per projection: one width per step
    got = (
        df.withColumn("m5", bucket_start("t", "5 minutes"))
        .withColumn("h4", bucket_start("t", "4 hours"))
        .select("m5", "h4", bucket_start("t", "1 week").alias("w"), bucket_start("t", "1 month").alias("mo"))
        .first()
    )
    assert got.m5 == dt.datetime(2024, 1, 17, 13, 45)
    assert got.h4 == dt.datetime(2024, 1, 17, 12, 0)
    assert got.w == dt.datetime(2024, 1, 15)
    assert got.mo == dt.datetime(2024, 1, 1)


def test_store_incremental_golden(spark, workdir):
    store = CandleStore(spark, workdir)
    store.append(candles_df(spark, LOAD1), now=dt.datetime(2025, 1, 15, 11))
    first = store.refresh_rollup("5 minutes")
    assert first["mode"] == "full"
    assert _values(store.read_rollup()) == [("A", "10:00", 4.0), ("A", "10:05", 7.0)]
    store.append(candles_df(spark, LOAD2), now=dt.datetime(2025, 1, 15, 12))
    second = store.refresh_rollup("5 minutes")
    assert second["mode"] == "incremental" and second["high_water"] == minute(10, 5)
    assert _values(store.read_rollup()) == [("A", "10:00", 4.0), ("A", "10:05", 8.0), ("B", "10:05", 6.0)]
    store.refresh_rollup("5 minutes", full_refresh=True)
    assert ("C", "10:00", 2.0) in _values(store.read_rollup())
    assert ("A", "10:00", 103.0) not in _values(store.read_rollup())  # 10:04 is the last candle of 10:00


def test_upsert_idempotent_and_month_scoped(spark, workdir):
    store = CandleStore(spark, workdir)
    jan = [("A", dt.datetime(2025, 1, 31, 23, m), m) for m in range(0, 10)]
    feb = [("A", dt.datetime(2025, 2, 1, 0, m), m) for m in range(0, 10)]
    store.append(candles_df(spark, jan + feb), now=dt.datetime(2025, 2, 2))
    store.refresh_rollup("5 minutes")
    before = {r.open_time: r.open_price for r in store.read_rollup().collect()}
    assert len(before) == 4
    revised = candles_df(spark, [("A", dt.datetime(2025, 2, 1, 0, 9), 99)], dt.datetime(2025, 2, 3))
    new = rollup_last(revised).withColumn("open_month", F.lit(202502))
    for _ in range(2):
        assert store.upsert(new) == [202502]
    after = {r.open_time: r.open_price for r in store.read_rollup().collect()}
    assert len(after) == 4
    assert after[dt.datetime(2025, 2, 1, 0, 5)] == 99.0
    assert after[dt.datetime(2025, 1, 31, 23, 5)] == before[dt.datetime(2025, 1, 31, 23, 5)]


def test_store_slice_and_monthly_rebuild(spark, workdir):
    store = CandleStore(spark, workdir)
    jan = [("A", dt.datetime(2025, 1, 31, 23, m), m) for m in range(0, 10)]
    feb = [("A", dt.datetime(2025, 2, 1, 0, m), 100 + m) for m in range(0, 10)] + [("B", dt.datetime(2025, 2, 1, 0, 0), 7)]
    store.append(candles_df(spark, jan + feb), now=dt.datetime(2025, 2, 2))
    got = store.slice("A", dt.datetime(2025, 2, 1, 0, 2, 30), dt.datetime(2025, 2, 1, 0, 5), limit=10)
    assert [r.open_price for r in got.collect()] == [103.0, 104.0, 105.0]
    latest = store.slice("A", None, dt.datetime(2025, 2, 1, 0, 1), limit=3)
    assert [r.open_price for r in latest.collect()] == [9.0, 100.0, 101.0]
    assert store.refresh_rollup("5 minutes", full_refresh=True)["months"] == [202501, 202502]
    assert store.read_rollup().count() == 5
    assert store.compact() == [202501, 202502]
    assert store.latest_rows().count() == 21


def test_compaction_is_by_month_and_keeps_the_latest(spark, workdir):
    store = CandleStore(spark, workdir)
    jan = [("A", dt.datetime(2025, 1, 31, 23, m), m) for m in range(0, 5)]
    feb = [("A", dt.datetime(2025, 2, 1, 0, m), m) for m in range(0, 5)]
    store.append(candles_df(spark, jan + feb), now=dt.datetime(2025, 2, 2))
    store.append(candles_df(spark, jan + feb), now=dt.datetime(2025, 2, 3))
    assert store.latest().count() == 10 and store.latest_rows().count() == 20
    assert store.compact([202502, 209901]) == [202502]
    assert store.latest_rows([202502]).count() == 5 and store.latest_rows([202501]).count() == 10
    store.append(candles_df(spark, [("A", dt.datetime(2025, 2, 1, 0, 0), 42)]), now=dt.datetime(2025, 2, 4))
    assert store.compact() == [202501, 202502] and store.latest_rows().count() == 10
    store.append(candles_df(spark, [("A", dt.datetime(2025, 2, 1, 0, 1), 43)]), now=dt.datetime(2025, 2, 5))
    got = {r.open_time: r.open_price for r in store.latest().collect()}
    assert len(got) == 10 and got[dt.datetime(2025, 2, 1, 0, 0)] == 42.0 and got[dt.datetime(2025, 2, 1, 0, 1)] == 43.0


def test_incremental_runs_upsert_the_months_after_the_high_water(spark, workdir):
    store = CandleStore(spark, workdir)
    store.append(candles_df(spark, LOAD1 + [("A", dt.datetime(2024, 12, 1, 0, 0), 5)]), now=dt.datetime(2025, 1, 15, 11))
    store.refresh_rollup("5 minutes")
    table = store.rollup_table("5 minutes")
    store.append(candles_df(spark, LOAD2), now=dt.datetime(2025, 1, 15, 12))
    out = store.refresh_rollup("5 minutes")
    assert out["mode"] == "incremental" and out["months"] == [202501]
    want = [("A", "00:00", 5.0), ("A", "10:00", 4.0), ("A", "10:05", 8.0), ("B", "10:05", 6.0)]
    assert table.rows().count() == 4 and _values(store.read_rollup()) == want
    assert "Window" not in store.read_rollup()._jdf.queryExecution().executedPlan().toString()
    # no new rows: the run still re-rolls the last bucket (rows after its
    # start are after the high water), with the same values
    assert store.refresh_rollup("5 minutes")["months"] == [202501]
    assert _values(store.read_rollup()) == want


def test_upsert_is_one_exchange(spark):
    from wickline.operators.dedup import upsert

    t = candles_df(spark, [("A", minute(10, m), m) for m in range(9)])
    plan = upsert(t, candles_df(spark, [("A", minute(10, 3), 33), ("B", minute(10, 0), 1)]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text
    got = {(r.symbol, r.open_time.minute): r.open_price for r in plan.collect()}
    assert len(got) == 10 and got["A", 3] == 33.0 and got["B", 0] == 1.0 and got["A", 4] == 4.0


def test_week_rebuild_replaces_whole_table(spark, workdir):
    store = CandleStore(spark, workdir)
    rows = [("A", dt.datetime(2025, 1, 30, 0, 0), 1), ("A", dt.datetime(2025, 2, 1, 0, 0), 2)]
    store.append(candles_df(spark, rows), now=dt.datetime(2025, 2, 2))
    store.refresh_rollup("7 days", full_refresh=True)
    store.refresh_rollup("7 days", full_refresh=True)
    got = [(r.open_time, r.open_price) for r in store.read_rollup("7 days").collect()]
    assert got == [(dt.datetime(2025, 1, 30), 2.0)]  # epoch-aligned week starting on a Thursday


def test_rewrite_partitions_follow_bytes():
    from wickline.plans.months import TARGET_FILE_BYTES, partitions_for

    assert partitions_for(0) == 1
    assert partitions_for(TARGET_FILE_BYTES) == 1
    assert partitions_for(TARGET_FILE_BYTES + 1) == 2
    assert partitions_for(8 * 1024**4) == 32768  # an 8 TB month -> 256 MB files
