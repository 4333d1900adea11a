"""Skew: a key, symbol or bucket holding a large share of all rows must not
move those rows through the shuffle.  Checked on Spark's own shuffle
metrics after execution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from wickline.operators.dedup import latest_by_key
from wickline.operators.rollup import rollup_last
from wickline.operators.slices import top_n_per_symbol
from wickline.schemas import CANDLE_COLUMNS

PARTS = 8


def _candles(spark, n_hot: int, n_cold: int):
    base = dt.datetime(2025, 1, 1)
    ids = spark.range(0, n_hot + n_cold, numPartitions=PARTS)
    hot = F.col("id") < n_hot
    minute = F.when(hot, F.lit(0)).otherwise(F.col("id"))
    open_time = F.lit(base.isoformat(sep=" ")).cast("timestamp_ntz") + F.make_dt_interval(mins=minute)
    v = F.col("id").cast("double")
    return ids.select(
        F.when(hot, F.lit("HOT")).otherwise(F.lit("COLD")).alias("symbol"),
        open_time.alias("open_time"),
        v.alias("open_price"), v.alias("high_price"), v.alias("low_price"), v.alias("close_price"), v.alias("volume"),
        (open_time + F.make_dt_interval(secs=F.lit(59.999))).alias("close_time"),
        v.alias("quote_asset_volume"), F.col("id").alias("number_of_trades"),
        v.alias("taker_buy_base_asset_volume"), v.alias("taker_buy_quote_asset_volume"),
        F.lit("0").alias("ignore"),
        (F.lit(base.isoformat(sep=" ")).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("double"))).alias("created_at"),
    ).select(*CANDLE_COLUMNS)


def _shuffled_records(df) -> int:
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.finalPhysicalPlan()
    total = 0
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name in ("ShuffleQueryStageExec",):
            node = node.plan()
            name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            total += int(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        nodes.extend(children.apply(i) for i in range(children.size()))
    return total


def test_hot_key_copies_do_not_cross_the_shuffle(spark):
    df = _candles(spark, n_hot=20000, n_cold=100)
    out = latest_by_key(df, version="created_at", seq=None)
    shuffled = _shuffled_records(out)
    # one row per key per map partition at most: 8 for the hot key, 100 cold keys
    assert shuffled <= PARTS + 100
    hot = out.filter("symbol = 'HOT'").collect()
    assert len(hot) == 1 and hot[0].number_of_trades == 19999


def test_hot_bucket_rollup_and_top_n(spark):
    df = _candles(spark, n_hot=20000, n_cold=2000)
    r = rollup_last(df, "1 day", seq=None)
    # cold minutes 20000..21999 fall on three days, the hot key on one
    assert _shuffled_records(r) <= PARTS * 4  # <= one row per (symbol, day) per map partition
    assert r.count() == 4
    t = top_n_per_symbol(latest_by_key(df, version="created_at", seq=None), 5)
    assert t.filter("symbol = 'COLD'").count() == 5 and t.filter("symbol = 'HOT'").count() == 1
