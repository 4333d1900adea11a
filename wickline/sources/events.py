"""Candles derived from the driver's ``events`` table.

One candle per event; repeated (symbol, minute) pairs are natural versions
of the same candle, ordered by the event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.functions.time import bucket_start
from wickline.operators.quality import SchemaError


# Fixed value: the driver's events table (TESTDATA / FIXTURES F12).
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

KNOWN_SCHEMAS = {"events": EVENTS_SCHEMA}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table.  A known table must hold its declared columns:
    reading it with that schema would turn a missing one into NULLs."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name not in KNOWN_SCHEMAS:
        return df
    wanted = [c.split(" ") for c in KNOWN_SCHEMAS[name].split(", ")]
    missing = [c for c, _ in wanted if c not in df.columns]
    if missing:
        raise SchemaError(f"{name}: missing columns {missing}")
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in wanted])


def candles_from_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, event_type, value, props) -> CANDLE columns."""
    open_time = bucket_start(F.col("ts"), "1 minute")
    value = F.col("value")
    return events.select(
        F.col("event_type").alias("symbol"),
        open_time.alias("open_time"),
        value.alias("open_price"),
        (value + F.lit(1.0)).alias("high_price"),
        (value - F.lit(1.0)).alias("low_price"),
        (value + F.lit(0.5)).alias("close_price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.timestamp_add("MILLISECOND", F.lit(59999), open_time).alias("close_time"),
        (value * F.lit(2.0)).alias("quote_asset_volume"),
        F.col("event_id").cast("long").alias("number_of_trades"),
        (value / F.lit(2.0)).alias("taker_buy_base_asset_volume"),
        value.alias("taker_buy_quote_asset_volume"),
        F.lit("0").alias("ignore"),
        F.col("ts").alias("created_at"),
    )  # already in CANDLE_COLUMNS order


def event_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candles_from_events(read_table(spark, sf_dir, "events"))
