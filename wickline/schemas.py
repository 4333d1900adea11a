"""Canonical schemas.

Every candle timestamp is ``TIMESTAMP_NTZ`` holding UTC wall-clock time, so
results never depend on the session time zone (the helpers in
``wickline.functions.time`` convert epoch milliseconds without a zone).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the landing file and candle table.
LANDING_COLUMNS = [
    "symbol",
    "open_time",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "volume",
    "close_time",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
    "ignore",
]
CANDLE_COLUMNS = LANDING_COLUMNS + ["created_at"]

PRICE_COLUMNS = ["open_price", "high_price", "low_price", "close_price"]
VOLUME_COLUMNS = [
    "volume",
    "quote_asset_volume",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
]
DOUBLE_COLUMNS = PRICE_COLUMNS + VOLUME_COLUMNS

KEY = ("symbol", "open_time")
VERSION = "created_at"
LOAD_SEQ = "load_seq"
MONTH = "open_month"

_NTZ = T.TimestampNTZType()


def _field(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True)


# Text form written by the page formatter: prices as text, close_time as epoch ms.
LANDING = T.StructType(
    [
        _field("symbol", T.StringType()),
        _field("open_time", _NTZ),
        *[_field(c, T.StringType()) for c in PRICE_COLUMNS],
        _field("volume", T.StringType()),
        _field("close_time", T.LongType()),
        _field("quote_asset_volume", T.StringType()),
        _field("number_of_trades", T.LongType()),
        _field("taker_buy_base_asset_volume", T.StringType()),
        _field("taker_buy_quote_asset_volume", T.StringType()),
        _field("ignore", T.StringType()),
    ]
)

# Typed candle table (append-only history, deduplicated view, rollups).
CANDLE = T.StructType(
    [
        _field("symbol", T.StringType()),
        _field("open_time", _NTZ),
        *[_field(c, T.DoubleType()) for c in PRICE_COLUMNS],
        _field("volume", T.DoubleType()),
        _field("close_time", _NTZ),
        _field("quote_asset_volume", T.DoubleType()),
        _field("number_of_trades", T.LongType()),
        _field("taker_buy_base_asset_volume", T.DoubleType()),
        _field("taker_buy_quote_asset_volume", T.DoubleType()),
        _field("ignore", T.StringType()),
        _field("created_at", _NTZ),
    ]
)

# Order of loading, used to break created_at ties: the later row wins.
LOAD_SEQ_TYPE = T.StructType(
    [
        _field("load_ms", T.LongType()),
        _field("file_ms", T.LongType()),
        _field("source", T.StringType()),
        _field("row", T.LongType()),
    ]
)

TICKER = T.StructType(
    [
        _field("symbol", T.StringType()),
        _field("price", T.DoubleType()),
        _field("time", _NTZ),
        _field("created_at", _NTZ),
    ]
)

# Raw payload shapes.  Keys of the live candle differ only by case (t/T, v/V,
# q/Q, l/L), so they are parsed into a struct with the raw names and then
# cast positionally onto distinct names (see sources.payloads).
STREAM_KLINE_INNER_RAW = [
    ("t", T.LongType()),
    ("T", T.LongType()),
    ("s", T.StringType()),
    ("i", T.StringType()),
    ("f", T.LongType()),
    ("L", T.LongType()),
    ("o", T.StringType()),
    ("c", T.StringType()),
    ("h", T.StringType()),
    ("l", T.StringType()),
    ("v", T.StringType()),
    ("n", T.LongType()),
    ("x", T.BooleanType()),
    ("q", T.StringType()),
    ("V", T.StringType()),
    ("Q", T.StringType()),
    ("B", T.StringType()),
]
STREAM_KLINE_INNER_NAMES = [
    "start_ms",
    "close_ms",
    "symbol",
    "interval",
    "first_trade_id",
    "last_trade_id",
    "open",
    "close",
    "high",
    "low",
    "base_volume",
    "trades",
    "closed",
    "quote_volume",
    "taker_base_volume",
    "taker_quote_volume",
    "ignore",
]

MINI_TICKER_KEYS = ["e", "E", "s", "c", "o", "h", "l", "v", "q"]


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
