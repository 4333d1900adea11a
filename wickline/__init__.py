"""Candle (OHLCV) ingestion, deduplication and rollup on Spark DataFrames."""

from wickline.functions.convert import default_created_at, stamp, type_klines
from wickline.functions.time import bucket_start, from_epoch_millis, month_key, to_epoch_millis
from wickline.operators.dedup import latest_by_key, upsert
from wickline.operators.quality import assert_schema, check_candles, check_slice, flag_candles, table_health
from wickline.operators.rollup import high_water, incremental_rollup, rollup_last, rollup_last_two_step
from wickline.operators.slices import plan_pages, slice_klines, top_n_per_symbol
from wickline.plans.store import CandleStore
from wickline.sources.exchange_info import flatten_exchange_info, resolve_filters
from wickline.sources.landing import read_landing, write_landing
from wickline.sources.pages import parse_kline_pages
from wickline.sources.payloads import (
    new_landing_files,
    parse_notifications,
    parse_stream_klines,
    parse_tickers,
    type_stream_klines,
    type_tickers,
)
from wickline.streaming.ingest import load_files, run_once, start_ingest, start_message_ingest

__version__ = "0.1.0"

__all__ = [
    "CandleStore",
    "assert_schema",
    "bucket_start",
    "check_candles",
    "check_slice",
    "default_created_at",
    "flag_candles",
    "flatten_exchange_info",
    "from_epoch_millis",
    "high_water",
    "incremental_rollup",
    "latest_by_key",
    "load_files",
    "month_key",
    "new_landing_files",
    "parse_kline_pages",
    "parse_notifications",
    "parse_stream_klines",
    "parse_tickers",
    "plan_pages",
    "read_landing",
    "resolve_filters",
    "rollup_last",
    "rollup_last_two_step",
    "run_once",
    "slice_klines",
    "stamp",
    "start_ingest",
    "start_message_ingest",
    "table_health",
    "to_epoch_millis",
    "top_n_per_symbol",
    "type_klines",
    "type_stream_klines",
    "type_tickers",
    "upsert",
    "write_landing",
]
