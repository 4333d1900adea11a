"""Extract lifecycle: raw candle pages -> landing parquet.

Pages arrive as text, one JSON page per line with its symbol, e.g. files of
``{"symbol": "ETHUSDT", "payload": "[[...], ...]"}`` written by whatever
fetches them.  Parsing is narrow (no shuffle); the landing write groups
rows per symbol folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from wickline.sources.landing import to_landing, write_landing
from wickline.sources.pages import parse_kline_pages

PAGE_SCHEMA = "symbol string, payload string"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines page files -> (symbol, payload)."""
    return spark.read.schema(PAGE_SCHEMA).option("mode", "FAILFAST").json(path)


def land_pages(pages: DataFrame, base: str, run_time: dt.datetime | None = None) -> str | None:
    """SRC-1 + SRC-4: parse every page and write the landing files.

    An empty result writes nothing and returns None, like an empty page.
    """
    return write_landing(to_landing(parse_kline_pages(pages, "symbol", "payload")), base, run_time)
