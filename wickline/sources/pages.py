"""REST candle pages (SRC-1): positional JSON arrays -> landing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.functions.time import from_epoch_millis, to_epoch_millis
from wickline.schemas import LANDING_COLUMNS

# Position of each field in one candle of a page.
PAGE_POSITIONS = {
    "open_time": 0,
    "open_price": 1,
    "high_price": 2,
    "low_price": 3,
    "close_price": 4,
    "volume": 5,
    "close_time": 6,
    "quote_asset_volume": 7,
    "number_of_trades": 8,
    "taker_buy_base_asset_volume": 9,
    "taker_buy_quote_asset_volume": 10,
    "ignore": 11,
}
PAGE_WIDTH = 12
_INT_FIELDS = {"open_time", "close_time", "number_of_trades"}


def _strict_long(c: Column, name: str) -> Column:
    failed = F.raise_error(F.concat(F.lit(f"invalid integer in {name}: "), c)).cast("long")
    return F.coalesce(c.try_cast("long"), F.when(c.isNotNull(), failed))


def _page_rows(payload: Column) -> Column:
    return F.from_json(payload, "array<array<string>>")


def page_problem(payload: Column) -> Column:
    """Why a page cannot be read; NULL when it can."""
    def reason(x: Column) -> Column:
        short = F.exists(x["rows"], lambda r: r.isNull() | (F.size(r) < PAGE_WIDTH))
        return F.when(x["n"].isNull() | x["rows"].isNull(), F.lit("no list of candles")).when(short, F.lit("short candle row"))

    # both parts are read once a row
    parts = F.array(F.struct(_page_rows(payload).alias("rows"), F.json_array_length(payload).alias("n")))
    return F.transform(parts, reason)[0]


def _valid(problem: Column, payload: Column) -> Column:
    """A filter condition that raises on a problem, so it is never pruned."""
    message = F.concat(F.lit("page: "), problem, F.lit(": "), F.coalesce(F.substring(payload, 1, 300), F.lit("NULL")))
    return F.when(problem.isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def parse_kline_pages(df: DataFrame, symbol_col: str = "symbol", payload_col: str = "payload") -> DataFrame:
    """One landing row per candle of every page.

    A page is ``[[open_ms, "open", "high", "low", "close", "volume",
    close_ms, "quote", trades, "taker base", "taker quote", "ignore"], ...]``.
    Numbers parsed into a string field keep their exact text, so prices are
    carried unchanged.  A page that is no list of candles (an error object,
    a broken text) and a candle with fewer than 12 items raise
    (``page_problem`` tells them apart beforehand).  Narrow: no shuffle, one
    task per input split.
    """
    payload = F.col(payload_col)
    valid = df.filter(_valid(page_problem(payload), payload))
    staged = valid.select(F.col(symbol_col).alias("symbol"), F.explode(_page_rows(payload)).alias("__row"))
    out: list[Column] = [F.col("symbol")]
    for name in LANDING_COLUMNS[1:]:
        item = F.col("__row")[PAGE_POSITIONS[name]]
        if name in _INT_FIELDS:
            value = _strict_long(item, name)
            out.append((from_epoch_millis(value) if name == "open_time" else value).alias(name))
        else:
            out.append(item.alias(name))
    return staged.select(*out)


def format_kline_row(df: DataFrame) -> Column:
    """The positional JSON text of one typed candle (inverse of the parser)."""

    def text(c: str) -> Column:
        # A JSON string literal: quoted and escaped.
        return F.regexp_extract(F.to_json(F.array(F.col(c).cast("string"))), r"^\[(.*)\]$", 1)

    parts = [
        to_epoch_millis("open_time").cast("string"),
        text("open_price"),
        text("high_price"),
        text("low_price"),
        text("close_price"),
        text("volume"),
        to_epoch_millis("close_time").cast("string"),
        text("quote_asset_volume"),
        F.col("number_of_trades").cast("string"),
        text("taker_buy_base_asset_volume"),
        text("taker_buy_quote_asset_volume"),
        text("ignore"),
    ]
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
