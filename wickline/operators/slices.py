"""Candle slices (SRC-2, SRT-2) and page planning (SRC-3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickline.functions.time import (
    as_ntz,
    floor_to_second_millis,
    from_epoch_millis,
    width_seconds,
)

# Fixed value: the default page size of a candle request.
DEFAULT_LIMIT = 500


def _floor_second(value: dt.datetime) -> dt.datetime:
    return value.replace(microsecond=0, tzinfo=None)


def slice_klines(
    df: DataFrame,
    symbol: str,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    limit: int | None = None,
    time_col: str = "open_time",
) -> DataFrame:
    """Candles of one symbol with start <= open_time <= end, all of them
    unless ``limit`` is given.

    Bounds are floored to whole seconds.  With a start the limit takes the
    first candles, without one the latest.  Output is ascending by
    open_time; a symbol with no rows gives an empty result.  The symbol and
    time predicates are literals and reach the parquet scan.
    """
    out = df.filter(F.col("symbol") == F.lit(symbol))
    if start is not None:
        out = out.filter(F.col(time_col) >= as_ntz(_floor_second(start)))
    if end is not None:
        out = out.filter(F.col(time_col) <= as_ntz(_floor_second(end)))
    if limit is None:
        return out.orderBy(time_col)
    if limit <= 0:
        raise ValueError("limit must be positive")
    if start is not None:
        return out.orderBy(F.col(time_col).asc()).limit(limit)
    latest = out.orderBy(F.col(time_col).desc()).limit(limit)
    return latest.orderBy(F.col(time_col).asc())


def top_n_per_symbol(df: DataFrame, n: int, newest: bool = True, time_col: str = "open_time") -> DataFrame:
    """The ``n`` newest (or oldest) candles of every symbol.

    ``row_number() <= n`` plans as a partial WindowGroupLimit before the
    shuffle on symbol, so each input partition sends at most ``n`` rows per
    symbol however skewed the symbols are.
    """
    order = F.col(time_col).desc() if newest else F.col(time_col).asc()
    w = Window.partitionBy("symbol").orderBy(order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def plan_pages(
    ranges: DataFrame,
    interval: str = "1 minute",
    limit: int = DEFAULT_LIMIT,
    start_col: str = "start",
    end_col: str = "end",
) -> DataFrame:
    """One row per request page for each (symbol, start, end) range.

    A range [start, end) at a resolution holds ceil((end - start) / step)
    candles and needs ceil(candles / limit) requests.  Page ``i`` covers
    candles ``i * limit`` up to the next page or the end.  Bounds are
    floored to whole seconds, like the request parameters.
    """
    step_ms = width_seconds(interval) * 1000
    span = limit * step_ms
    s = floor_to_second_millis(F.col(start_col))
    e = floor_to_second_millis(F.col(end_col))
    candles = F.greatest(F.lit(0).cast("long"), F.ceil((e - s) / F.lit(step_ms)).cast("long"))
    pages = F.ceil(candles / F.lit(limit)).cast("long")
    base = ranges.select("symbol", s.alias("__s"), e.alias("__e"), candles.alias("__n"), pages.alias("__p"))
    exploded = base.filter(F.col("__p") > 0).select(
        "symbol",
        "__s",
        "__e",
        "__n",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("__p") - 1)).alias("page"),
    )
    page_start = F.col("__s") + F.col("page") * F.lit(span)
    page_end = F.least(page_start + F.lit(span), F.col("__e"))
    return exploded.select(
        "symbol",
        F.col("page"),
        from_epoch_millis(page_start).alias("page_start"),
        from_epoch_millis(page_end).alias("page_end"),
        F.least(F.lit(limit).cast("long"), F.col("__n") - F.col("page") * F.lit(limit)).alias("candles"),
    )


def backfill_estimate(pages: DataFrame, requests_per_second: float = 20.0) -> DataFrame:
    """Requests, candles and the time to issue them at a fixed request rate."""
    return pages.agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("candles").alias("candles"),
        (F.count(F.lit(1)) / F.lit(float(requests_per_second))).alias("seconds"),
    )
