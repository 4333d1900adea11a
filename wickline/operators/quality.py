"""Data-quality checks (DQ-1..3) and table health counts (AGG-4)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.functions.time import as_ntz, width_seconds
from wickline.schemas import CANDLE_COLUMNS, KEY, LANDING


class SchemaError(ValueError):
    pass


def candle_rules() -> dict[str, Column]:
    """Per-row invariants; NULL counts as a violation."""
    return {
        "time_order": F.coalesce(F.col("open_time") < F.col("close_time"), F.lit(False)),
        "low_le_high": F.coalesce(F.col("low_price") <= F.col("high_price"), F.lit(False)),
        "trades_non_negative": F.coalesce(F.col("number_of_trades") >= 0, F.lit(False)),
        "volume_non_negative": F.coalesce(F.col("volume") >= 0, F.lit(False)),
    }


def flag_candles(df: DataFrame) -> DataFrame:
    """Adds one boolean ``ok_<rule>`` column per invariant."""
    return df.select("*", *[c.alias(f"ok_{name}") for name, c in candle_rules().items()])


def check_candles(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and violations per rule (one partial aggregation, no row movement)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(~c).alias(f"bad_{name}") for name, c in candle_rules().items()]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def health_metrics(columns: Sequence[str], time_col: str = "open_time") -> list[Column]:
    """Aggregates to observe while candles are written (``DataFrame.observe``):
    rows, first and last time, and violations per rule of :func:`candle_rules`
    as far as ``columns`` have them.  No pass of its own, no distinct counts
    (observed metrics cannot hold them; see :func:`table_health`)."""
    out = [F.count(F.lit(1)).alias("rows"), F.min(time_col).alias("first_open"), F.max(time_col).alias("last_open")]
    if set(CANDLE_COLUMNS) <= set(columns):
        out += [F.count_if(~c).alias(f"bad_{name}") for name, c in candle_rules().items()]
    return out


def check_slice(
    df: DataFrame,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    interval: str = "1 minute",
    limit: int | None = None,
) -> DataFrame:
    """Range checks of a slice: one row of measures and boolean verdicts."""
    step = width_seconds(interval)
    first, last = F.min("open_time"), F.max("close_time")
    n, symbols = F.count(F.lit(1)), F.count_distinct("symbol")
    verdicts = [
        (first >= as_ntz(start) if start else F.lit(True)).alias("starts_in_range"),
        (last <= F.timestamp_add("SECOND", F.lit(step), as_ntz(end)) if end else F.lit(True)).alias("ends_in_range"),
        (n <= F.lit(limit) if limit else F.lit(True)).alias("within_limit"),
        (symbols <= 1).alias("single_symbol"),
    ]
    return df.agg(first.alias("first_open"), last.alias("last_close"), n.alias("rows"), symbols.alias("symbols"), *verdicts)


def table_health(df: DataFrame, by: Sequence[str] = (), keys: Sequence[str] = KEY) -> DataFrame:
    """Raw row count and distinct-key count (what a deduplicated view would hold)."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def _type_ok(name: str, dtype: T.DataType) -> bool:
    text = dict((f.name, f.dataType) for f in LANDING.fields)
    if name in ("open_time",):
        return isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.LongType))
    if name == "close_time":
        return isinstance(dtype, (T.LongType, T.TimestampNTZType, T.TimestampType))
    if name == "created_at":
        return isinstance(dtype, (T.TimestampNTZType, T.TimestampType))
    if name == "number_of_trades":
        return isinstance(dtype, (T.LongType, T.IntegerType))
    if name in ("symbol", "ignore"):
        return isinstance(dtype, T.StringType)
    if name in text:
        return isinstance(dtype, (T.StringType, T.DoubleType, T.FloatType))
    return True


def assert_schema(
    schema: T.StructType | DataFrame,
    columns: Iterable[str] = CANDLE_COLUMNS,
    optional: Iterable[str] = ("created_at",),
    check_types: bool = True,
) -> T.StructType:
    """Exactly the configured columns: none missing (except ``optional``), none unknown.

    Needed because a read with an explicit schema turns a missing column
    into NULLs silently.  Types must be one of the two landing shapes.
    """
    if isinstance(schema, DataFrame):
        schema = schema.schema
    wanted, opt = list(columns), set(optional)
    have = {f.name: f.dataType for f in schema.fields}
    missing = [c for c in wanted if c not in have and c not in opt]
    unknown = [c for c in have if c not in wanted]
    if missing or unknown:
        raise SchemaError(f"schema mismatch: missing={missing} unknown={unknown}")
    if check_types:
        bad = [f"{n}:{t.simpleString()}" for n, t in have.items() if not _type_ok(n, t)]
        if bad:
            raise SchemaError(f"unexpected column types: {bad}")
    return schema


def assert_landing_schema(schema: T.StructType | DataFrame) -> T.StructType:
    """The exact text-form landing schema written by ``write_landing``."""
    if isinstance(schema, DataFrame):
        schema = schema.schema
    got = [(f.name, f.dataType) for f in schema.fields]
    want = [(f.name, f.dataType) for f in LANDING.fields]
    if got != want:
        raise SchemaError(f"landing schema mismatch: {got} != {want}")
    return schema

