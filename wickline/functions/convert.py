"""Typing and stamping of candle rows (PRJ-1..5)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.functions.time import as_ntz, from_epoch_millis, now_ntz, truncate_second
from wickline.schemas import CANDLE, CANDLE_COLUMNS, DOUBLE_COLUMNS


def _strict_double(c: Column) -> Column:
    """Text -> double that raises on bad input whatever the ANSI setting."""
    # try_cast once; raise only when a non-NULL input did not parse
    failed = F.raise_error(F.concat(F.lit("invalid number: "), c.cast("string"))).cast("double")
    return F.coalesce(c.try_cast("double"), F.when(c.isNotNull(), failed))


def _to_ntz(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return from_epoch_millis(c)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        # Instant -> UTC wall clock, independent of the session zone.
        return from_epoch_millis(F.unix_millis(c))
    if isinstance(dtype, T.StringType):
        return F.to_timestamp_ntz(c)
    raise TypeError(f"cannot read a time from {dtype.simpleString()}")


def _lenient_double(c: Column) -> Column:
    return c.try_cast("double")


def type_klines(df: DataFrame, keep: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Landing rows (text or typed form) -> CANDLE columns without created_at.

    Prices and volumes become doubles (a bad number raises), epoch-ms
    times become NTZ UTC timestamps.  Columns are matched by name, so both
    landing shapes (text prices with long close_time, or doubles with
    timestamps) load.  ``created_at`` is passed through if present.  With
    ``strict=False`` a bad number becomes NULL instead of raising (the loader
    then reports the file).
    """
    to_double = _strict_double if strict else _lenient_double
    types = {f.name: f.dataType for f in df.schema.fields}
    out: list[Column] = []
    for field in CANDLE.fields:
        name = field.name
        if name not in types:
            if name == "created_at":
                continue
            raise ValueError(f"missing column: {name}")
        c, dtype = F.col(name), types[name]
        if name in DOUBLE_COLUMNS:
            out.append((c if isinstance(dtype, T.DoubleType) else to_double(c.cast("string"))).alias(name))
        elif name in ("open_time", "close_time", "created_at"):
            out.append(_to_ntz(c, dtype).alias(name))
        elif name == "number_of_trades":
            out.append(c.cast("long").alias(name))
        else:
            out.append(c.cast("string").alias(name))
    return df.select(*out, *keep)


def stamp(df: DataFrame, columns: Sequence[str] = CANDLE_COLUMNS, now: dt.datetime | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Select ``columns`` in order, replacing the last one by the load time.

    The load time is ``now()`` at second resolution and overwrites any value
    the input carries.  ``now`` fixes it (tests, replays).
    """
    load_time = as_ntz(now) if now is not None else now_ntz()
    *body, last = list(columns)
    return df.select(*body, truncate_second(load_time).alias(last), *keep)


def default_created_at(df: DataFrame, column: str = "created_at") -> DataFrame:
    """created_at defaults to now() (millisecond resolution) when absent or null."""
    now = now_ntz()
    if column not in df.columns:
        return df.withColumn(column, now)
    return df.withColumn(column, F.coalesce(F.col(column), now))

