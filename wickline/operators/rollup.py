"""Candle rollups (AGG-1..3) and the incremental high-water filter (FLT-3).

The rollup is *not* OHLC: every column of a bucket, open/high/low/volume
included, is taken from the last base candle of the bucket (argMax by
open_time), and the bucket start becomes the new open_time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickline.functions.time import EPOCH, as_ntz, bucket_start
from wickline.operators.dedup import latest_by_key
from wickline.schemas import LOAD_SEQ, MONTH, VERSION

_BUCKET = "__bucket"
_RN = "__rn"


def _value_columns(df: DataFrame, time_col: str, group: Sequence[str]) -> list[str]:
    skip = set(group) | {time_col, _BUCKET, LOAD_SEQ, MONTH}
    return [c for c in df.columns if c not in skip]


def rollup_last(
    df: DataFrame,
    width: str = "5 minutes",
    time_col: str = "open_time",
    group: Sequence[str] = ("symbol",),
    version: str | None = VERSION,
    seq: str | None = LOAD_SEQ,
) -> DataFrame:
    """Deduplicate and roll up in one pass (the default plan).

    The latest version of the last candle of a bucket is the first row by
    (open_time desc, version desc, seq desc) within (group, bucket), so one
    window with ``row_number() = 1`` does both DED-1 and AGG-3.  Catalyst
    plans a partial WindowGroupLimit before the single shuffle on
    (group, bucket): each input partition emits at most one row per bucket,
    so even a very hot symbol or a coarse width shuffles little.
    """
    order = [F.col(time_col).desc_nulls_last()]
    if version and version in df.columns:
        order.append(F.col(version).desc_nulls_last())
    if seq and seq in df.columns:
        order.append(F.col(seq).desc_nulls_last())
    bucketed = df.withColumn(_BUCKET, bucket_start(F.col(time_col), width))
    w = Window.partitionBy(*group, _BUCKET).orderBy(*order)
    values = _value_columns(df, time_col, group)
    return (
        bucketed.withColumn(_RN, F.row_number().over(w))
        .filter(F.col(_RN) == 1)
        .select(*group, F.col(_BUCKET).alias(time_col), *values)
    )


def rollup_last_two_step(
    df: DataFrame,
    width: str = "5 minutes",
    time_col: str = "open_time",
    group: Sequence[str] = ("symbol",),
    version: str | None = VERSION,
    seq: str | None = LOAD_SEQ,
) -> DataFrame:
    """The literal form: DED-1, bucket, then ``max_by(x, open_time)`` per column.

    Two shuffles (key, then bucket).  Kept as the reference shape and for
    the benchmark comparison; ``rollup_last`` is the plan to use.
    """
    latest = latest_by_key(df, (*group, time_col), version, seq)
    values = _value_columns(latest, time_col, group)
    bucketed = latest.withColumn(_BUCKET, bucket_start(F.col(time_col), width))
    aggs = [F.max_by(F.col(c), F.col(time_col)).alias(c) for c in values]
    return bucketed.groupBy(*group, _BUCKET).agg(*aggs).select(
        *group, F.col(_BUCKET).alias(time_col), *values
    )


def high_water(target: DataFrame, time_col: str = "open_time") -> dt.datetime:
    """``max(open_time)`` of the target, the epoch when it is empty.

    Collected to the driver once as a single value so the filter that uses
    it is a literal: parquet can then skip row groups and month partitions.
    The source engine returns the epoch for ``max`` over an empty non-null
    column while Spark returns NULL, which would drop every row.
    """
    value = target.agg(F.max(time_col).alias("hw")).first()["hw"]
    if value is None:
        return EPOCH
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def after_high_water(df: DataFrame, hw: dt.datetime, time_col: str = "open_time") -> DataFrame:
    """Strict ``open_time > hw``, plus the month predicate when ``df`` is month partitioned.

    Spark does not derive a partition predicate from a predicate on
    open_time, so the month bound is added explicitly.
    """
    out = df.filter(F.col(time_col) > as_ntz(hw))
    if MONTH in df.columns:
        out = out.filter(F.col(MONTH) >= F.lit(hw.year * 100 + hw.month))
    return out


def high_water_column(target: DataFrame, time_col: str = "open_time") -> DataFrame:
    """AGG-2 as a one-row DataFrame: coalesce(max(open_time), epoch)."""
    return target.agg(F.coalesce(F.max(time_col), as_ntz(EPOCH)).alias("high_water"))


def incremental_rollup(
    base: DataFrame,
    target: DataFrame,
    width: str = "5 minutes",
    time_col: str = "open_time",
) -> tuple[DataFrame, dt.datetime]:
    """New rollup rows for the base candles after the target's high water.

    The bound is global over all symbols and compares base-row time with
    bucket time, so late rows, late symbols and revisions at or before it
    are not picked up (only a full rebuild does that).  Returns the new rows
    and the high water used.
    """
    hw = high_water(target, time_col)
    fresh = after_high_water(base, hw, time_col)
    return rollup_last(fresh, width, time_col), hw

