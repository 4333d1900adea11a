"""Latest version per key (DED-1) and upsert by unique key (DED-4).

DED-1 is a ``row_number() = 1`` window.  Spark plans it as a partial
WindowGroupLimit on the map side (at most one row per key leaves each input
partition), one shuffle hashed on the key, then the final limit.  The key is
``(symbol, open_time)``, so a symbol that holds a third of all rows is still
spread over many shuffle partitions by its open_time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickline.schemas import KEY, LOAD_SEQ, VERSION

_RN = "__rn"
_ORIGIN = "__origin"


def _order(version: str | None, seq: str | None, df: DataFrame) -> list[Column]:
    order: list[Column] = []
    if version and version in df.columns:
        order.append(F.col(version).desc_nulls_last())
    if seq and seq in df.columns:
        order.append(F.col(seq).desc_nulls_last())
    if not order:
        raise ValueError("latest_by_key needs a version or a sequence column")
    return order


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str] = KEY,
    version: str | None = VERSION,
    seq: str | None = LOAD_SEQ,
) -> DataFrame:
    """One row per key: greatest ``version``; ties go to the greatest ``seq``.

    ``seq`` records load order (file, row); when absent only the version
    decides.  Filters on key columns placed on the result are pushed below the
    window by Catalyst; filters on other columns must stay above it.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(version, seq, df))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Rows of ``new`` replace rows of ``target`` with the same key; others are kept.

    Both sides are expected to be unique by key.  Where a row comes from is its
    version, so this is the latest row per key of both together: one shuffle by
    key, whatever the sizes, and no join.
    """
    tagged = target.withColumn(_ORIGIN, F.lit(0)).unionByName(new.select(*target.columns).withColumn(_ORIGIN, F.lit(1)))
    return latest_by_key(tagged, keys, _ORIGIN, None).drop(_ORIGIN)
