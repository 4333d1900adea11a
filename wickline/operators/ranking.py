"""Places of rows in a global order, without a window (SRT-3).

Rows are dealt by ranges of the order and sorted inside each partition, so a
row's place is the number of rows in the partitions before its own plus its
place in its own.  The counts by partition are one row a partition.  No group,
however hot, ever stands in one task: a range that holds much is cut like any
other.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.session import scratch_path

_PART, _PLACE = "__part", "__place"
#: Spark numbers rows by partition above this bit and by place below it.
_PLACE_BITS = 33


def _name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ranked(df: DataFrame, order: Sequence[Column | str], place: str = "place", partitions: int | None = None, path: str | None = None) -> DataFrame:
    """``df`` with ``place``, each row's number (from 1) in the order ``order``.

    The sorted rows are written once, to ``path`` or a fresh folder under
    ``spark.checkpoint.dir`` (the result reads it), since range bounds are
    sampled: counts and places must come from the same run.  Rows equal in
    ``order`` are numbered in some order of their own.
    """
    spark = df.sparkSession
    cols = [_name(c) for c in order]
    dealt = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    number = F.monotonically_increasing_id()
    part = F.shiftrightunsigned(number, _PLACE_BITS)
    within = number.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    path = path or scratch_path(spark, "ranked")
    dealt.sortWithinPartitions(*cols).select("*", part.alias(_PART), within.alias(_PLACE)).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    counts = stored.groupBy(_PART).agg(F.count(F.lit(1)).alias("n")).orderBy(_PART).collect()  # one row a partition
    before = itertools.accumulate((r["n"] for r in counts), initial=0)
    offsets = spark.createDataFrame([(r[_PART], n) for r, n in zip(counts, before)], f"{_PART} long, __before long")
    joined = stored.join(offsets, _PART)
    return joined.select(*df.columns, (F.col("__before") + F.col(_PLACE) + 1).alias(place))


def ranked_in_groups(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], place: str = "place", partitions: int | None = None, path: str | None = None
) -> DataFrame:
    """``df`` with ``place``, each row's number (from 1) in its group in the
    order ``order``: its place among all rows, groups one after another, less
    the places before its group.  A NULL is a group like any other."""
    rows = ranked(df, [*group, *order], place, partitions, path)
    first = rows.groupBy(*[F.col(c).alias(f"__{c}") for c in group]).agg(F.min(place).alias("__first"))
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return rows.join(first, same).select(*df.columns, (F.col(place) - F.col("__first") + 1).alias(place))
