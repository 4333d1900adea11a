"""Parquet tables partitioned by month, written and read by Spark alone.

``MonthTable`` is a folder ``open_month=M/`` of plain parquet.  Appends are
appends.  ``view`` is the latest row per key, a window over the rows stored.
A month is rewritten by one job with Spark's dynamic partition overwrite,
which stages the job's files under the table and puts them in place when the
job commits; a task or job that fails leaves the month as it was.  The last
step, by month, is no single step of the file system: one writer at a time,
and a driver that dies within it can leave a month missing, which its source
brings back (``CandleStore.rebuild_latest``, a full rollup).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.operators.dedup import latest_by_key, upsert
from wickline.plans import fs
from wickline.schemas import KEY, MONTH

# Target size of one rewritten parquet file (compressed bytes on disk).
TARGET_FILE_BYTES = 256 * 1024 * 1024


def months_of(values: Iterable[int | str]) -> list[int]:
    return sorted({int(v) for v in values})


def partitions_for(size: int, target: int = TARGET_FILE_BYTES) -> int:
    """Range partitions for a rewrite of ``size`` bytes.

    AQE merges small range partitions but never splits large ones, so a
    rewrite is sized from the bytes it reads rather than from
    ``spark.sql.shuffle.partitions``.
    """
    return max(1, -(-size // target))


def clustered(df: DataFrame, partitions: int | None = None, key: Sequence[str] = KEY, rebalance: bool = False) -> DataFrame:
    """SRT-1: group rows by (month, *key) into files and sort inside each file.

    Bulk rewrites use range partitioning: each file holds a narrow slice of
    keys, so parquet min/max statistics skip files and row groups for symbol
    and time predicates, and a hot symbol is split over many files.  Appends
    use ``rebalance`` instead (no sampling job): AQE hashes on (month, first
    key column), splits oversized partitions and merges small ones.
    """
    cols = [MONTH, *key]
    if rebalance:
        parts = df.hint("rebalance", MONTH, key[0])
    elif partitions:
        parts = df.repartitionByRange(partitions, *cols)
    else:
        parts = df.repartitionByRange(*cols)
    return parts.sortWithinPartitions(*cols)


@dataclass
class MonthTable:
    """``columns`` are what readers see, ``order`` the version columns that
    decide between rows of one key (none: keys are unique in the table)."""

    spark: SparkSession
    path: str
    key: Sequence[str]
    columns: Sequence[str]
    order: Sequence[str] = ()
    partitions: int | None = None

    # ------------------------------------------------------------ reading
    def exists(self) -> bool:
        return fs.has_data(self.spark, self.path)

    def months(self) -> list[int]:
        """Months of the table, from the listing of its own folder only."""
        return months_of(fs.partition_values(self.spark, self.path, MONTH))

    def _month_path(self, m: int) -> str:
        return f"{self.path}/{MONTH}={m}"

    def month_bytes(self, months: Iterable[int]) -> int:
        return sum(fs.size_bytes(self.spark, self._month_path(m)) for m in months)

    def rows(self, months: Iterable[int] | None = None) -> DataFrame | None:
        """Stored rows, superseded versions included.

        With ``months`` only those month folders are listed and read
        (``basePath`` keeps the partition column): a read of the whole table
        would list every file of every month on the driver before pruning.
        """
        if not self.exists():
            return None
        if months is None:
            return self.spark.read.parquet(self.path)
        listed = self.months()
        wanted = [m for m in months_of(months) if m in set(listed)]
        reader = self.spark.read.option("basePath", self.path)
        if not wanted:
            # an empty result with the table's schema, listing one month only
            return reader.parquet(self._month_path(listed[-1])).where(F.lit(False))
        return reader.parquet(*[self._month_path(m) for m in wanted])

    @property
    def stored(self) -> list[str]:
        """Columns in the files: those of readers and the version columns beside them."""
        return [*self.columns, *[c for c in self.order if c not in self.columns]]

    def latest(self, rows: DataFrame) -> DataFrame:
        """DED-1.  ``open_month`` joins the window's keys (it follows from the
        key's time, so groups are unchanged) so that Catalyst pushes month
        predicates below the window too."""
        if not self.order:
            return rows
        version, *rest = self.order
        return latest_by_key(rows, (*self.key, MONTH), version, rest[0] if rest else None)

    def view(self, months: Iterable[int] | None = None) -> DataFrame | None:
        """``columns`` + ``open_month``, one row per key.  Key predicates on the
        result reach the parquet scan; value predicates stay above the window."""
        rows = self.rows(months)
        return None if rows is None else self.latest(rows).select(*self.columns, MONTH)

    # ------------------------------------------------------------ writing
    def _write(self, df: DataFrame, mode: str, overwrite: str = "static") -> None:
        writer = df.select(*self.stored, MONTH).write.mode(mode).option("partitionOverwriteMode", overwrite)
        writer.option("compression", "zstd").partitionBy(MONTH).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        self._write(clustered(rows, None, self.key, rebalance=True), "append")

    def replace_all(self, df: DataFrame) -> None:
        """The whole table anew (``df`` may not read it)."""
        self._write(df.sortWithinPartitions(MONTH, *self.key), "overwrite")

    def replace_months(self, df: DataFrame) -> None:
        """Every month that ``df`` has rows of, anew; others stay."""
        self._write(df.sortWithinPartitions(MONTH, *self.key), "overwrite", "dynamic")

    def compact(self, months: Iterable[int] | None = None) -> list[int]:
        """DED-2: months (all, unless named) with one row per key, each by one
        job: deduplicated, dealt by key ranges, dynamically overwritten."""
        listed = self.months() if self.exists() else []
        wanted = listed if months is None else [m for m in months_of(months) if m in listed]
        for m in wanted:
            parts = self.partitions or partitions_for(self.month_bytes([m]))
            self.replace_months(clustered(self.latest(self.rows([m])), parts, self.key))
        return wanted

    def upsert(self, new: DataFrame, months: Iterable[int] | None = None) -> list[int]:
        """DED-4 on disk: rows of ``new`` replace rows with the same key, all
        others stay; of rows of ``new`` with one key any one counts.

        Only the months of ``new`` are read and rewritten (``months`` saves
        the pass that looks for them): one shuffle by key of their rows and the
        new ones together.
        """
        if months is None:
            months = [r[MONTH] for r in new.select(MONTH).distinct().collect()]
        touched = months_of(months)
        if not touched:
            return []
        current = self.rows(touched)
        rows = new.select(*self.stored, MONTH)
        self.replace_months(upsert(rows.limit(0) if current is None else current.select(*rows.columns), rows, (*self.key, MONTH)))
        return touched
