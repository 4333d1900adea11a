"""Candle tables on a file system.

Layout under one root folder:

* ``append_only/batch=<id>/open_month=M/`` - the history: every loaded row with
  its load stamp and load order; may hold duplicates (retries, revisions).
  Each load owns one batch folder, which it overwrites: a load that is run
  again replaces itself.  ``optimize_history`` merges small batches; rows are
  never changed or dropped.
* ``latest/open_month=M/`` - the deduplicated table.  A stream of its own, whose
  source is the history folder, appends every row of the history to it
  (``streaming.propagate``); reads keep the latest version per (symbol,
  open_time), and ``compact`` rewrites months with one row per key.
* ``rollup_<width>/open_month=M/`` - incremental "last candle" rollups, one row
  per key: each run upserts its new rows into the months they touch.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wickline.functions.convert import default_created_at, stamp
from wickline.functions.time import EPOCH, month_key, parse_width, to_epoch_micros, width_name, width_seconds
from wickline.operators.quality import health_metrics
from wickline.operators.rollup import after_high_water, rollup_last
from wickline.operators.slices import slice_klines
from wickline.plans import fs
from wickline.plans.months import TARGET_FILE_BYTES, MonthTable, clustered, partitions_for
from wickline.schemas import CANDLE, CANDLE_COLUMNS, KEY, LOAD_SEQ, MONTH, VERSION

BATCH = "batch"
# Batch folders by who wrote them; the propagation stream reads the first two.
LOADED, STREAMED, MERGED = "load", "stream", "merged"

__all__ = ["CandleStore", "clustered", "newest_load_first", "newest_load_order"]


def _slug(width: str) -> str:
    return width_name(width).replace(" ", "")


@dataclass
class CandleStore:
    """Tables of one dataset.  ``columns`` is the loader's column list (the
    last one is the load stamp), ``key`` the unique key and ``time_col`` the
    column whose month partitions the tables; the defaults are the candle
    table's."""

    spark: SparkSession
    root: str
    key: Sequence[str] = KEY
    partitions: int | None = None
    columns: Sequence[str] = tuple(CANDLE_COLUMNS)
    time_col: str = "open_time"
    base_interval: str = "1 minute"

    # ------------------------------------------------------------ layout
    @property
    def append_only_path(self) -> str:
        return f"{self.root.rstrip('/')}/append_only"

    @property
    def latest_path(self) -> str:
        return f"{self.root.rstrip('/')}/latest"

    def rollup_path(self, width: str) -> str:
        return f"{self.root.rstrip('/')}/rollup_{_slug(width)}"

    @property
    def latest_table(self) -> MonthTable:
        return MonthTable(self.spark, self.latest_path, self.key, self.columns, (self.columns[-1], LOAD_SEQ), self.partitions)

    def rollup_table(self, width: str) -> MonthTable:
        return MonthTable(self.spark, self.rollup_path(width), KEY, CANDLE_COLUMNS, (), self.partitions)

    @property
    def propagation_checkpoint(self) -> str:
        return f"{self.root.rstrip('/')}/_propagation"

    # ------------------------------------------------------------ loading
    def prepare(
        self,
        df: DataFrame,
        now: dt.datetime | None = None,
        load_ms: int | None = None,
        keep: Sequence[str] = (),
        order_by: str | None = None,
        given_created_at: bool = False,
        check_keys: bool = True,
    ) -> DataFrame:
        """PRJ-4 + load order: the configured columns stamped with the load
        time, plus ``load_seq`` and ``open_month``.

        ``order_by`` (a time or whole-number column of ``df``) orders rows of
        one key inside this load: the greatest wins.  Without it, and without
        a ``load_seq`` of the input's own, a hash of the row decides, which
        never depends on how the input is partitioned.  ``now`` fixes the
        stamp for tests and replays.  With ``given_created_at`` (PRJ-5) the
        input's own ``created_at`` stays and only a missing one gets the
        clock.  A NULL in a key column raises unless ``check_keys`` is off.
        """
        load_ms = load_ms if load_ms is not None else int(time.time() * 1000)
        if now is None:
            # One value for the whole load, fixed before any write runs.
            now = dt.datetime.fromtimestamp(load_ms / 1000, dt.timezone.utc).replace(tzinfo=None)
        if LOAD_SEQ not in df.columns:
            order = F.lit(load_ms)
            if order_by is not None:
                is_time = df.schema[order_by].dataType.typeName().startswith("timestamp")
                order = to_epoch_micros(order_by) if is_time else F.col(order_by)
            df = df.withColumn(
                LOAD_SEQ,
                F.struct(
                    F.lit(load_ms).cast("long").alias("load_ms"),
                    order.cast("long").alias("file_ms"),
                    F.lit(f"load-{uuid.uuid4().hex}").alias("source"),
                    F.xxhash64(*df.columns).alias("row"),
                ),
            )
        if given_created_at:
            stamped = default_created_at(df, self.columns[-1]).select(*self.columns, LOAD_SEQ, *keep)
        else:
            stamped = stamp(df, self.columns, now=now, keep=(LOAD_SEQ, *keep))
        if check_keys:
            ok = F.lit(True)
            for c in self.key:
                ok = ok & F.col(c).isNotNull()
            stamped = stamped.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(f"NULL in a key column of {list(self.key)}")).cast("boolean")))
        return stamped.withColumn(MONTH, month_key(self.time_col))

    def write_batch(self, rows: DataFrame, batch: str) -> dict:
        """SRC-12: make prepared rows the history's batch folder ``batch``.

        The folder is overwritten, so writing a batch again (a replay after a
        failure) replaces what an earlier attempt left, however far it got.
        Returns the health of the rows, observed while they were written
        (``operators.quality.health_metrics``); no second pass counts them.
        """
        path = f"{self.append_only_path}/{BATCH}={batch}"
        watched = Observation()
        staged = clustered(rows, None, self.key, rebalance=True)
        staged = staged.observe(watched, *health_metrics(staged.columns, self.time_col))
        writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
        writer.partitionBy(MONTH).parquet(path)
        health = watched.get
        if not health["rows"]:
            fs.delete(self.spark, path)  # no rows, no folder
        return health

    def drop_batch(self, batch: str) -> None:
        fs.delete(self.spark, f"{self.append_only_path}/{BATCH}={batch}")

    def append(
        self,
        df: DataFrame,
        now: dt.datetime | None = None,
        prepared: bool = False,
        order_by: str | None = None,
        given_created_at: bool = False,
        propagate: bool = True,
    ) -> dict:
        """SRC-12 + DED-3: append rows to the history as a batch of their own,
        then let the propagation stream carry what is new to the latest table
        (``propagate=False`` leaves that to its next run).

        An empty input writes nothing.  Returns the observed health of the rows.
        """
        rows = df if prepared else self.prepare(df, now, order_by=order_by, given_created_at=given_created_at)
        health = self.write_batch(rows, f"{LOADED}-{uuid.uuid4().hex}")
        if propagate and health["rows"]:
            self.propagate()
        return health

    def propagate(self) -> None:
        """DED-3: carry every history row not yet carried to the latest table."""
        from wickline.streaming.propagate import start_propagation

        query = start_propagation(self, available_now=True)
        if query is not None:
            query.awaitTermination()

    def rebuild_latest(self, months: Iterable[int] | None = None) -> list[int]:
        """Make months of the latest table anew from the history, one job
        each; without ``months`` those that the history has and the table
        lacks (a rewrite that died in its last step)."""
        history = self.history()
        if history is None:
            return []
        listed = {int(v) for b in self.batches() for v in fs.partition_values(self.spark, f"{self.append_only_path}/{BATCH}={b}", MONTH)}
        wanted = sorted(listed - set(self.latest_table.months()) if months is None else listed & {int(m) for m in months})
        for m in wanted:
            own = history.filter(F.col(MONTH) == m)
            self.latest_table.replace_months(self.latest_table.latest(own))
        return wanted

    # ------------------------------------------------------------ reading
    def batches(self) -> list[str]:
        return fs.partition_values(self.spark, self.append_only_path, BATCH)

    def history(self) -> DataFrame | None:
        """The append-only table, duplicates included."""
        if not fs.has_data(self.spark, self.append_only_path):
            return None
        return self.spark.read.parquet(self.append_only_path).drop(BATCH)

    def latest_rows(self, months: Iterable[int] | None = None) -> DataFrame | None:
        """Raw rows of the latest table (may hold superseded versions)."""
        return self.latest_table.rows(months)

    def latest(self, months: Iterable[int] | None = None) -> DataFrame | None:
        """DED-1 view: one row per key, the latest load winning."""
        return self.latest_table.view(months)

    def compact(self, months: Iterable[int] | None = None) -> list[int]:
        """DED-2: rewrite months of the latest table (all, unless named) with
        one row per key, a month a job.  Loads may go on beside it, since they
        only write the history; the propagation stream may not."""
        return self.latest_table.compact(months)

    def register_views(self, prefix: str = "candles", widths: Sequence[str] = ()) -> dict[str, str]:
        """Temp views for SQL users: ``{prefix}_latest`` (one row per key),
        ``{prefix}_history`` (every loaded row) and ``{prefix}_<width>`` per
        rollup.  A view captures the file listing when it is made, so
        re-register after loads."""
        frames = {f"{prefix}_latest": self.latest(), f"{prefix}_history": self.history()}
        for w in widths:
            frames[f"{prefix}_{_slug(w)}"] = self.read_rollup(w)
        made = {}
        for name, df in frames.items():
            if df is not None:
                df.createOrReplaceTempView(name)
                made[name] = name
        return made

    def optimize_history(self, min_batches: int = 8) -> list[str]:
        """Merge the small batches that loads leave into one, every row kept,
        duplicates included; returns the batches merged.

        Everything is propagated first, so the stream never misses a merged
        batch.  A stream's newest batch stays, since that is the one a restart
        may write again.  A failure between the write and the last step leaves
        rows twice in the history, as a repeated load does.
        """
        listed = self.batches()
        self.propagate()
        newest: dict[str, int] = {}
        for b in listed:
            if b.startswith(f"{STREAMED}-"):
                stream, number = b.rsplit("-", 1)
                newest[stream] = max(newest.get(stream, -1), int(number))
        kept = {f"{stream}-{number}" for stream, number in newest.items()}
        size = {b: fs.size_bytes(self.spark, f"{self.append_only_path}/{BATCH}={b}") for b in listed}
        small = [b for b in listed if b not in kept and size[b] < TARGET_FILE_BYTES / 4]
        if len(small) < min_batches:
            return []
        paths = [f"{self.append_only_path}/{BATCH}={b}" for b in small]
        rows = self.spark.read.option("basePath", self.append_only_path).parquet(*paths).drop(BATCH)
        parts = self.partitions or partitions_for(sum(size[b] for b in small))
        merged = clustered(rows, parts, self.key).write.mode("errorifexists").option("compression", "zstd").partitionBy(MONTH)
        merged.parquet(f"{self.append_only_path}/{BATCH}={MERGED}-{uuid.uuid4().hex}")
        for b in small:
            self.drop_batch(b)
        return small

    def slice(
        self,
        symbol: str,
        start: dt.datetime | None = None,
        end: dt.datetime | None = None,
        limit: int | None = None,
        interval: str | None = None,
    ) -> DataFrame:
        """SRC-2 on the stored tables.  The interval ("5m" or "5 minutes";
        an unknown name raises) picks the table: the base candles
        (``base_interval``) or a rollup of that width.  Month partitions
        outside [start, end] are never read, and the symbol and time
        predicates reach the parquet reader (below the deduplication
        window).  Without data the result is empty."""
        base = interval is None or width_name(interval) == width_name(self.base_interval)
        table = self.latest_table if base else self.rollup_table(interval)
        lo = start.year * 100 + start.month if start else None
        hi = end.year * 100 + end.month if end else None
        months = [m for m in table.months() if (lo is None or m >= lo) and (hi is None or m <= hi)]
        view = table.view(months)
        if view is None:
            view = self.spark.createDataFrame([], CANDLE).withColumn(MONTH, F.lit(0))
        return slice_klines(view, symbol, start, end, limit)

    # ------------------------------------------------------------ rollups
    def read_rollup(self, width: str = "5 minutes") -> DataFrame | None:
        """The rollup table: one row per (symbol, open_time)."""
        return self.rollup_table(width).view()

    def rollup_high_water(self, width: str = "5 minutes") -> dt.datetime | None:
        """max(open_time) of a rollup table, reading only its newest month.

        The month list comes from the folder listing; only the newest
        non-empty month is scanned (one column).
        """
        table = self.rollup_table(width)
        for m in reversed(table.months()):
            value = table.rows([m]).agg(F.max("open_time").alias("hw")).first()["hw"]
            if value is not None:
                return value
        return None

    def refresh_rollup(self, width: str = "5 minutes", full_refresh: bool = False) -> dict:
        """AGG-3 + FLT-3 + DED-4: the incremental rollup model.

        First run (or ``full_refresh``): roll up everything in one job.
        Later runs: base rows after the target's high water are rolled up (one
        shuffle: dedup and bucket in one window) and upserted by key into the
        months at or after it.  The high water is global and strict, so late
        or revised rows at or before it wait for a full refresh.
        """
        table = self.rollup_table(width)
        if not self.latest_table.exists():
            return {"mode": "empty", "high_water": None, "months": []}
        if full_refresh or not table.exists():
            table.replace_all(self._rolled(self.latest_rows(), width))
            return {"mode": "full", "high_water": None, "months": table.months()}
        hw = self.rollup_high_water(width) or EPOCH
        # only months at or after the high water's month are listed and read;
        # a wide bucket may start in the month before
        months = [m for m in self.latest_table.months() if m >= hw.year * 100 + hw.month]
        new = self._rolled(after_high_water(self.latest_rows(months), hw), width)
        touched = table.upsert(new, months if self._stays_in_month(width) else None)
        return {"mode": "incremental", "high_water": hw, "months": touched}

    @staticmethod
    def _rolled(rows: DataFrame, width: str) -> DataFrame:
        return rollup_last(rows.drop(MONTH), width).withColumn(MONTH, month_key("open_time"))

    @staticmethod
    def _stays_in_month(width: str) -> bool:
        """Whether every bucket of this width lies in one month."""
        n, unit = parse_width(width)
        return unit == "month" or (unit in ("second", "minute", "hour", "day") and 86400 % width_seconds(width) == 0)

    def upsert(self, new: DataFrame, width: str = "5 minutes", months: Iterable[int] | None = None) -> list[int]:
        """DED-4 on disk: rows of ``new`` replace rows of the rollup with the
        same key, all others are kept; only their months are rewritten."""
        return self.rollup_table(width).upsert(new, months)


def newest_load_order() -> list[Column]:
    """SRT-3: newest load first, then by key."""
    return [F.col(VERSION).desc(), F.col(LOAD_SEQ).desc(), *[F.col(k) for k in KEY]]


def newest_load_first(df: DataFrame) -> DataFrame:
    """SRT-3: history ordered newest load first, then by key."""
    return df.orderBy(*newest_load_order())
