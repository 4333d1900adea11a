"""Continuous and on-demand loading of landing files (STR-1..5) and of live
message streams (STR-6).

Landing files are discovered by a ``binaryFile`` stream that lists names
only (the content column is never read).  For each micro-batch of at most
``max_files`` names ``foreachBatch`` reads the footers in one distributed job
(``sources.footers``) and writes the rows of all good files as one batch folder
of the history in one more.  It raises if any file was bad.  The checkpoint
commits a batch only after ``foreachBatch`` returns, so a failed batch is
retried whole on restart, and the retry overwrites the batch's own folder: each
file reaches the append-only table once, wherever an attempt died.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wickline.functions.convert import stamp, type_klines
from wickline.functions.time import epoch_ntz, month_key
from wickline.plans import fs
from wickline.plans.store import LOADED, STREAMED, CandleStore
from wickline.schemas import CANDLE_COLUMNS, LOAD_SEQ
from wickline.session import scratch_path
from wickline.sources.footers import FOOTERS, decoded_path, has_nanos, listed_names, names_of, norm_path, read_footers, resolved, shape_schema
from wickline.sources.landing import with_file_sequence
from wickline.sources.payloads import (
    kline_problem,
    parse_stream_klines,
    parse_tickers,
    split_rejects,
    ticker_problem,
    type_stream_klines,
    type_tickers,
)

# Files per batch and pause between batches.
MAX_FILES_PER_BATCH = 10
POLL_SECONDS = 5

BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


class BatchLoadError(RuntimeError):
    """Some files of a batch failed; the batch is not committed."""

    def __init__(self, report: list[tuple[str, str, int, str | None]]):
        self.report = report
        failed = [r[0] for r in report if r[1] != "loaded"]
        super().__init__(f"{len(failed)} of {len(report)} files failed: {failed}")


def landing_file_stream(
    spark: SparkSession,
    base: str,
    max_files: int = MAX_FILES_PER_BATCH,
    glob: str = "*.parquet",
    archive_dir: str | None = None,
) -> DataFrame:
    """SRC-6 / FLT-2: new ``*.parquet`` names under ``base``, at most ``max_files`` per batch.

    Nested folders (``year=2025/``) are searched and never become columns.
    Zero-byte files are never listed.  A file's age never matters.  A name already committed is not read
    again, so writers must use fresh names.  The source lists ``base`` on
    every trigger; with ``archive_dir`` the files of each committed batch
    are moved there (``cleanSource=archive``), which keeps that listing to
    the files still waiting.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files)
        # the default skips files a week older than the newest one seen
        .option("maxFileAge", "36500d")
    )
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(base).select("path", "length", "modificationTime")


def _short(e: BaseException) -> str:
    return f"{type(e).__name__}: {str(e).splitlines()[0][:300] if str(e) else ''}"


@dataclass
class LoadResult:
    """``report`` has a row a file (``backfill``: the failed ones only),
    ``health`` the metrics observed while the rows were written."""

    report: list[tuple[str, str, int, str | None]]
    health: dict = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return all(r[1] == "loaded" for r in self.report)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.report, REPORT_SCHEMA)


def _nanos_session(spark: SparkSession) -> SparkSession:
    """A session of its own that reads INT64 nanosecond timestamps (which
    Spark rejects) as longs, so no setting of the caller's session changes."""
    session = spark.newSession()
    session.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return session


def _time_columns(columns: Sequence[str], time_col: str) -> list[str]:
    return [c for c in (time_col, "close_time", columns[-1]) if c in columns]


def _read_shapes(
    spark: SparkSession, shapes: dict[str, Sequence[str]], columns: Sequence[str], time_col: str, load_ms: int = 0, tolerant: bool = False
) -> DataFrame:
    """Files by shape (``sources.footers``) as typed rows with their load order
    and ``__bad``: whether a required value is NULL or no number.  A file whose
    pages cannot be read fails the scan; a ``tolerant`` one reads what it can."""
    frames = []
    for shape, paths in shapes.items():
        nanos, schema = has_nanos(shape), shape_schema(shape)
        reader = (_nanos_session(spark) if nanos else spark).read
        reader = reader.option("ignoreCorruptFiles", str(tolerant).lower()).option("recursiveFileLookup", "true").option("pathGlobFilter", "*")
        # the schema read from the footers: no inference job
        reader = reader.schema(schema) if schema is not None else reader
        raw = with_file_sequence(reader.parquet(*paths), load_ms)
        if nanos:
            raw = _nanos_to_ntz(raw, _time_columns(columns, time_col))
        # the load stamp replaces any value the file carries
        frames.append(_typed(raw, columns, strict=False).drop(columns[-1]))
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    bad = F.lit(False)
    for c in columns[:-1]:
        bad = bad | F.col(c).isNull()
    return rows.withColumn("__bad", bad)


def corrupt_file_report(
    spark: SparkSession, footers: DataFrame, columns: Sequence[str] = tuple(CANDLE_COLUMNS), time_col: str = "open_time", shapes: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """STR-4: which files cannot be loaded whole, by reconciliation.

    One tolerant scan of all files with a good footer counts by file the rows
    that can be read and those with a missing or invalid value; a join with the
    rows that the footers promise names the files that come short.  No file is
    tried by itself.  ``path``, ``rows`` (promised), ``rows_read``, ``bad_rows``
    and ``error`` (null: whole) of every file; unreadable footers included.
    """
    if shapes is None:
        grouped = footers.where("error IS NULL").groupBy("shape").agg(F.collect_list("path").alias("paths")).collect()
        shapes = {r["shape"]: r["paths"] for r in grouped}
    keyed = footers.withColumn("__key", norm_path(F.col("path")))
    if not shapes:
        return footers.select("path", "rows", F.lit(0).cast("long").alias("rows_read"), F.lit(0).cast("long").alias("bad_rows"), "error")
    rows = _read_shapes(spark, shapes, columns, time_col, tolerant=True)
    read = rows.groupBy(F.col(f"{LOAD_SEQ}.source").alias("source")).agg(F.count(F.lit(1)).alias("rows_read"), F.count_if("__bad").alias("bad_rows"))
    read = read.groupBy(decoded_path(F.col("source")).alias("__key")).agg(F.sum("rows_read").alias("rows_read"), F.sum("bad_rows").alias("bad_rows"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    short = F.concat(zero("rows_read").cast("string"), F.lit(" of "), F.col("rows").cast("string"), F.lit(" rows can be read"))
    bad = F.concat(F.col("bad_rows").cast("string"), F.lit(" rows with NULL or invalid values in required columns"))
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(zero("rows_read") < F.col("rows"), short).when(zero("bad_rows") > 0, bad)
    return keyed.join(read, "__key", "left").select("path", "rows", zero("rows_read").alias("rows_read"), zero("bad_rows").alias("bad_rows"), error.alias("error"))


def _write_rows(
    spark: SparkSession, shapes: dict[str, Sequence[str]], store: CandleStore, batch: str, now: dt.datetime | None, promised: int
) -> dict:
    """STR-5: the rows of good files as one batch of the history, in one job.
    A page that cannot be read or an invalid value fails the job, and then
    nothing of it is published."""
    load_ms = int(time.time() * 1000)
    columns = list(store.columns)
    rows = _read_shapes(spark, shapes, columns, store.time_col, load_ms)
    valid = F.when(~F.col("__bad"), F.lit(True)).otherwise(F.raise_error(F.lit("NULL or invalid values in required columns")).cast("boolean"))
    health = store.write_batch(store.prepare(rows.filter(valid).drop("__bad"), now=now, load_ms=load_ms, check_keys=False), batch)
    if health["rows"] != promised:
        store.drop_batch(batch)
        raise RuntimeError(f"{health['rows']} rows read where the footers promise {promised}")
    return health


def load_files(
    spark: SparkSession,
    paths: Sequence[str] | DataFrame,
    store: CandleStore,
    now: dt.datetime | None = None,
    batch: str | None = None,
    propagate: bool = True,
) -> LoadResult:
    """STR-4 + STR-5: load a batch of landing files, isolating bad ones.

    One job reads every file's footer (DQ-2), so an unreadable file or one
    with other columns is reported and skipped.  One more job reads the good
    files, types and stamps them with one load time and writes them as one
    batch of the history; their health (DQ-1) is observed on the way.  Only if
    that job fails (broken pages behind a good footer, an unparsable number)
    :func:`corrupt_file_report` names the files at fault in one scan, and the
    others are written.  ``batch`` names the batch folder, which is replaced.
    """
    batch = batch or f"{LOADED}-{uuid.uuid4().hex}"
    columns = list(store.columns)
    names = paths if isinstance(paths, DataFrame) else names_of(spark, paths)
    listed = read_footers(names, columns).collect()  # one row a file of the batch
    if not listed:
        return LoadResult([])
    footers = resolved(spark, spark.createDataFrame(listed, FOOTERS), columns)
    found = {r["path"]: r for r in footers.collect()}
    good = {p: r for p, r in found.items() if r["error"] is None}
    report = {p: (p, "failed", 0, r["error"]) for p, r in found.items() if r["error"] is not None}
    health: dict = {}
    if good:
        try:
            health = _write_rows(spark, _by_shape(good), store, batch, now, sum(r["rows"] for r in good.values()))
        except Exception:
            broken = corrupt_file_report(spark, footers, columns, store.time_col, _by_shape(good)).where("error IS NOT NULL").collect()
            at_fault = {r["path"]: r["error"] for r in broken if r["path"] in good}
            if not at_fault:
                raise
            report |= {p: (p, "failed", 0, e) for p, e in at_fault.items()}
            good = {p: r for p, r in good.items() if p not in at_fault}
            if good:
                health = _write_rows(spark, _by_shape(good), store, batch, now, sum(r["rows"] for r in good.values()))
    if not good:
        store.drop_batch(batch)  # an earlier attempt may have written it
    elif propagate:
        store.propagate()
    report |= {p: (p, "loaded", r["rows"], None) for p, r in good.items()}
    order = list(paths) if not isinstance(paths, DataFrame) else sorted(report)
    return LoadResult([report[p] for p in order if p in report], health)


def _by_shape(files: dict) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for p, r in files.items():
        out.setdefault(r["shape"], []).append(p)
    return out


def _nanos_to_ntz(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Epoch-nanosecond longs of the known time columns -> NTZ UTC wall clock."""
    out = df
    for c in cols:
        if c in df.columns and isinstance(df.schema[c].dataType, T.LongType):
            out = out.withColumn(c, F.timestamp_add("MICROSECOND", F.floor(F.col(c) / 1000).cast("long"), epoch_ntz()))
    return out


def _typed(raw: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Candle files are typed by name (both landing shapes); other tables are
    taken as they are, in the configured column order."""
    if list(columns) == CANDLE_COLUMNS:
        return type_klines(raw, keep=(LOAD_SEQ,), strict=strict)
    present = [c for c in columns[:-1]]
    return raw.select(*present, LOAD_SEQ)


def backfill(spark: SparkSession, base: str, store: CandleStore, now: dt.datetime | None = None) -> LoadResult:
    """Load a whole landing folder: one job for all footers, one for all rows.

    Every file passes the checks of ``load_files``; both landing shapes may
    lie in one folder.  One bad file raises ``BatchLoadError`` and nothing is
    loaded.  However many files there are, the number of jobs is fixed and the
    driver gets the shapes and the failures only (the names too where files of
    several shapes lie in one folder, since each shape is read by itself).
    Running it again loads the files again (the latest view is unaffected);
    the file stream is the idempotent path.
    """
    columns = list(store.columns)
    table = scratch_path(spark, "footers")
    try:
        read_footers(listed_names(spark, base), columns).write.parquet(table)
        footers = resolved(spark, spark.read.schema(FOOTERS).parquet(table), columns)
        shapes = footers.groupBy("shape", F.col("error").isNull().alias("good")).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")).collect()
        if not shapes:
            return LoadResult([])
        failed = _failures(footers) if any(not r["good"] for r in shapes) else []
        if not failed:
            if len(shapes) == 1:
                paths = {shapes[0]["shape"]: [base]}
            else:
                paths = _by_shape({r["path"]: r for r in footers.select("path", "shape").collect()})
            try:
                health = _write_rows(spark, paths, store, f"{LOADED}-{uuid.uuid4().hex}", now, sum(r["rows"] for r in shapes))
            except Exception:
                failed = _failures(corrupt_file_report(spark, footers, columns, store.time_col, paths))
                if not failed:
                    raise
        if failed:
            raise BatchLoadError(failed)
    finally:
        fs.delete(spark, table)
    store.propagate()
    return LoadResult([], health)


def _failures(files: DataFrame) -> list[tuple[str, str, int, str | None]]:
    return [(r["path"], "failed", 0, r["error"]) for r in files.where("error IS NOT NULL").select("path", "error").orderBy("path").collect()]


def _stream_batch(session: SparkSession, batch_id: int) -> str:
    """The history folder of a micro-batch: the query's id stays with its
    checkpoint, so a replay has the same one and a fresh checkpoint another."""
    query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{STREAMED}-{query}-{batch_id}"


def start_ingest(
    spark: SparkSession,
    landing_base: str,
    store: CandleStore,
    checkpoint: str,
    available_now: bool = False,
    poll_seconds: int = POLL_SECONDS,
    max_files: int = MAX_FILES_PER_BATCH,
    quarantine: str | None = None,
    reports: list | None = None,
    archive_dir: str | None = None,
) -> StreamingQuery:
    """STR-1 (continuous, a batch every ``poll_seconds``) or STR-2 (``available_now``:
    drain what is waiting in batches of ``max_files``, then stop).

    STR-3: a batch with a bad file raises after its good files are written,
    so the checkpoint does not commit it and a restart retries the batch into
    the same folder of the history.  With ``quarantine`` (a folder) failures
    are recorded there and the batch commits instead.  The latest table is fed
    by a query of its own (``streaming.propagate.start_propagation``).
    ``query.stop()`` stops gracefully between batches.
    """

    def run_batch(files: DataFrame, batch_id: int) -> None:
        session = files.sparkSession
        batch = _stream_batch(session, batch_id)
        result = load_files(session, files, store, batch=batch, propagate=False)
        if reports is not None:
            reports.append((batch_id, result.report))
        if result.ok:
            return
        if quarantine:
            failed = [r for r in result.report if r[1] != "loaded"]
            session.createDataFrame(failed, REPORT_SCHEMA).write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={batch}")
            return
        raise BatchLoadError(result.report)

    writer = (
        landing_file_stream(spark, landing_base, max_files, archive_dir=archive_dir)
        .writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{poll_seconds} seconds")
    return writer.start()


def run_once(spark: SparkSession, landing_base: str, store: CandleStore, checkpoint: str, **kw) -> StreamingQuery:
    """Load everything waiting now, wait for it (STR-2), and carry what was
    loaded to the latest table, also where a bad batch ends the load."""
    q = start_ingest(spark, landing_base, store, checkpoint, available_now=True, **kw)
    try:
        q.awaitTermination()
    finally:
        store.propagate()
    return q


# ---------------------------------------------------------------- STR-6


def stream_candles(messages: DataFrame, body_col: str = "body", load_ms: int = 0) -> DataFrame:
    """Live candle messages -> typed candles with a load order by event time.

    Within one batch every row gets the same load stamp, so the tie is broken
    by the message's event time, then by its trade count, which only grows:
    the later update of a candle wins however the messages are partitioned.
    """
    parsed = parse_stream_klines(messages, body_col)
    typed = type_stream_klines(parsed, keep=("event_ms",))
    return typed.withColumn(
        LOAD_SEQ,
        F.struct(
            F.lit(load_ms).cast("long").alias("load_ms"),
            F.col("event_ms").alias("file_ms"),
            F.lit("stream").alias("source"),
            F.col("number_of_trades").cast("long").alias("row"),
        ),
    ).drop("event_ms")


def stream_tickers(messages: DataFrame, body_col: str = "body") -> DataFrame:
    return type_tickers(parse_tickers(messages, body_col))


def start_message_ingest(
    messages: DataFrame,
    store: CandleStore,
    checkpoint: str,
    kind: str = "kline",
    body_col: str = "body",
    ticker_path: str | None = None,
    available_now: bool = False,
    poll_seconds: int = POLL_SECONDS,
    reject_path: str | None = None,
) -> StreamingQuery:
    """STR-6: any streaming DataFrame with a string body -> candle or ticker tables.

    Each batch has a folder of its own that a replay overwrites: in the
    history for candles (the propagation query carries them on from there), in
    ``ticker_path`` for tickers, which have no key that could tell a repeated
    row.  A message that cannot be read fails the batch; with ``reject_path``
    it is written there with its reason (one folder a batch, too) and the
    others are loaded.
    """
    if kind not in ("kline", "ticker"):
        raise ValueError("kind must be 'kline' or 'ticker'")
    if kind == "ticker" and not ticker_path:
        raise ValueError("ticker_path is required for tickers")

    problem = kline_problem(F.col(body_col)) if kind == "kline" else ticker_problem(F.col(body_col))

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        load_ms = int(time.time() * 1000)
        name = _stream_batch(batch.sparkSession, batch_id)
        if reject_path:
            batch, rejects = split_rejects(batch, problem, body_col)
            rejects.write.mode("overwrite").parquet(f"{reject_path.rstrip('/')}/batch={name}")
        if kind == "kline":
            store.write_batch(store.prepare(stream_candles(batch, body_col, load_ms), load_ms=load_ms), name)
        else:
            now = dt.datetime.fromtimestamp(load_ms / 1000, dt.timezone.utc).replace(tzinfo=None)
            tickers = stamp(stream_tickers(batch, body_col), ["symbol", "price", "time", "created_at"], now=now)
            tickers = tickers.withColumn("open_month", month_key("time"))
            tickers.write.mode("overwrite").partitionBy("open_month").parquet(f"{ticker_path.rstrip('/')}/batch={name}")

    writer = messages.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{poll_seconds} seconds")
    return writer.start()
