"""Landing files: the 13-column parquet written per symbol (SRC-4) and read
back for loading (SRC-5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.operators.quality import assert_landing_schema
from wickline.plans import fs
from wickline.schemas import LANDING, LANDING_COLUMNS, LOAD_SEQ


# Most rows of one landing file.
ROWS_PER_FILE = 2_000_000


def _run_stamp(run_time: dt.datetime | None) -> str:
    run_time = run_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return run_time.strftime("%Y%m%d%H%M%S%f")


def to_landing(df: DataFrame) -> DataFrame:
    """Cast a parsed page to the exact landing schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LANDING.fields])


def landing_text(df: DataFrame) -> DataFrame:
    """Typed candles -> the text landing form (prices as exact text, close_time as epoch ms)."""
    from wickline.functions.time import to_epoch_millis

    out = []
    for f in LANDING.fields:
        if f.name == "close_time":
            out.append(to_epoch_millis(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*out, *[c for c in df.columns if c not in LANDING_COLUMNS])


def write_landing(
    df: DataFrame, base: str, run_time: dt.datetime | None = None, order_by: tuple[str, ...] = (), partitions: int | None = None
) -> str | None:
    """Write landing rows as zstd parquet, one folder per symbol; no rows, no files.

    Layout ``{base}/run={stamp}/pair={symbol}/part-*.parquet``: the run stamp
    is the caller's time at microsecond resolution, so every run writes
    fresh names (the file stream never re-reads a name it committed).
    Rows stay in the files with all 13 columns.  ``order_by`` names extra
    columns of ``df`` that order rows of the same (symbol, open_time) inside
    a file (the loader lets the later row win); they are not written.
    ``partitions`` sizes the range shuffle of a large write (AQE merges range
    partitions but never splits them); files hold at most ``ROWS_PER_FILE``
    rows whatever its size, and where a file ends within the rows of a key the
    next file is the later one.
    Returns the run folder, or None where nothing was written.
    """
    landing = to_landing(df)
    assert_landing_schema(landing)
    known = fs.exists(df.sparkSession, base)
    out = f"{base.rstrip('/')}/run={_run_stamp(run_time)}"
    ranges = ([partitions] if partitions else []) + ["symbol", "open_time"]
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LANDING.fields], *order_by)
    (
        rows.withColumn("pair", F.col("symbol"))
        # Range partitions split a hot symbol by time and keep a key in one
        # file; AQE merges small ones.
        .repartitionByRange(*ranges)
        .sortWithinPartitions("pair", "symbol", "open_time", *order_by)
        .drop(*order_by)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("pair")
        .parquet(out)
    )
    if fs.has_data(df.sparkSession, out):
        return out
    fs.delete(df.sparkSession, out)
    if not known:
        fs.delete_if_empty(df.sparkSession, base)  # another run may have landed there meanwhile
    return None


def with_file_sequence(df: DataFrame, load_ms: int) -> DataFrame:
    """Attach the load order of every row: (load time, file time, file path, row in file).

    Used to break created_at ties: within one load the later file, then the
    later row of a file, wins.  ``row_index`` is the row number in the file.
    """
    seq = F.struct(
        F.lit(load_ms).cast("long").alias("load_ms"),
        F.unix_millis(F.col("_metadata.file_modification_time")).alias("file_ms"),
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.row_index").cast("long").alias("row"),
    )
    return df.withColumn(LOAD_SEQ, seq)


def read_landing(spark: SparkSession, *paths: str) -> DataFrame:
    """Read landing parquet.  A file that is not parquet fails the read.

    ``ignoreCorruptFiles`` is never set: it would drop a bad file silently.
    Folders like ``year=2025/`` stay folders, not columns.
    """
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", "false")
        .parquet(*paths)
    )
