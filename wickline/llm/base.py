"""Reading tables, staging intermediate results and running Arrow functions."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2000
#: Stands in for a null document id inside an operator: it sorts after every real id.
NULL_ID = 2**63 - 1


def workers_can_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def bounded_batches(spark: SparkSession) -> None:
    """Rows of an Arrow batch are whole texts here, so the default number of
    rows would hold tens of MB in the JVM and in Python alike.  A number that
    the user has chosen stays."""
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, str(BATCH_ROWS))


def release() -> None:
    """Give memory that a worker has freed back to the machine: workers live
    on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: Empties what a worker keeps between tasks, and the stage it was kept for.
_FORGET: list[Callable[[], object]] = []
_stage: int | None = None


def forget_after_stage(clear: Callable[[], object]) -> None:
    """Have ``clear`` called before a worker's first task of another stage."""
    _FORGET.append(clear)


def kept_for_stage(make: Callable) -> Callable:
    """Remember what ``make`` gives as long as a worker's tasks are of one stage."""
    cached = lru_cache(maxsize=4)(make)
    forget_after_stage(cached.cache_clear)
    return cached


def begin_task() -> None:
    """Drop what was kept for another stage: a worker goes on to other
    operators, whose memory would come on top of it."""
    global _stage
    task = TaskContext.get()
    now = task.stageId() if task else None
    if now == _stage:
        return
    for clear in _FORGET:
        clear()
    _stage = now
    gc.collect()
    release()


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a folder of this
    machine only where that is unset and Spark runs in this one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    folder = tempfile.mkdtemp(prefix="wickline-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def partitions_for(spark: SparkSession, rows: int, each: int) -> int:
    """Partitions of about ``each`` rows, but three a core at least."""
    return max(3 * spark.sparkContext.defaultParallelism, -(-rows // each))


def staged(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    and a lost executor costs no work that is already written.  ``most``: in so
    many partitions at most.  Without native code Hadoop's local file system
    starts processes for each file, and until one runs its own program it
    counts as large as its executor."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df = df if most is None else df.coalesce(most)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete a table that :func:`staged` wrote and no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def with_ids(df: DataFrame, id_col: str, *columns: str) -> DataFrame:
    """``__id`` (long, never null) and the named columns, whatever else ``df`` holds."""
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("__id"), *[F.col(c) for c in columns])


def real_id(column: str = "__id"):
    """The document id back from ``__id``."""
    return F.when(F.col(column) != NULL_ID, F.col(column))


def arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if out is not None:
                    yield out

    return arrow_iter(df, run, schema)


def arrow_iter(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``fn`` to the iterator of a partition's Arrow batches."""
    workers_can_import(df.sparkSession)
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        yield from fn(batches)
        release()

    return df.mapInArrow(run, schema)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))
