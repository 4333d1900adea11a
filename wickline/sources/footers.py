"""Footers of many parquet files, read by tasks (SRC-5, DQ-2).

One Spark job over file names: each task opens its files, reads the footer
alone and checks columns and types, so 10,000 files cost the driver one job.
Tasks read through the file systems that pyarrow knows.  Files of a store that
it does not reach are read by Spark's own binary file source in a second job
(whole, since Spark has no reader of a file's end).
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.operators.quality import SchemaError, assert_schema
from wickline.plans import fs
from wickline.schemas import CANDLE_COLUMNS
from wickline.session import workers_can_import

ROW_GROUPS = "path string, row_group int, rows long, least string, greatest string"
FOOTERS = "path string, rows long, row_groups int, shape string, error string"
#: Stands in ``error`` for a file that no task could open; never returned.
_UNREACHED = "unreached"
#: Column type of a shape that Spark cannot be told ahead, so it looks itself.
OTHER = "other"
#: Spark reads nanosecond times as longs only under a legacy setting.
NANOS = "nanos"
#: Footers read by one task at least, where names come as a list.
FILES_PER_TASK = 16


def norm_path(p: Column) -> Column:
    """One spelling of a path: ``_metadata.file_path`` is a URL-encoded URI,
    listings give plain paths."""
    return F.regexp_replace(p, "^file:/+", "/")


def decoded_path(p: Column) -> Column:
    return norm_path(F.url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))))


def _spark_type(column: pq.ColumnSchema) -> str:
    """How Spark reads a plain column of a parquet file."""
    physical, logical = column.physical_type, str(column.logical_type)
    if logical.startswith("Timestamp"):
        if "nanoseconds" in logical:
            return NANOS
        return "timestamp" if "isAdjustedToUTC=true" in logical else "timestamp_ntz"
    if physical == "INT96":
        return "timestamp"
    if logical in ("String", "Enum"):
        return "string"
    if logical == "None" or logical.startswith("Int("):
        plain = {"DOUBLE": "double", "FLOAT": "float", "BOOLEAN": "boolean", "BYTE_ARRAY": "binary", "INT64": "bigint", "INT32": "int"}
        if logical == "None" or logical in ("Int(bitWidth=64, isSigned=true)", "Int(bitWidth=32, isSigned=true)"):
            return plain.get(physical, OTHER)
    return OTHER


def shape_of(footer: pq.FileMetaData) -> list[tuple[str, str]]:
    """(name, type) of the top-level columns of a file."""
    out: dict[str, str] = {}
    for i in range(footer.num_columns):
        column = footer.schema.column(i)
        name = column.path.split(".", 1)[0]
        out[name] = _spark_type(column) if column.path == name and column.max_repetition_level == 0 else OTHER
    return list(out.items())


def shape_schema(shape: str) -> T.StructType | None:
    """The Spark schema of a shape; None where Spark has to look itself."""
    fields = [f.rsplit(" ", 1) for f in shape.split("\n")]
    if any(kind == OTHER for _, kind in fields):
        return None
    types = {NANOS: T.LongType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(), "string": T.StringType(), "double": T.DoubleType(),
             "float": T.FloatType(), "boolean": T.BooleanType(), "binary": T.BinaryType(), "bigint": T.LongType(), "int": T.IntegerType()}
    return T.StructType([T.StructField(name, types[kind]) for name, kind in fields])


def has_nanos(shape: str) -> bool:
    return any(f.endswith(f" {NANOS}") for f in shape.split("\n"))


def _problem(shape: str, columns: Sequence[str]) -> str | None:
    names = T.StructType([T.StructField(f.rsplit(" ", 1)[0], T.NullType()) for f in shape.split("\n")])
    try:
        assert_schema(names, columns, optional=(columns[-1],), check_types=False)
        schema = shape_schema(shape)
        if list(columns) == CANDLE_COLUMNS and not has_nanos(shape):
            if schema is None:
                raise SchemaError(f"unexpected column types: {[f for f in shape.split(chr(10)) if f.endswith(OTHER)]}")
            assert_schema(schema, columns, optional=(columns[-1],))
    except SchemaError as e:
        return f"SchemaError: {e}"
    return None


def _open(path: str) -> pa.NativeFile:
    if path.startswith("/") or path.startswith("file:"):
        return pa.OSFile("/" + path.removeprefix("file:").lstrip("/"))
    store, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return store.open_input_file(inner)


def _checked(footers: Callable[[dict], Iterator[tuple[str, pa.NativeFile | io.BytesIO | None]]], columns: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for path, file in footers(b.to_pydict()):
                if file is None:
                    out.append((path, None, None, None, _UNREACHED))
                    continue
                try:
                    meta = pq.read_metadata(file)
                    shape = "\n".join(f"{n} {t}" for n, t in shape_of(meta))
                    out.append((path, meta.num_rows, meta.num_row_groups, shape, _problem(shape, columns)))
                except (pa.ArrowException, OSError) as e:
                    out.append((path, None, None, None, f"{type(e).__name__}: {str(e).splitlines()[0][:300] if str(e) else ''}"))
                finally:
                    file.close()
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string())
            cols = zip(*out, strict=True) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["path", "rows", "row_groups", "shape", "error"])

    return run


def _named(rows: dict):
    for path in rows["path"]:
        try:
            file = _open(path)
        except (OSError, ValueError, pa.ArrowException):
            file = None
        yield path, file


def _held(rows: dict):
    for path, content in zip(rows["path"], rows["content"], strict=True):
        yield path, io.BytesIO(content)


def names_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A frame of the given file names, dealt over tasks."""
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    return df.repartition(max(1, min(len(paths) // FILES_PER_TASK, spark.sparkContext.defaultParallelism)))


def listed_names(spark: SparkSession, base: str, glob: str = "*.parquet") -> DataFrame:
    """Names of the files under a folder; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return reader.load(base).select("path")


def read_footers(names: DataFrame, columns: Sequence[str] = tuple(CANDLE_COLUMNS)) -> DataFrame:
    """``path``, ``rows``, ``row_groups``, ``shape`` (a ``name type`` a line)
    and ``error`` of every file of ``names``: null, or why the file cannot be
    loaded as ``columns`` (unreadable footer, missing, unknown or wrongly typed
    columns; the last column may be missing).  One job; write or collect the
    result, then pass it through :func:`resolved`."""
    workers_can_import(names.sparkSession)
    return names.select("path").mapInArrow(_checked(_named, list(columns)), FOOTERS)


def resolved(spark: SparkSession, found: DataFrame, columns: Sequence[str] = tuple(CANDLE_COLUMNS)) -> DataFrame:
    """``found`` (rows of :func:`read_footers`, stored) with those files read
    through Spark that no task could open; a missing file is an error."""
    lost = [r["path"] for r in found.where(F.col("error") == _UNREACHED).select("path").collect()]
    if not lost:
        return found
    kept = found.where(F.coalesce(F.col("error") != _UNREACHED, F.lit(True)))
    reader = spark.read.format("binaryFile").option("ignoreMissingFiles", "true")
    try:
        held = reader.load(lost)
    except AnalysisException:  # some name is gone: Spark refuses the whole list
        there = [p for p in lost if fs.exists(spark, p)]
        held = reader.load(there) if there else None
    seen = []
    if held is not None:
        read = held.select("path", "content").mapInArrow(_checked(_held, list(columns)), FOOTERS)
        seen = read.select(norm_path(F.col("path")).alias("path"), "rows", "row_groups", "shape", "error").collect()
    by_path = {r["path"]: tuple(r)[1:] for r in seen}
    plain = {p: "/" + p.removeprefix("file:").lstrip("/") if p.startswith("file:") else p for p in lost}
    again = [(p, *by_path.get(plain[p], (None, None, None, "file not found"))) for p in lost]
    return kept.unionByName(spark.createDataFrame(again, FOOTERS))


def row_group_ranges(names: DataFrame, column: str) -> DataFrame:
    """``path``, ``row_group``, ``rows`` and the ``least`` and ``greatest`` value
    (as text) of a column in every row group, from the footers alone: what a
    reader may skip by.  A group without statistics has NULLs."""
    workers_can_import(names.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for path in b.to_pydict()["path"]:
                with _open(path) as file:
                    meta = pq.read_metadata(file)
                places = [i for i in range(meta.num_columns) if meta.schema.column(i).path == column]
                if not places:
                    raise ValueError(f"{path} has no column {column}")
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    stats = group.column(places[0]).statistics
                    known = stats is not None and stats.has_min_max
                    out.append((path, g, group.num_rows, str(stats.min) if known else None, str(stats.max) if known else None))
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string())
            cols = zip(*out, strict=True) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["path", "row_group", "rows", "least", "greatest"])

    return names.select("path").mapInArrow(run, ROW_GROUPS)


def layout_skips(names: DataFrame, values: DataFrame, column: str = "symbol") -> DataFrame:
    """SRT-1: by value of a text column, the row groups of the files and how
    many of them a reader of that value cannot skip (``overlaps``).  A group
    without statistics can never be skipped.

    ``values`` has one column, ``column``.  A value meets the groups that begin
    at or before it less those that end before it, so no group is compared with
    each value: groups are counted by their bounds, and one running sum goes
    over the distinct bounds and values (values of the column all of them, so
    as many rows as the report has lines, whatever the number of groups).
    """
    groups = row_group_ranges(names, column)
    ends = F.explode(F.array(F.struct(F.col("least").alias("v"), F.lit(1).alias("begin"), F.lit(0).alias("end")), F.struct(F.col("greatest").alias("v"), F.lit(0).alias("begin"), F.lit(1).alias("end"))))
    bounds = groups.select(ends.alias("e")).select("e.v", "e.begin", "e.end", F.lit(False).alias("asked"))
    asked = values.select(F.col(column).alias("v"), F.lit(0).alias("begin"), F.lit(0).alias("end"), F.lit(True).alias("asked"))
    counted = bounds.unionByName(asked).groupBy("v").agg(F.sum("begin").alias("begin"), F.sum("end").alias("end"), F.max("asked").alias("asked"))
    whole = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    through, before = whole.rowsBetween(Window.unboundedPreceding, 0), whole.rowsBetween(Window.unboundedPreceding, -1)
    # a NULL bound sorts first: as a beginning it is met by every value, and it never ends
    known_end = F.when(F.col("v").isNotNull(), F.col("end")).otherwise(0)
    met = F.sum("begin").over(through) - F.coalesce(F.sum(known_end).over(before), F.lit(0))
    out = counted.select("v", "asked", F.sum("begin").over(whole).alias("groups"), met.alias("overlaps"))
    return out.where("asked AND v IS NOT NULL").select(F.col("v").alias(column), "groups", "overlaps")
