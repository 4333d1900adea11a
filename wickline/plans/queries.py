"""Registered queries: every one starts from the driver's tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is the
same computation in DuckDB SQL over the pre-registered views.  Candles come
from ``events`` (one candle per event, see ``sources.events``).
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.functions.convert import default_created_at, stamp, type_klines
from wickline.functions.time import as_ntz, bucket_start, month_key, stamp_format, to_epoch_micros, to_epoch_millis
from wickline.operators.dedup import latest_by_key, upsert
from wickline.operators.quality import check_candles, check_slice, table_health
from wickline.operators.ranking import ranked, ranked_in_groups
from wickline.operators.rollup import (
    high_water_column,
    incremental_rollup,
    rollup_last,
    rollup_last_two_step,
)
from wickline.operators.slices import plan_pages, slice_klines, top_n_per_symbol
from wickline.plans import fs
from wickline.schemas import CANDLE_COLUMNS, LANDING_COLUMNS, LOAD_SEQ, MONTH
from wickline.sources.events import event_candles, read_table
from wickline.sources.exchange_info import (
    EXCHANGE_FILTER_FIELDS,
    FILTER_FIELD_TYPES,
    SYMBOL_FIELDS,
    SYMBOL_FILTER_FIELDS,
    exchange_table,
)
from wickline.plans.store import CandleStore, newest_load_order
from wickline.session import scratch_path
from wickline.sources.footers import FOOTERS, layout_skips, listed_names, read_footers, resolved
from wickline.sources.landing import landing_text, write_landing
from wickline.sources.pages import format_kline_row, parse_kline_pages
from wickline.streaming.ingest import REPORT_SCHEMA, backfill, corrupt_file_report, load_files, run_once, start_ingest, start_message_ingest
from wickline.streaming.propagate import start_propagation
from wickline.sources.payloads import (
    kline_problem,
    new_landing_files,
    parse_stream_klines,
    parse_tickers,
    type_stream_klines,
    type_tickers,
)

# Fixed parameters of the registered queries.
INCREMENTAL_CUT = dt.datetime(2024, 1, 20, 0, 3)
UPSERT_TARGET_BEFORE = dt.datetime(2024, 1, 15)
UPSERT_NEW_FROM = dt.datetime(2024, 1, 10)
SLICE_SYMBOL = "view"
SLICE_START = dt.datetime(2024, 1, 10)
SLICE_END = dt.datetime(2024, 1, 20)
SLICE_LIMIT = 500
TOP_N = 3
PAGE_LIMIT = 500
LOAD_TIME = dt.datetime(2024, 2, 1)
LANDING_BUCKET = "candles-landing"
LANDING_PREFIX = "incoming/candles/"
LATE_CUT = dt.datetime(2024, 1, 16)
BAD_EVERY = 7
BROKEN_SYMBOL = "error"
LAYOUT_GROUP_ROWS, LAYOUT_FILE_ROWS = 256, 256 * 40
BAD_FILE_SYMBOLS = ["view", "click", "purchase", "error", "signup"]

Query = Callable[[SparkSession, str], DataFrame]


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_key(event_candles(spark, sf_dir))


@contextlib.contextmanager
def _workspace(spark: SparkSession, name: str):
    """A scratch folder for the tables of one query, removed at the end."""
    work = scratch_path(spark, name)
    try:
        yield work
    finally:
        fs.delete(spark, work)


def _kept(df: DataFrame, work: str) -> DataFrame:
    """The result of a query whose tables are about to be removed, written
    once beside them."""
    out = f"{work}-result"
    df.write.option("compression", "zstd").parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def _ts(value: dt.datetime) -> str:
    return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"


# --------------------------------------------------------------------------
# Spark side


def q_latest_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir)


def q_rollup_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_last(event_candles(spark, sf_dir), "5 minutes")


def q_rollup_5min_two_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_last_two_step(event_candles(spark, sf_dir), "5 minutes")


def q_rollup_4h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_last(event_candles(spark, sf_dir), "4 hours")


def q_rollup_1month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_last(event_candles(spark, sf_dir), "1 month")


def q_incremental_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    candles = event_candles(spark, sf_dir)
    before = candles.filter(F.col("open_time") < as_ntz(INCREMENTAL_CUT))
    # the greatest bucket start needs no deduplication
    new, _ = incremental_rollup(candles, before.select(bucket_start("open_time", "5 minutes").alias("open_time")), "5 minutes")
    return upsert(rollup_last(before), new)


def _late(candles: DataFrame) -> F.Column:
    """Rows that arrive in a second load: all after the cut, one symbol
    whole, and every fifth minute's later versions before the cut."""
    revised = (F.col("number_of_trades") % 5 == 0) & (F.col("symbol") != SLICE_SYMBOL)
    return (F.col("open_time") >= as_ntz(LATE_CUT)) | (F.col("symbol") == "signup") | revised


def q_incremental_rollup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-3 where it matters: late rows, a late symbol and revisions at or
    before the high water stay out, so a full rollup would differ."""
    candles = event_candles(spark, sf_dir)
    first = candles.filter(~_late(candles))
    new, _ = incremental_rollup(candles, first.select(bucket_start("open_time", "5 minutes").alias("open_time")), "5 minutes")
    return upsert(rollup_last(first), new)


def q_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    candles = event_candles(spark, sf_dir)
    return high_water_column(candles.select(bucket_start("open_time", "5 minutes").alias("open_time")))


def q_upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-4 twice on a stored table: the second time changes nothing."""
    candles = event_candles(spark, sf_dir)
    with _workspace(spark, "upsert") as work:
        table = CandleStore(spark, f"{work}/tables").rollup_table("5 minutes")
        rolled = lambda rows: rollup_last(rows).withColumn(MONTH, month_key("open_time"))
        table.replace_all(rolled(candles.filter(F.col("open_time") < as_ntz(UPSERT_TARGET_BEFORE))))
        new = candles.filter(F.col("open_time") >= as_ntz(UPSERT_NEW_FROM))
        months = table.upsert(rolled(new), [r[0] for r in new.select(month_key("open_time")).distinct().collect()])
        table.upsert(rolled(new), months)
        return _kept(table.rows().drop(MONTH), work)


def q_slice_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_klines(_latest(spark, sf_dir), SLICE_SYMBOL, SLICE_START, SLICE_END, SLICE_LIMIT)


def q_slice_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_klines(_latest(spark, sf_dir), SLICE_SYMBOL, None, SLICE_END, SLICE_LIMIT)


def q_slice_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = slice_klines(_latest(spark, sf_dir), SLICE_SYMBOL, SLICE_START, SLICE_END, SLICE_LIMIT)
    return check_slice(s, SLICE_START, SLICE_END, "1 minute", SLICE_LIMIT)


def q_slice_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neither bound: the latest candles; the limit is the request's own."""
    return slice_klines(_latest(spark, sf_dir), SLICE_SYMBOL, limit=SLICE_LIMIT)


def q_slice_interval_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The short interval name picks the stored rollup; no limit."""
    with _workspace(spark, "slice") as work:
        store = CandleStore(spark, f"{work}/tables")
        store.append(event_candles(spark, sf_dir), order_by="created_at", given_created_at=True)
        store.refresh_rollup("5 minutes")
        return _kept(store.slice(SLICE_SYMBOL, SLICE_START, SLICE_END, interval="5m").drop(MONTH), work)


def q_newest_load_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-3: the place of every history row of a symbol in the order newest load first."""
    with _workspace(spark, "history") as work:
        store = CandleStore(spark, f"{work}/tables")
        store.append(event_candles(spark, sf_dir), order_by="created_at", given_created_at=True, propagate=False)
        rows = store.history().select("symbol", "open_time", "created_at", LOAD_SEQ)
        placed = ranked_in_groups(rows, ["symbol"], newest_load_order(), path=f"{work}/ranked")
        return _kept(placed.drop(LOAD_SEQ), work)


def q_layout_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-1: candles clustered by (symbol, open_time) into files of whole row
    groups; the statistics in their footers say which groups a symbol needs."""
    with _workspace(spark, "layout") as work:
        candles = event_candles(spark, sf_dir)
        placed = ranked(candles, ["symbol", "open_time", "created_at"], path=f"{work}/ranked")
        total = placed.agg(F.max("place")).first()[0] or 0
        files = max(1, -(-total // LAYOUT_FILE_ROWS))
        file = F.floor((F.col("place") - 1) / LAYOUT_FILE_ROWS).cast("int")
        dealt = placed.withColumn("file", file).repartitionById(files, F.col("file")).sortWithinPartitions("place")
        dealt.drop("file", "place").write.option("parquet.block.row.count.limit", LAYOUT_GROUP_ROWS).parquet(f"{work}/clustered")
        return _kept(layout_skips(listed_names(spark, f"{work}/clustered"), candles.select("symbol")), work)


def q_run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The microsecond stamp of landing file names, for every event time."""
    events = read_table(spark, sf_dir, "events")
    return events.select("event_id", stamp_format("ts").alias("stamp"))


def q_default_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-5: a given load time stays, a missing one becomes the clock's, at
    whole milliseconds."""
    events = read_table(spark, sf_dir, "events")
    given = F.when(F.col("event_id") % 3 != 0, F.col("ts")).alias("created_at")
    stamped = default_created_at(events.select("event_id", given))
    clock = F.col("event_id") % 3 == 0
    in_ms = (to_epoch_micros("created_at") % 1000 == 0) & (F.col("created_at") > as_ntz(LOAD_TIME))
    return stamped.select("event_id", F.when(~clock, F.col("created_at")).alias("given"), F.when(clock, in_ms).alias("clock_in_ms"))


def q_top_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n_per_symbol(_latest(spark, sf_dir), TOP_N)


def q_page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    candles = event_candles(spark, sf_dir)
    ranges = candles.groupBy("symbol").agg(
        F.min("open_time").alias("start"),
        F.timestamp_add("MINUTE", F.lit(1), F.max("open_time")).alias("end"),
    )
    return plan_pages(ranges, "1 minute", PAGE_LIMIT)


def q_month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    candles = event_candles(spark, sf_dir).withColumn("open_month", month_key("open_time"))
    return table_health(candles, by=["symbol", "open_month"])


def q_candle_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_candles(_latest(spark, sf_dir), by=["symbol"])


def _ticker_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    ticker = F.struct(
        F.lit("24hrMiniTicker").alias("e"),
        to_epoch_millis("ts").alias("E"),
        F.col("event_type").alias("s"),
        F.col("value").cast("string").alias("c"),
        F.col("value").cast("string").alias("o"),
        (F.col("value") + F.lit(1.0)).cast("string").alias("h"),
        (F.col("value") - F.lit(1.0)).cast("string").alias("l"),
        F.get_json_object("props", "$.k").alias("v"),
        (F.col("value") * F.lit(2.0)).cast("string").alias("q"),
    )
    return events.select(F.to_json(F.array(ticker)).alias("body"))


def q_ticker_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_tickers(parse_tickers(_ticker_messages(spark, sf_dir)))


def q_event_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _kline_messages(event_candles(spark, sf_dir))
    return type_stream_klines(parse_stream_klines(messages))


def _notification_key() -> F.Column:
    et, eid = F.col("event_type"), F.col("event_id").cast("string")
    return (
        F.when(et == "signup", F.concat(F.lit("landing/other/"), eid, F.lit(".parquet")))
        .when(et == "click", F.concat(F.lit(f"{LANDING_PREFIX}click/"), eid, F.lit(".txt")))
        .otherwise(F.concat(F.lit(LANDING_PREFIX), et, F.lit("/"), eid, F.lit(".parquet")))
    )


def q_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    event_name = F.when(F.col("event_type") == "error", F.lit("ObjectCreated:CompleteMultipartUpload")).otherwise(
        F.lit("ObjectCreated:Put")
    )
    record = F.struct(
        event_name.alias("eventName"),
        F.struct(
            F.struct(F.lit(LANDING_BUCKET).alias("name")).alias("bucket"),
            F.struct(_notification_key().alias("key")).alias("object"),
        ).alias("s3"),
    )
    bodies = events.select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("body"))
    return new_landing_files(bodies, LANDING_PREFIX)


def q_rest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest candles -> REST pages of at most 500 rows -> parse -> type -> stamp."""
    latest = _latest(spark, sf_dir)
    page_no = F.floor(to_epoch_millis("open_time") / F.lit(60000 * PAGE_LIMIT)).cast("long")
    rows = latest.select("symbol", page_no.alias("page"), "open_time", format_kline_row(latest).alias("row"))
    pages = rows.groupBy("symbol", "page").agg(
        F.concat(
            F.lit("["),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("open_time", "row"))), lambda x: x["row"]), ","),
            F.lit("]"),
        ).alias("payload")
    )
    landing = parse_kline_pages(pages, "symbol", "payload")
    return stamp(type_klines(landing), CANDLE_COLUMNS, now=LOAD_TIME)


def q_pipeline_rollup_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end: landing files -> file-stream load -> tables -> incremental rollup.

    created_at is the load time, so it is left out of the result.
    """
    with _workspace(spark, "pipeline") as work:
        candles = event_candles(spark, sf_dir)
        write_landing(landing_text(candles), f"{work}/landing", order_by=("created_at",))
        store = CandleStore(spark, f"{work}/tables")
        run_once(spark, f"{work}/landing", store, f"{work}/checkpoint")
        store.refresh_rollup("5 minutes")
        return _kept(store.read_rollup("5 minutes").drop("created_at", MONTH), work)


def q_pipeline_backfill_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files -> one distributed backfill -> compaction -> deduplicated view."""
    with _workspace(spark, "backfill") as work:
        candles = event_candles(spark, sf_dir)
        write_landing(landing_text(candles), f"{work}/landing", order_by=("created_at",))
        store = CandleStore(spark, f"{work}/tables")
        backfill(spark, f"{work}/landing", store)
        store.compact()
        return _kept(store.latest().drop("created_at", MONTH), work)


def q_pipeline_incremental_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into the tables, a full first rollup, then an incremental run
    (rows after the high water, appended as a new run) read back merged.
    The event time orders the versions of a candle inside a load."""
    with _workspace(spark, "incremental") as work:
        store = CandleStore(spark, f"{work}/tables")
        candles = event_candles(spark, sf_dir)
        cut = as_ntz(INCREMENTAL_CUT)
        store.append(candles.filter(F.col("open_time") < cut), order_by="created_at")
        store.refresh_rollup("5 minutes")
        store.append(candles.filter(F.col("open_time") >= cut), order_by="created_at")
        store.refresh_rollup("5 minutes")
        return _kept(store.read_rollup("5 minutes").drop("created_at", MONTH), work)


def _halves(candles: DataFrame) -> tuple[DataFrame, DataFrame]:
    even = F.col("number_of_trades") % 2 == 0
    return candles.filter(even), candles.filter(~even)


def q_pipeline_layered_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows loaded and compacted, the rest appended: the view
    over base and delta, with versions in both, given by the event time."""
    with _workspace(spark, "layered") as work:
        store = CandleStore(spark, f"{work}/tables")
        first, second = _halves(event_candles(spark, sf_dir))
        store.append(first, order_by="created_at", given_created_at=True)
        store.compact()
        store.append(second, order_by="created_at", given_created_at=True)
        return _kept(store.latest().drop(MONTH), work)


def q_pipeline_compact_then_older(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with an older stamp after a compaction: rows of the compacted
    load keep winning for the keys that both hold, before and after a second
    compaction."""
    with _workspace(spark, "older") as work:
        store = CandleStore(spark, f"{work}/tables")
        first, second = _halves(event_candles(spark, sf_dir))
        store.append(first, now=LOAD_TIME, order_by="created_at")
        store.compact()
        store.append(second, now=LOAD_TIME - dt.timedelta(days=1), order_by="created_at")
        seen = store.latest().drop(MONTH)
        before = _kept(seen.withColumn("phase", F.lit("layered")), f"{work}-a")
        store.compact()
        after = _kept(store.latest().drop(MONTH).withColumn("phase", F.lit("compacted")), f"{work}-b")
        return before.unionByName(after)


def _land_by_symbol(candles: DataFrame, base: str) -> None:
    """Landing files in a folder a symbol, of which one symbol's lack a column,
    one's have a column too many and one's hold prices that are no numbers."""
    for symbol in BAD_FILE_SYMBOLS:
        own = landing_text(candles).filter(F.col("symbol") == symbol).drop("created_at")
        if symbol == "error":
            own = own.drop("volume")
        if symbol == "signup":
            own = own.withColumn("open_price", F.lit("n/a"))
        if symbol == "purchase":
            own = own.withColumn("more", F.lit(1))
        own.write.parquet(f"{base}/{symbol}")


def q_pipeline_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-3, STR-4 and DQ-2: landing files per symbol, of which three symbols'
    cannot be loaded.  The batches are quarantined and commit; the result is
    the rows that were loaded and, by symbol, whether files were reported."""
    with _workspace(spark, "bad") as work:
        candles = event_candles(spark, sf_dir)
        _land_by_symbol(candles, f"{work}/landing")
        store = CandleStore(spark, f"{work}/tables")
        run_once(spark, f"{work}/landing", store, f"{work}/checkpoint", max_files=100, quarantine=f"{work}/quarantine")
        loaded = store.history().groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")).withColumn("status", F.lit("loaded"))
        failed = spark.read.schema(REPORT_SCHEMA).parquet(f"{work}/quarantine")
        symbol = F.element_at(F.split("path", "/"), -2).alias("symbol")
        failed = failed.select(symbol, F.lit(0).cast("long").alias("rows"), "status").distinct()
        return _kept(loaded.select("symbol", "rows", "status").unionByName(failed), work)


def q_landing_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5, DQ-2: the footers of all landing files, read by one job: rows by
    file group and verdict."""
    with _workspace(spark, "footers") as work:
        _land_by_symbol(event_candles(spark, sf_dir), f"{work}/landing")
        read_footers(listed_names(spark, f"{work}/landing")).write.parquet(f"{work}/footers")
        found = resolved(spark, spark.read.schema(FOOTERS).parquet(f"{work}/footers"))
        group = F.element_at(F.split("path", "/"), -2).alias("file_group")
        verdict = F.coalesce("error", F.lit("loadable")).alias("verdict")
        return _kept(found.groupBy(group, verdict).agg(F.sum("rows").alias("rows")), work)


def _break_pages(names: DataFrame) -> int:
    """Overwrite the data pages of files and keep their footers, each file by
    the task that has its name; returns how many.  Only for folders that tasks
    reach as files."""

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                with open("/" + path.removeprefix("file:").lstrip("/"), "r+b") as f:
                    end = f.seek(-8, 2)
                    size = int.from_bytes(f.read(4), "little")
                    f.seek(4)
                    f.write(b"\xff" * (end - size - 4))
            yield b

    return names.select("path").mapInArrow(run, "path string").count()


def q_corrupt_file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-4: files with broken pages behind a good footer, named by comparing
    the rows a tolerant scan reads with the rows the footers promise."""
    with _workspace(spark, "corrupt") as work:
        candles = landing_text(event_candles(spark, sf_dir)).drop("created_at").withColumn("pair", F.col("symbol"))
        candles.write.partitionBy("pair").parquet(f"{work}/landing")
        _break_pages(listed_names(spark, f"{work}/landing/pair={BROKEN_SYMBOL}"))
        read_footers(listed_names(spark, f"{work}/landing")).write.parquet(f"{work}/footers")
        footers = resolved(spark, spark.read.schema(FOOTERS).parquet(f"{work}/footers"))
        report = corrupt_file_report(spark, footers)
        symbol = F.split(F.element_at(F.split("path", "/"), -2), "=")[1].alias("symbol")
        whole = F.when(F.col("error").isNull(), F.lit("whole")).otherwise(F.lit("broken")).alias("status")
        return _kept(report.groupBy(symbol, whole).agg(F.sum("rows").alias("rows"), F.sum("rows_read").alias("rows_read")), work)


def q_observed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-1, AGG-4: what the load observed of its rows while it wrote them."""
    with _workspace(spark, "health") as work:
        candles = event_candles(spark, sf_dir)
        write_landing(landing_text(candles), f"{work}/landing", order_by=("created_at",))
        store = CandleStore(spark, f"{work}/tables")
        health = load_files(spark, listed_names(spark, f"{work}/landing"), store, propagate=False).health
        fields = "rows long, first_open timestamp_ntz, last_open timestamp_ntz"
        rules = [k for k in health if k.startswith("bad_")]
        return spark.createDataFrame([tuple(health.values())], ", ".join([fields, *[f"{k} long" for k in rules]]))


def q_pipeline_chained_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-3: landing files loaded into the history by one stream in two lots;
    a second stream, whose source is the history, feeds the latest table."""
    with _workspace(spark, "chained") as work:
        candles = landing_text(event_candles(spark, sf_dir))
        store = CandleStore(spark, f"{work}/tables")
        cut = as_ntz(INCREMENTAL_CUT)
        for lot in (F.col("open_time") < cut, F.col("open_time") >= cut):
            write_landing(candles.filter(lot), f"{work}/landing", order_by=("created_at",))
            start_ingest(spark, f"{work}/landing", store, f"{work}/checkpoint", available_now=True, max_files=100).awaitTermination()
            start_propagation(store, available_now=True).awaitTermination()
        return _kept(store.latest().drop("created_at", MONTH), work)


def q_pipeline_continuous_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1, DED-3: both streams running side by side on their own clocks until
    the waiting files are through, then stopped; the deduplicated view."""
    with _workspace(spark, "continuous") as work:
        candles = event_candles(spark, sf_dir)
        store = CandleStore(spark, f"{work}/tables")
        landing = landing_text(candles)
        write_landing(landing.filter(F.col("symbol") == SLICE_SYMBOL), f"{work}/landing", order_by=("created_at",))
        load = start_ingest(spark, f"{work}/landing", store, f"{work}/checkpoint", poll_seconds=1, max_files=100)
        carry = None
        try:
            load.processAllAvailable()
            carry = start_propagation(store, poll_seconds=1)
            write_landing(landing.filter(F.col("symbol") != SLICE_SYMBOL), f"{work}/landing", order_by=("created_at",))
            load.processAllAvailable()
            carry.processAllAvailable()
        finally:
            load.stop()
            if carry is not None:
                carry.stop()
        return _kept(store.latest().drop("created_at", MONTH), work)


def _broken(c: F.Column, n: F.Column) -> F.Column:
    """Every few texts broken, in turn: cut short, replaced by an error object, missing."""
    return (
        F.when(n % (3 * BAD_EVERY) == 0, F.substring(c, 1, 20))
        .when(n % (3 * BAD_EVERY) == BAD_EVERY, F.lit('{"code":-1121,"msg":"no such symbol"}'))
        .when(n % (3 * BAD_EVERY) == 2 * BAD_EVERY, F.lit(None).cast("string"))
        .otherwise(c)
    )


def q_payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live candle messages with a share of broken ones: valid messages are
    typed, the others kept with their reason; counted by symbol and reason."""
    candles = event_candles(spark, sf_dir)
    bodies = _kline_messages(candles, keep=("symbol", "number_of_trades"))
    messages = bodies.select("symbol", _broken(F.col("body"), F.col("number_of_trades")).alias("body"))
    problem = kline_problem(F.col("body"))
    flagged = messages.select("symbol", F.coalesce(problem, F.lit("valid")).alias("reason"))
    return flagged.groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("messages"))


def q_pipeline_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-6, tickers: messages as a text stream into the ticker folder."""
    with _workspace(spark, "tickers") as work:
        _ticker_messages(spark, sf_dir).write.text(f"{work}/in")
        stream = spark.readStream.schema("value string").text(f"{work}/in").withColumnRenamed("value", "body")
        store = CandleStore(spark, f"{work}/tables")
        path = f"{work}/tickers"
        start_message_ingest(stream, store, f"{work}/checkpoint", kind="ticker", ticker_path=path, available_now=True).awaitTermination()
        return _kept(spark.read.parquet(path).select("symbol", "price", "time"), work)


def _kline_messages(candles: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed candles -> live candle message text (event time = created_at)."""
    s = lambda c: F.col(c).cast("string")
    kline = F.struct(
        to_epoch_millis("open_time").alias("t"),
        to_epoch_millis("close_time").alias("T"),
        F.col("symbol").alias("s"),
        F.lit("1m").alias("i"),
        F.col("number_of_trades").alias("f"),
        F.col("number_of_trades").alias("L"),
        s("open_price").alias("o"),
        s("close_price").alias("c"),
        s("high_price").alias("h"),
        s("low_price").alias("l"),
        s("volume").alias("v"),
        F.col("number_of_trades").alias("n"),
        F.lit(True).alias("x"),
        s("quote_asset_volume").alias("q"),
        s("taker_buy_base_asset_volume").alias("V"),
        s("taker_buy_quote_asset_volume").alias("Q"),
        F.col("ignore").alias("B"),
    )
    msg = F.struct(
        F.lit("kline").alias("e"),
        to_epoch_millis("created_at").alias("E"),
        F.col("symbol").alias("s"),
        kline.alias("k"),
    )
    return candles.select(F.to_json(msg).alias("body"), *keep)


def q_pipeline_stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-6 end to end: live candle messages (text files) -> message stream ->
    tables -> deduplicated view.  Updates of one candle are resolved by the
    message's event time."""
    with _workspace(spark, "messages") as work:
        _kline_messages(event_candles(spark, sf_dir)).write.mode("errorifexists").text(f"{work}/in")
        store = CandleStore(spark, f"{work}/tables")
        stream = spark.readStream.schema("value string").text(f"{work}/in").withColumnRenamed("value", "body")
        start_message_ingest(stream, store, f"{work}/checkpoint", kind="kline", available_now=True).awaitTermination()
        store.propagate()
        return _kept(store.latest().drop("created_at", MONTH), work)


FILTER_COLUMNS = ["minPrice", "maxPrice", "tickSize", "minQty", "maxQty", "stepSize", "maxNumOrders"]


def _filter(tag: str, **values: str) -> str:
    """SQL of one symbol filter with every field of the union; absent ones stay
    NULL and ``to_json`` leaves them out."""
    fields = [f"'filterType', '{tag}'"]
    fields += [f"'{name}', CAST({values.get(name, 'NULL')} AS {kind.simpleString()})" for name, kind in FILTER_FIELD_TYPES.items()]
    return f"named_struct({', '.join(fields)})"


def q_exchange_info_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10/11 on documents derived from events: one exchange-info document
    per (symbol, day) whose symbol filters come from that day's events,
    flattened and tag-checked back into filter rows."""
    events = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    stats = events.groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("day")).agg(
        F.min("value").alias("mn"), F.max("value").alias("mx"), F.min(k).alias("kmin"), F.max(k).alias("kmax"), F.count(F.lit(1)).alias("n")
    )
    filters = [
        _filter("PRICE_FILTER", minPrice="CAST(floor(mn) AS BIGINT)", maxPrice="CAST(ceil(mx) AS BIGINT)", tickSize="'0.01'"),
        _filter("LOT_SIZE", minQty="kmin", maxQty="kmax", stepSize="'1'"),
        _filter("MAX_NUM_ORDERS", maxNumOrders="n"),
    ]
    symbol = F.struct(
        F.col("symbol").alias("symbol"), F.lit("TRADING").alias("status"), F.col("symbol").alias("baseAsset"),
        F.lit(8).alias("baseAssetPrecision"), F.lit("USDT").alias("quoteAsset"), F.lit(8).alias("quoteAssetPrecision"),
        F.lit(8).alias("baseCommissionPrecision"), F.lit(8).alias("quoteCommissionPrecision"),
        F.array(F.lit("LIMIT"), F.lit("MARKET")).alias("orderTypes"), F.lit(True).alias("icebergAllowed"),
        F.lit(True).alias("ocoAllowed"), F.lit(True).alias("otoAllowed"), F.lit(True).alias("quoteOrderQtyMarketAllowed"),
        F.lit(False).alias("allowTrailingStop"), F.lit(False).alias("cancelReplaceAllowed"),
        F.lit(True).alias("isSpotTradingAllowed"), F.lit(False).alias("isMarginTradingAllowed"),
        F.expr(f"array({', '.join(filters)})").alias("filters"),
        F.array().cast("array<string>").alias("permissions"),
        F.array(F.array(F.lit("SPOT"))).alias("permissionSets"),
        F.lit("NONE").alias("defaultSelfTradePreventionMode"),
        F.array(F.lit("NONE")).alias("allowedSelfTradePreventionModes"),
    )
    doc = F.struct(
        F.lit("UTC").alias("timezone"),
        to_epoch_millis(F.col("day").cast("timestamp_ntz")).alias("serverTime"),
        F.array(symbol).alias("symbols"),
    )
    filters = exchange_table(stats.select(F.to_json(doc).alias("body")), "symbol_filters")
    return filters.select("server_time", "symbol", "position", "filter_type", *FILTER_COLUMNS)


def _union_filters(tags: dict[str, list[str]]) -> F.Column:
    """One filter of every tag; each field's value follows from ``n`` and the
    field's place in the union."""
    place = {name: i for i, name in enumerate(FILTER_FIELD_TYPES)}

    def value(name: str) -> str:
        return "n % 2 = 0" if FILTER_FIELD_TYPES[name].simpleString() == "boolean" else f"n + {place[name]}"

    return F.expr(f"array({', '.join(_filter(tag, **{f: value(f) for f in fields}) for tag, fields in tags.items())})")


def _exchange_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exchange-info document a day: every symbol of the day with all
    symbol filters, all exchange filters, rate limits and one routing group."""
    events = read_table(spark, sf_dir, "events")
    stats = events.groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    flags = {name: F.col("n") % 2 == 0 for name, kind in SYMBOL_FIELDS if kind is not None and kind.simpleString() == "boolean"}
    known = {
        "symbol": F.col("symbol"), "status": F.lit("TRADING"), "baseAsset": F.col("symbol"), "quoteAsset": F.lit("USDT"),
        "quotePrecision": F.when(F.col("n") % 2 == 0, F.lit(8)).cast("long"), "orderTypes": F.array(F.lit("LIMIT"), F.lit("MARKET")),
        "filters": _union_filters(SYMBOL_FILTER_FIELDS), "permissions": F.array().cast("array<string>"),
        "permissionSets": F.array(F.array(F.lit("SPOT"), F.col("symbol"))), "defaultSelfTradePreventionMode": F.lit("NONE"),
        "allowedSelfTradePreventionModes": F.array(F.lit("NONE")), **flags,
    }
    symbol = F.struct(*[(known[name] if name in known else F.lit(8).cast("long")).alias(name) for name, _ in SYMBOL_FIELDS])
    days = stats.select("day", "n", symbol.alias("s")).groupBy("day").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list("s")).alias("symbols"))
    limits = [("REQUEST_WEIGHT", "MINUTE", 1), ("ORDERS", "SECOND", 10), ("RAW_REQUESTS", "DAY", 1)]
    rate = [
        F.struct(F.lit(t).alias("rateLimitType"), F.lit(i).alias("interval"), F.lit(k).alias("intervalNum"), (F.col("n") + k).alias("limit")) for t, i, k in limits
    ]
    doc = F.struct(
        F.lit("UTC").alias("timezone"),
        to_epoch_millis(F.col("day").cast("timestamp_ntz")).alias("serverTime"),
        F.array(*rate).alias("rateLimits"),
        _union_filters(EXCHANGE_FILTER_FIELDS).alias("exchangeFilters"),
        "symbols",
        F.array(F.struct(F.lit("ALL").alias("baseAsset"), F.transform("symbols", lambda x: x["symbol"]).alias("symbols"))).alias("sors"),
    )
    return days.select(F.to_json(doc).alias("body"))


def _exchange_table(table: str, columns: list[str]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return exchange_table(_exchange_documents(spark, sf_dir), table).select(*columns)

    query.__doc__ = f"SRC-10/11: the {table} rows of daily documents built from events."
    return query


EXCHANGE_TABLES = {
    "header": ["timezone", "server_time", "symbol_count"],
    "rate_limits": ["server_time", "position", "rate_limit_type", "interval", "interval_num", "limit"],
    "exchange_filters": ["server_time", "position", "filter_type", *FILTER_FIELD_TYPES],
    "symbols": ["server_time", "symbol_index", "symbol", "status", "baseAsset", "quoteAsset", "quotePrecision", "icebergAllowed"],
    "symbol_filters": ["server_time", "symbol", "position", "filter_type", *FILTER_FIELD_TYPES],
    "permission_sets": ["server_time", "symbol", "set_index", "position", "permission"],
    "order_routing": ["server_time", "group_index", "base_asset", "position", "symbol"],
}


QUERIES: dict[str, Query] = {
    "latest_candles": q_latest_candles,
    "rollup_5min": q_rollup_5min,
    "rollup_5min_two_step": q_rollup_5min_two_step,
    "rollup_4h": q_rollup_4h,
    "rollup_1month": q_rollup_1month,
    "incremental_rollup": q_incremental_rollup,
    "high_water": q_high_water,
    "upsert_idempotent": q_upsert_idempotent,
    "slice_symbol": q_slice_symbol,
    "slice_latest": q_slice_latest,
    "slice_checks": q_slice_checks,
    "top_per_symbol": q_top_per_symbol,
    "page_plan": q_page_plan,
    "month_counts": q_month_counts,
    "candle_checks": q_candle_checks,
    "ticker_projection": q_ticker_projection,
    "event_payload": q_event_payload,
    "notifications": q_notifications,
    "rest_roundtrip": q_rest_roundtrip,
    "pipeline_rollup_5min": q_pipeline_rollup_5min,
    "pipeline_backfill_latest": q_pipeline_backfill_latest,
    "pipeline_incremental_rollup": q_pipeline_incremental_rollup,
    "pipeline_stream_messages": q_pipeline_stream_messages,
    "exchange_info_filters": q_exchange_info_filters,
    **{f"exchange_{t}": _exchange_table(t, columns) for t, columns in EXCHANGE_TABLES.items()},
    "incremental_rollup_late": q_incremental_rollup_late,
    "slice_unbounded": q_slice_unbounded,
    "slice_interval_5m": q_slice_interval_5m,
    "newest_load_first": q_newest_load_first,
    "run_stamps": q_run_stamps,
    "payload_rejects": q_payload_rejects,
    "pipeline_layered_latest": q_pipeline_layered_latest,
    "pipeline_compact_then_older": q_pipeline_compact_then_older,
    "pipeline_bad_files": q_pipeline_bad_files,
    "pipeline_tickers": q_pipeline_tickers,
    "landing_footers": q_landing_footers,
    "corrupt_file_report": q_corrupt_file_report,
    "pipeline_chained_latest": q_pipeline_chained_latest,
    "pipeline_continuous_latest": q_pipeline_continuous_latest,
    "observed_health": q_observed_health,
    "layout_skips": q_layout_skips,
    "default_stamps": q_default_stamps,
}


# --------------------------------------------------------------------------
# DuckDB oracle

_CANDLES = """candles AS (
  SELECT event_type AS symbol,
         date_trunc('minute', ts) AS open_time,
         value AS open_price,
         value + 1.0 AS high_price,
         value - 1.0 AS low_price,
         value + 0.5 AS close_price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
         date_trunc('minute', ts) + INTERVAL 59999 MILLISECOND AS close_time,
         value * 2.0 AS quote_asset_volume,
         event_id AS number_of_trades,
         value / 2.0 AS taker_buy_base_asset_volume,
         value AS taker_buy_quote_asset_volume,
         '0' AS ignore,
         ts AS created_at
  FROM events)"""

_LATEST = """latest AS (
  SELECT * FROM candles
  QUALIFY row_number() OVER (PARTITION BY symbol, open_time ORDER BY created_at DESC) = 1)"""

_VALUES = [c for c in CANDLE_COLUMNS if c not in ("symbol", "open_time")]


def _bucket_sql(width: str, col: str) -> str:
    if width == "1 month":
        return f"date_trunc('month', {col})"
    return f"time_bucket(INTERVAL '{width}', {col}, TIMESTAMP '1970-01-01')"


def _rollup_sql(source: str, width: str = "5 minutes", where: str = "") -> str:
    b = _bucket_sql(width, "x.open_time")
    aggs = ",\n         ".join(f"arg_max(x.{c}, x.open_time) AS {c}" for c in _VALUES)
    return f"""SELECT x.symbol, {b} AS open_time,
         {aggs}
  FROM {source} x {where}
  GROUP BY x.symbol, {b}"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _cols(prefix: str = "") -> str:
    return ", ".join(f"{prefix}{c}" for c in CANDLE_COLUMNS)


def _upsert_sql(target: str, new: str) -> str:
    return f"""SELECT {_cols()} FROM {new}
UNION ALL
SELECT {_cols('t.')} FROM {target} t
WHERE NOT EXISTS (SELECT 1 FROM {new} n WHERE n.symbol = t.symbol AND n.open_time = t.open_time)"""


def _slice_where() -> str:
    return f"symbol = '{SLICE_SYMBOL}' AND open_time >= {_ts(SLICE_START)} AND open_time <= {_ts(SLICE_END)}"


def _union_sql(tags: dict[str, list[str]], source: str, lead: str) -> str:
    """The rows of ``_union_filters`` in SQL."""
    rows = []
    for position, (tag, fields) in enumerate(tags.items()):
        cols = []
        for i, (name, kind) in enumerate(FILTER_FIELD_TYPES.items()):
            sql = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN"}[kind.simpleString()]
            value = "NULL" if name not in fields else "n % 2 = 0" if sql == "BOOLEAN" else f"n + {i}"
            cols.append(f'CAST({value} AS {sql}) AS "{name}"')
        rows.append(f"SELECT {lead}, CAST({position} AS INTEGER) AS position, '{tag}' AS filter_type, {', '.join(cols)} FROM {source}")
    return "\nUNION ALL\n".join(rows)


def _exchange_oracle() -> dict[str, str]:
    base = """WITH s AS (
  SELECT event_type AS symbol, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS server_time, count(*) AS n,
    row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_type) - 1 AS place
  FROM events GROUP BY event_type, CAST(ts AS DATE)),
d AS (SELECT server_time, CAST(sum(n) AS BIGINT) AS n, count(*) AS symbols FROM s GROUP BY server_time)
"""
    limits = [("REQUEST_WEIGHT", "MINUTE", 1), ("ORDERS", "SECOND", 10), ("RAW_REQUESTS", "DAY", 1)]
    return {
        "exchange_header": base + "SELECT 'UTC' AS timezone, server_time, CAST(symbols AS INTEGER) AS symbol_count FROM d",
        "exchange_rate_limits": base
        + "\nUNION ALL\n".join(
            f"SELECT server_time, {i} AS position, '{t}' AS rate_limit_type, '{unit}' AS interval, CAST({k} AS BIGINT) AS interval_num, n + {k} AS \"limit\" FROM d"
            for i, (t, unit, k) in enumerate(limits)
        ),
        "exchange_exchange_filters": base + _union_sql(EXCHANGE_FILTER_FIELDS, "d", "server_time"),
        "exchange_symbols": base
        + """SELECT server_time, CAST(place AS INTEGER) AS symbol_index, symbol, 'TRADING' AS status, symbol AS "baseAsset", 'USDT' AS "quoteAsset",
  CASE WHEN n % 2 = 0 THEN CAST(8 AS BIGINT) END AS "quotePrecision", n % 2 = 0 AS "icebergAllowed" FROM s""",
        "exchange_symbol_filters": base + _union_sql(SYMBOL_FILTER_FIELDS, "s", "server_time, symbol"),
        "exchange_permission_sets": base
        + """SELECT server_time, symbol, 0 AS set_index, 0 AS position, 'SPOT' AS permission FROM s
UNION ALL SELECT server_time, symbol, 0, 1, symbol FROM s""",
        "exchange_order_routing": base
        + "SELECT server_time, 0 AS group_index, 'ALL' AS base_asset, CAST(place AS INTEGER) AS position, symbol FROM s",
    }


def _late_sql() -> str:
    return (
        f"(x.open_time >= {_ts(LATE_CUT)} OR x.symbol = 'signup' OR (x.number_of_trades % 5 = 0 AND x.symbol <> '{SLICE_SYMBOL}'))"
    )


def _dedup_sql(source: str) -> str:
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY symbol, open_time ORDER BY created_at DESC) = 1"


def _oracle() -> dict[str, str]:
    base = _with(_CANDLES, _LATEST)
    rollup5 = _rollup_sql("latest")
    incremental = _with(
        _CANDLES,
        _LATEST,
        f"target AS ({_rollup_sql('latest', where=f'WHERE x.open_time < {_ts(INCREMENTAL_CUT)}')})",
        "hw AS (SELECT coalesce(max(open_time), TIMESTAMP '1970-01-01') AS hw FROM target)",
        f"new AS ({_rollup_sql('latest', where='WHERE x.open_time > (SELECT hw FROM hw)')})",
    ) + _upsert_sql("target", "new")
    upsert_twice = _with(
        _CANDLES,
        _LATEST,
        f"target AS ({_rollup_sql('latest', where=f'WHERE x.open_time < {_ts(UPSERT_TARGET_BEFORE)}')})",
        f"new AS ({_rollup_sql('latest', where=f'WHERE x.open_time >= {_ts(UPSERT_NEW_FROM)}')})",
    ) + _upsert_sql("target", "new")
    slice_sql = f"SELECT * FROM latest WHERE {_slice_where()} ORDER BY open_time LIMIT {SLICE_LIMIT}"
    span = 60000 * PAGE_LIMIT
    late = _with(
        _CANDLES,
        _LATEST,
        f"first_rows AS (SELECT * FROM candles x WHERE NOT {_late_sql()})",
        f"first_latest AS ({_dedup_sql('first_rows')})",
        f"target AS ({_rollup_sql('first_latest')})",
        "hw AS (SELECT coalesce(max(open_time), TIMESTAMP '1970-01-01') AS hw FROM target)",
        f"new AS ({_rollup_sql('latest', where='WHERE x.open_time > (SELECT hw FROM hw)')})",
    ) + _upsert_sql("target", "new")
    cols = ", ".join(LANDING_COLUMNS)
    older = _with(
        _CANDLES,
        f"a AS ({_dedup_sql('(SELECT * FROM candles WHERE number_of_trades % 2 = 0)')})",
        f"b AS ({_dedup_sql('(SELECT * FROM candles WHERE number_of_trades % 2 = 1)')})",
        f"""both AS (SELECT {cols}, {_ts(LOAD_TIME)} AS created_at FROM a UNION ALL
  SELECT {cols}, {_ts(LOAD_TIME - dt.timedelta(days=1))} FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.symbol = b.symbol AND a.open_time = b.open_time))""",
    ).replace("both AS", "merged AS") + "SELECT *, 'layered' AS phase FROM merged UNION ALL SELECT *, 'compacted' FROM merged"
    span3 = 3 * BAD_EVERY
    return {
        **_exchange_oracle(),
        "incremental_rollup_late": late,
        "slice_unbounded": base
        + f"""SELECT * FROM (SELECT * FROM latest WHERE symbol = '{SLICE_SYMBOL}' ORDER BY open_time DESC LIMIT {SLICE_LIMIT}) ORDER BY open_time""",
        "slice_interval_5m": base + f"SELECT * FROM ({rollup5}) r WHERE {_slice_where()}",
        "newest_load_first": _with(_CANDLES)
        + "SELECT symbol, open_time, created_at, row_number() OVER (PARTITION BY symbol ORDER BY created_at DESC, open_time) AS place FROM candles",
        "run_stamps": "SELECT event_id, strftime(ts, '%Y%m%d%H%M%S%f') AS stamp FROM events",
        "payload_rejects": f"""SELECT event_type AS symbol,
  CASE WHEN event_id % {span3} = 0 THEN 'no JSON object' WHEN event_id % {span3} = {BAD_EVERY} THEN 'no candle message'
       WHEN event_id % {span3} = {2 * BAD_EVERY} THEN 'no JSON object' ELSE 'valid' END AS reason, count(*) AS messages
FROM events GROUP BY ALL""",
        "pipeline_layered_latest": base + "SELECT * FROM latest",
        "pipeline_compact_then_older": older,
        "pipeline_bad_files": """SELECT event_type AS symbol, CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN 0 ELSE count(*) END AS rows,
  CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN 'failed' ELSE 'loaded' END AS status FROM events GROUP BY event_type""",
        "landing_footers": """SELECT event_type AS file_group, count(*) AS rows,
  CASE event_type WHEN 'error' THEN 'SchemaError: schema mismatch: missing=[''volume''] unknown=[]'
    WHEN 'purchase' THEN 'SchemaError: schema mismatch: missing=[] unknown=[''more'']' ELSE 'loadable' END AS verdict
FROM events GROUP BY event_type""",
        "corrupt_file_report": f"""SELECT event_type AS symbol, CASE event_type WHEN '{BROKEN_SYMBOL}' THEN 'broken' ELSE 'whole' END AS status, count(*) AS rows,
  CASE event_type WHEN '{BROKEN_SYMBOL}' THEN 0 ELSE count(*) END AS rows_read FROM events GROUP BY event_type""",
        "pipeline_chained_latest": base + f"SELECT {', '.join(LANDING_COLUMNS)} FROM latest",
        "pipeline_continuous_latest": base + f"SELECT {', '.join(LANDING_COLUMNS)} FROM latest",
        "observed_health": _with(_CANDLES)
        + """SELECT count(*) AS rows, min(open_time) AS first_open, max(open_time) AS last_open,
  count_if(NOT coalesce(open_time < close_time, false)) AS bad_time_order,
  count_if(NOT coalesce(low_price <= high_price, false)) AS bad_low_le_high,
  count_if(NOT coalesce(number_of_trades >= 0, false)) AS bad_trades_non_negative,
  count_if(NOT coalesce(volume >= 0, false)) AS bad_volume_non_negative FROM candles""",
        "layout_skips": _with(
            _CANDLES,
            f"placed AS (SELECT symbol, (row_number() OVER (ORDER BY symbol, open_time, created_at) - 1) // {LAYOUT_GROUP_ROWS} AS g FROM candles)",
            "groups AS (SELECT g, min(symbol) AS least, max(symbol) AS greatest FROM placed GROUP BY g)",
        )
        + """SELECT s.symbol, (SELECT count(*) FROM groups) AS groups, count(*) AS overlaps
FROM (SELECT DISTINCT symbol FROM candles) s JOIN groups ON s.symbol BETWEEN least AND greatest GROUP BY s.symbol""",
        "default_stamps": """SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN ts END AS given, CASE WHEN event_id % 3 = 0 THEN true END AS clock_in_ms FROM events""",
        "pipeline_tickers": "SELECT event_type AS symbol, value AS price, make_timestamp((epoch_us(ts) // 1000) * 1000) AS time FROM events",
        "latest_candles": base + "SELECT * FROM latest",
        "rollup_5min": base + rollup5,
        "rollup_5min_two_step": base + rollup5,
        "rollup_4h": base + _rollup_sql("latest", "4 hours"),
        "rollup_1month": base + _rollup_sql("latest", "1 month"),
        "incremental_rollup": incremental,
        "high_water": _with(_CANDLES, _LATEST, f"r AS ({rollup5})")
        + "SELECT coalesce(max(open_time), TIMESTAMP '1970-01-01') AS high_water FROM r",
        "upsert_idempotent": upsert_twice,
        "slice_symbol": base + slice_sql,
        "slice_latest": base
        + f"""SELECT * FROM (SELECT * FROM latest WHERE symbol = '{SLICE_SYMBOL}' AND open_time <= {_ts(SLICE_END)}
  ORDER BY open_time DESC LIMIT {SLICE_LIMIT}) ORDER BY open_time""",
        "slice_checks": base
        + f"""SELECT min(open_time) AS first_open, max(close_time) AS last_close, count(*) AS rows,
  count(DISTINCT symbol) AS symbols,
  min(open_time) >= {_ts(SLICE_START)} AS starts_in_range,
  max(close_time) <= {_ts(SLICE_END)} + INTERVAL 60 SECOND AS ends_in_range,
  count(*) <= {SLICE_LIMIT} AS within_limit,
  count(DISTINCT symbol) <= 1 AS single_symbol
FROM ({slice_sql}) s""",
        "top_per_symbol": base
        + f"SELECT * FROM latest QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= {TOP_N}",
        "page_plan": _with(
            _CANDLES,
            """r AS (SELECT symbol, epoch_ms(min(open_time)) AS s,
  epoch_ms(max(open_time) + INTERVAL 1 MINUTE) AS e FROM candles GROUP BY symbol)""",
            "n AS (SELECT symbol, s, e, CAST(greatest(0, ceil((e - s) / 60000.0)) AS BIGINT) AS n FROM r)",
            f"p AS (SELECT symbol, s, e, n, unnest(range(0, CAST(ceil(n / {PAGE_LIMIT}.0) AS BIGINT))) AS page FROM n)",
        )
        + f"""SELECT symbol, page,
  make_timestamp((s + page * {span}) * 1000) AS page_start,
  make_timestamp(least(s + (page + 1) * {span}, e) * 1000) AS page_end,
  least(CAST({PAGE_LIMIT} AS BIGINT), n - page * {PAGE_LIMIT}) AS candles
FROM p""",
        "month_counts": _with(_CANDLES)
        + """SELECT symbol, CAST(strftime(open_time, '%Y%m') AS INTEGER) AS open_month,
  count(*) AS rows, count(DISTINCT (symbol, open_time)) AS distinct_keys
FROM candles GROUP BY symbol, CAST(strftime(open_time, '%Y%m') AS INTEGER)""",
        "candle_checks": base
        + """SELECT symbol, count(*) AS rows,
  count_if(NOT coalesce(open_time < close_time, false)) AS bad_time_order,
  count_if(NOT coalesce(low_price <= high_price, false)) AS bad_low_le_high,
  count_if(NOT coalesce(number_of_trades >= 0, false)) AS bad_trades_non_negative,
  count_if(NOT coalesce(volume >= 0, false)) AS bad_volume_non_negative
FROM latest GROUP BY symbol""",
        "ticker_projection": "SELECT event_type AS symbol, value AS price, make_timestamp((epoch_us(ts) // 1000) * 1000) AS time FROM events",
        "event_payload": _with(_CANDLES) + f"SELECT {', '.join(LANDING_COLUMNS)} FROM candles",
        "notifications": f"""SELECT '{LANDING_BUCKET}' AS bucket,
  '{LANDING_PREFIX}' || event_type || '/' || CAST(event_id AS VARCHAR) || '.parquet' AS key
FROM events WHERE event_type NOT IN ('error', 'signup', 'click')""",
        "rest_roundtrip": base
        + f"SELECT {', '.join(LANDING_COLUMNS)}, {_ts(LOAD_TIME)} AS created_at FROM latest",
        "pipeline_rollup_5min": base + f"SELECT {', '.join(LANDING_COLUMNS)} FROM ({rollup5})",
        "pipeline_backfill_latest": base + f"SELECT {', '.join(LANDING_COLUMNS)} FROM latest",
        "pipeline_incremental_rollup": f"SELECT {', '.join(LANDING_COLUMNS)} FROM ({incremental})",
        "pipeline_stream_messages": base + f"SELECT {', '.join(LANDING_COLUMNS)} FROM latest",
        "exchange_info_filters": """WITH s AS (
  SELECT event_type AS symbol, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS server_time,
    min(value) AS mn, max(value) AS mx,
    min(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS kmin,
    max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS kmax, count(*) AS n
  FROM events GROUP BY event_type, CAST(ts AS DATE))
SELECT server_time, symbol, 0 AS position, 'PRICE_FILTER' AS filter_type,
  CAST(CAST(floor(mn) AS BIGINT) AS VARCHAR) AS minPrice, CAST(CAST(ceil(mx) AS BIGINT) AS VARCHAR) AS maxPrice,
  '0.01' AS tickSize, NULL::VARCHAR AS minQty, NULL::VARCHAR AS maxQty, NULL::VARCHAR AS stepSize, NULL::BIGINT AS maxNumOrders
FROM s
UNION ALL
SELECT server_time, symbol, 1, 'LOT_SIZE', NULL, NULL, NULL, CAST(kmin AS VARCHAR), CAST(kmax AS VARCHAR), '1', NULL FROM s
UNION ALL
SELECT server_time, symbol, 2, 'MAX_NUM_ORDERS', NULL, NULL, NULL, NULL, NULL, NULL, n FROM s""",
    }


ORACLE: dict[str, str] = _oracle()
