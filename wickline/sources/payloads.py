"""Message payloads: object-store notifications (SRC-7), live candles
(SRC-8) and mini tickers (SRC-9), plus their typed projections (PRJ-2, PRJ-3).

All parsing is ``from_json`` on a string column, so the same functions serve
batch tables and streaming DataFrames.  A body is parsed once: its content and
the reason why it cannot be read are one struct, made by one generator that the
check and the projection both read from (:func:`_read_once`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.functions.convert import _strict_double
from wickline.functions.time import from_epoch_millis
from wickline.schemas import MINI_TICKER_KEYS, STREAM_KLINE_INNER_NAMES, STREAM_KLINE_INNER_RAW

# The accepted event name and the landing file suffix.
PUT_EVENT = "ObjectCreated:Put"
LANDING_SUFFIX = ".parquet"

_NOTIFICATION = T.StructType(
    [
        T.StructField(
            "Records",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("eventName", T.StringType()),
                        T.StructField(
                            "s3",
                            T.StructType(
                                [
                                    T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
                                    T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


Reason = Callable[[Column, Column], Column]


def _reason(body: Column, content: Column, reason: Reason) -> Column:
    """``reason(content, body)`` with the content evaluated once however often
    ``reason`` refers to it."""
    return F.transform(F.array(content), lambda c: reason(c, body))[0]


def _read_once(df: DataFrame, body: Column, content: Column, reason: Reason, keep: tuple[str, ...]) -> DataFrame:
    """``keep``, ``content`` and ``problem`` (NULL: readable) of every body.

    Both come out of one generator.  Catalyst would inline a plain column into
    each filter and projection above it and so parse the body again for each of
    them; nothing is moved below a generator or pruned out of it.
    """
    both = F.transform(F.array(content), lambda c: F.struct(c.alias("content"), reason(c, body).alias("problem")))
    made = df.select(*keep, body.alias("__body"), F.explode_outer(both).alias("__read"))
    return made.select(*keep, "__body", "__read.content", "__read.problem")


def _only_valid(read: DataFrame, what: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and ``content`` of rows without a problem; any other raises.  A
    filter below the projection, so no choice of output columns prunes it."""
    message = F.concat(F.lit(f"{what}: "), F.col("problem"), F.lit(": "), F.coalesce(F.substring("__body", 1, 300), F.lit("NULL")))
    ok = F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return read.filter(ok).select(*keep, "content")


def split_rejects(df: DataFrame, problem: Column, body_col: str = "body") -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects with ``body`` and ``reason``) instead of raising."""
    valid = df.filter(problem.isNull())
    return valid, df.filter(problem.isNotNull()).select(F.col(body_col).alias("body"), problem.alias("reason"))


def _records(body: Column) -> Column:
    return F.from_json(body, _NOTIFICATION)["Records"]


def _notification_reason(records: Column, body: Column) -> Column:
    lacking = F.exists(records, lambda r: r["s3"]["bucket"]["name"].isNull() | r["s3"]["object"]["key"].isNull())
    # the keys are looked for only where there are no records
    keys = F.json_object_keys(body)
    return (
        F.when(records.isNotNull(), F.when(lacking, F.lit("record without bucket/key")))
        .when(keys.isNull(), F.lit("no JSON object"))
        .when(F.array_contains(keys, "Records"), F.lit("Records is no list of objects"))
    )


def notification_problem(body: Column) -> Column:
    """Why a notification body cannot be read; NULL when it can.  A body
    without ``Records`` is a valid one without records."""
    return _reason(body, _records(body), _notification_reason)


def parse_notifications(df: DataFrame, body_col: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Notification bodies -> one (event_name, bucket, key) row per record.

    A body without ``Records`` gives no rows.  A malformed body and a record
    without bucket name or object key raise (``notification_problem`` tells
    them apart beforehand).
    """
    body = F.col(body_col)
    valid = _only_valid(_read_once(df, body, _records(body), _notification_reason, keep), "notification", keep)
    parsed = valid.select(*keep, F.explode("content").alias("__r"))
    return parsed.select(
        *keep,
        F.coalesce(F.col("__r.eventName"), F.lit("unknown")).alias("event_name"),
        F.col("__r.s3.bucket.name").alias("bucket"),
        F.col("__r.s3.object.key").alias("key"),
    )


def put_events(df: DataFrame) -> Column:
    """FLT-1: only plain puts; an absent event name reads as 'unknown'."""
    return F.coalesce(F.col("event_name"), F.lit("unknown")) == F.lit(PUT_EVENT)


def landing_keys(prefix: str, suffix: str = LANDING_SUFFIX) -> Column:
    """FLT-2: key under the landing prefix with the parquet suffix."""
    return F.col("key").startswith(prefix) & F.col("key").endswith(suffix)


def new_landing_files(df: DataFrame, prefix: str, body_col: str = "body", suffix: str = LANDING_SUFFIX) -> DataFrame:
    """SRC-7 + FLT-1 + FLT-2: the (bucket, key) pairs to load."""
    parsed = parse_notifications(df, body_col)
    return parsed.filter(put_events(parsed) & landing_keys(prefix, suffix)).select("bucket", "key")


def _stream_kline_schema() -> T.StructType:
    inner = T.StructType([T.StructField(n, t) for n, t in STREAM_KLINE_INNER_RAW])
    return T.StructType(
        [
            T.StructField("e", T.StringType()),
            T.StructField("E", T.LongType()),
            T.StructField("s", T.StringType()),
            T.StructField("k", inner),
        ]
    )


def _distinct_inner() -> T.StructType:
    return T.StructType(
        [T.StructField(n, t) for n, (_, t) in zip(STREAM_KLINE_INNER_NAMES, STREAM_KLINE_INNER_RAW)]
    )


def _kline_message(body: Column) -> Column:
    return F.from_json(body, _stream_kline_schema()).cast(
        T.StructType(
            [
                T.StructField("event_type", T.StringType()),
                T.StructField("event_ms", T.LongType()),
                T.StructField("symbol", T.StringType()),
                T.StructField("kline", _distinct_inner()),
            ]
        )
    )


def _kline_reason(msg: Column, body: Column) -> Column:
    present = F.lit(True)
    for name in ("event_type", "event_ms", "symbol"):
        present = present & msg[name].isNotNull()
    for name in STREAM_KLINE_INNER_NAMES:
        present = present & msg["kline"][name].isNotNull()
    # the keys are looked for only where a field is missing
    keys = F.json_object_keys(body)
    return F.when(
        ~F.coalesce(present, F.lit(False)),
        F.when(keys.isNull(), F.lit("no JSON object"))
        .when(~F.array_contains(keys, "k"), F.lit("no candle message"))
        .otherwise(F.lit("candle with a missing or invalid field")),
    )


def kline_problem(body: Column) -> Column:
    """Why a live candle message cannot be read; NULL when it can."""
    return _reason(body, _kline_message(body), _kline_reason)


def parse_stream_klines(df: DataFrame, body_col: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Live candle messages -> event_type, event_ms, symbol, kline struct.

    The inner keys differ only by case (t/T, v/V, q/Q, l/L), so the payload
    is parsed with the raw names and cast positionally onto a struct with
    distinct names; nothing downstream depends on case sensitivity.  Any
    other message (an acknowledgement, a broken text, a candle without its
    required fields) raises; ``kline_problem`` tells them apart beforehand.
    """
    body = F.col(body_col)
    valid = _only_valid(_read_once(df, body, _kline_message(body), _kline_reason, keep), "live candle", keep)
    return valid.select(*keep, "content.*")


def type_stream_klines(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-2: kline struct -> CANDLE columns (without created_at).

    Event time, interval, trade ids and the closed flag are dropped, so an
    open candle and its closed version share a key and the later load wins.
    """
    k = lambda n: F.col(f"kline.{n}")
    return df.select(
        k("symbol").alias("symbol"),
        from_epoch_millis(k("start_ms")).alias("open_time"),
        _strict_double(k("open")).alias("open_price"),
        _strict_double(k("high")).alias("high_price"),
        _strict_double(k("low")).alias("low_price"),
        _strict_double(k("close")).alias("close_price"),
        _strict_double(k("base_volume")).alias("volume"),
        from_epoch_millis(k("close_ms")).alias("close_time"),
        _strict_double(k("quote_volume")).alias("quote_asset_volume"),
        k("trades").alias("number_of_trades"),
        _strict_double(k("taker_base_volume")).alias("taker_buy_base_asset_volume"),
        _strict_double(k("taker_quote_volume")).alias("taker_buy_quote_asset_volume"),
        k("ignore").alias("ignore"),
        *keep,
    )


def _ticker_name(key: str) -> str:
    return f"key_{key}" if key.isupper() else key


def _ticker_items(body: Column) -> Column:
    raw = T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in MINI_TICKER_KEYS]))
    named = T.ArrayType(T.StructType([T.StructField(_ticker_name(k), T.StringType()) for k in MINI_TICKER_KEYS]))
    return F.from_json(body, raw).cast(named)


def _ticker_reason(items: Column, body: Column) -> Column:
    lacking = F.exists(items, lambda t: t["s"].isNull() | t["c"].try_cast("double").isNull() | t["key_E"].try_cast("long").isNull())
    # whether it is a list at all is looked up only where something is wrong
    return F.when(
        F.coalesce(lacking, F.lit(True)),
        F.when(F.json_array_length(body).isNull(), F.lit("no JSON list")).otherwise(F.lit("ticker with a missing or invalid field")),
    )


def ticker_problem(body: Column) -> Column:
    """Why a mini-ticker message cannot be read; NULL when it can."""
    return _reason(body, _ticker_items(body), _ticker_reason)


def parse_tickers(df: DataFrame, body_col: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Mini-ticker messages (a JSON *array* of objects) -> one row per ticker.

    The keys differ only by case, so each object is parsed once with the raw
    names and cast positionally onto distinct ones.  A message that is no
    list of objects with symbol, price and time raises.
    """
    body = F.col(body_col)
    valid = _only_valid(_read_once(df, body, _ticker_items(body), _ticker_reason, keep), "mini ticker", keep)
    items = valid.select(*keep, F.explode("content").alias("__t"))
    return items.select(*keep, *[F.col("__t")[_ticker_name(k)].alias(_ticker_name(k)) for k in MINI_TICKER_KEYS])


def type_tickers(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-3: (s, float(c), E ms) -> (symbol, price, time)."""
    return df.select(
        F.col("s").alias("symbol"),
        _strict_double(F.col("c")).alias("price"),
        from_epoch_millis(F.col("key_E").cast("long")).alias("time"),
        *keep,
    )
