"""Parsers and projections: pages (SRC-1, PRJ-1), notifications (SRC-7, FLT-1/2),
live candles (SRC-8, PRJ-2), mini tickers (SRC-9, PRJ-3), exchange info (SRC-10/11)."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from wickline.functions.convert import stamp, type_klines
from wickline.schemas import CANDLE_COLUMNS, LANDING
from wickline.sources.exchange_info import flatten_exchange_info
from wickline.sources.landing import to_landing
from wickline.sources.pages import page_problem, parse_kline_pages
from wickline.sources.payloads import (
    kline_problem,
    new_landing_files,
    notification_problem,
    parse_notifications,
    parse_stream_klines,
    parse_tickers,
    split_rejects,
    ticker_problem,
    type_stream_klines,
    type_tickers,
)

ERRORS = (PySparkException, Py4JJavaError)

# Fixture F1
PAGE = (
    '[[1612345680000,"7.31250000","7.90000000","7.11000000","7.42000000","1203.50640000",1612345739999,'
    '"8845.77210000",57,"640.25000000","4711.90000000","0"],'
    '[1612345740000,"7.42000000","7.55000000","7.38000000","7.50000000","903.00000000",1612345799999,'
    '"6772.50000000",31,"455.00000000","3412.50000000","0"]]'
)


def test_page_parse_keeps_text(spark):
    df = spark.createDataFrame([("QZAUSDT", PAGE)], "symbol string, payload string")
    landing = to_landing(parse_kline_pages(df))
    assert landing.schema == LANDING
    rows = landing.orderBy("open_time").collect()
    assert len(rows) == 2
    assert rows[0].open_price == "7.31250000" and rows[0].volume == "1203.50640000"
    assert rows[0].open_time == dt.datetime(2021, 2, 3, 9, 48)
    assert rows[0].close_time == 1612345739999 and rows[0].number_of_trades == 57
    typed = type_klines(landing).orderBy("open_time").collect()
    assert typed[0].open_price == pytest.approx(7.3125)
    assert typed[0].close_time == dt.datetime(2021, 2, 3, 9, 48, 59, 999000)


def test_empty_page_gives_no_rows(spark):
    df = spark.createDataFrame([("QZAUSDT", "[]")], "symbol string, payload string")
    assert parse_kline_pages(df).count() == 0


@pytest.mark.parametrize("payload", [None, "", "not json", '{"code": -1121, "msg": "no such symbol"}', "[[1,2", '[{"a": 1}]', "[5]"])
def test_malformed_page_raises(spark, payload):
    df = spark.createDataFrame([("QZAUSDT", PAGE), ("QZAUSDT", payload)], "symbol string, payload string")
    with pytest.raises(ERRORS):
        parse_kline_pages(df).select("symbol").collect()
    assert [r.p is None for r in df.select(page_problem(df["payload"]).alias("p")).collect()] == [True, False]


def test_short_row_and_bad_price_raise(spark):
    short = spark.createDataFrame([("X", '[[1,"1","1","1","1","1",2,"1",3,"1","1"]]')], "symbol string, payload string")
    with pytest.raises(ERRORS):
        parse_kline_pages(short).collect()
    bad = spark.createDataFrame([("X", '[[1,"abc","1","1","1","1",2,"1",3,"1","1","0"]]')], "symbol string, payload string")
    with pytest.raises(ERRORS):
        type_klines(parse_kline_pages(bad)).collect()


def test_stamp_overwrites_created_at(spark):
    df = spark.createDataFrame([("QZAUSDT", PAGE)], "symbol string, payload string")
    now = dt.datetime(2025, 1, 15, 10, 5, 7, 123456)
    out = stamp(type_klines(parse_kline_pages(df)), CANDLE_COLUMNS, now=now)
    assert out.columns == CANDLE_COLUMNS
    assert {r.created_at for r in out.collect()} == {dt.datetime(2025, 1, 15, 10, 5, 7)}


# Fixture F7
NOTE = json.dumps(
    {
        "Records": [
            {
                "eventName": "ObjectCreated:Put",
                "s3": {"bucket": {"name": "drop-box-7"}, "object": {"key": "incoming/candles/lumusd/test.parquet"}},
            }
        ]
    }
)


def _note(event, key, bucket="drop-box-7"):
    rec = {"s3": {"bucket": {"name": bucket}, "object": {"key": key}}}
    if event is not None:
        rec["eventName"] = event
    return json.dumps({"Records": [rec]})


def test_notifications_filtering(spark):
    bodies = [
        (NOTE,),
        (_note("ObjectCreated:Put", "elsewhere/test.parquet"),),
        (_note("ObjectCreated:Put", "incoming/candles/lumusd/test.txt"),),
        (_note("ObjectRemoved:Delete", "incoming/candles/lumusd/x.parquet"),),
        (_note(None, "incoming/candles/lumusd/y.parquet"),),
        ('{"Service":"test","Event":"s3:TestEvent"}',),
    ]
    df = spark.createDataFrame(bodies, "body string")
    got = [tuple(r) for r in new_landing_files(df, "incoming/candles/").collect()]
    assert got == [("drop-box-7", "incoming/candles/lumusd/test.parquet")]
    events = {r.event_name for r in parse_notifications(df).collect()}
    assert "unknown" in events


@pytest.mark.parametrize("body", [None, "", "not json", "[1]", '{"Records": 5}', '{"Records": [{"s3": {"bucket": {"name": "b"}}}]}'])
def test_malformed_notification_raises(spark, body):
    df = spark.createDataFrame([(NOTE,), (body,)], "body string")
    with pytest.raises(ERRORS):
        parse_notifications(df).select("event_name").collect()
    good, bad = split_rejects(df, notification_problem(df["body"]))
    assert parse_notifications(good).count() == 1
    assert [(r.body, bool(r.reason)) for r in bad.collect()] == [(body, True)]


@pytest.mark.parametrize("body", [None, "", "{", '{"result":null,"id":1}', '{"e":"kline","E":1,"s":"X","k":{"t":1}}', "[]"])
def test_other_messages_are_no_candles(spark, body):
    df = spark.createDataFrame([(KLINE,), (body,)], "body string")
    with pytest.raises(ERRORS):
        parse_stream_klines(df).select("symbol").collect()
    good, bad = split_rejects(df, kline_problem(df["body"]))
    assert parse_stream_klines(good).count() == 1 and bad.count() == 1


@pytest.mark.parametrize("body", [None, "", "{", '{"result":null}', '[{"s": "X"}]', '[{"s":"X","c":"abc","E":1}]', "[1]"])
def test_malformed_tickers_raise(spark, body):
    df = spark.createDataFrame([(TICKERS,), (body,), ("[]",)], "body string")
    with pytest.raises(ERRORS):
        parse_tickers(df).select("s").collect()
    good, bad = split_rejects(df, ticker_problem(df["body"]))
    assert parse_tickers(good).count() == 3 and bad.count() == 1


def test_notification_without_key_raises(spark):
    body = json.dumps({"Records": [{"eventName": "ObjectCreated:Put", "s3": {"bucket": {"name": "b"}, "object": {}}}]})
    with pytest.raises(ERRORS):
        parse_notifications(spark.createDataFrame([(body,)], "body string")).collect()


# Fixture F8
KLINE = (
    '{"e":"kline","E":1718000401250,"s":"LUMUSDT","k":{"t":1718000400000,"T":1718000400999,"s":"LUMUSDT",'
    '"i":"1s","f":880011,"L":880019,"o":"31.40500000","c":"31.40500000","h":"31.40500000",'
    '"l":"31.39000000","v":"17.25000000","n":9,"x":true,"q":"541.73625000","V":"6.50000000",'
    '"Q":"204.13250000","B":"0"}}'
)


def test_stream_kline_case_colliding_keys(spark):
    df = spark.createDataFrame([(KLINE,)], "body string")
    parsed = parse_stream_klines(df).first()
    assert parsed.event_type == "kline" and parsed.event_ms == 1718000401250
    assert parsed.kline.closed is True and parsed.kline.interval == "1s"
    r = type_stream_klines(parse_stream_klines(df)).first()
    assert r.volume == pytest.approx(17.25)
    assert r.taker_buy_base_asset_volume == pytest.approx(6.5)
    assert r.quote_asset_volume == pytest.approx(541.73625)
    assert r.taker_buy_quote_asset_volume == pytest.approx(204.1325)
    assert r.low_price == pytest.approx(31.39)
    assert r.number_of_trades == 9
    assert r.open_time == dt.datetime(2024, 6, 10, 6, 20)
    assert r.close_time == dt.datetime(2024, 6, 10, 6, 20, 0, 999000)


# Fixture F9
TICKERS = json.dumps(
    [
        {"e": "24hrMiniTicker", "E": 1718003600321, "s": "ORBUSDT", "c": "2.05500000", "o": "1.98000000",
         "h": "2.10000000", "l": "1.95500000", "v": "30411.25000000", "q": "62495.12000000"},
        {"e": "24hrMiniTicker", "E": 1718003600340, "s": "ORBUSDC", "c": "2.05600000", "o": "1.98200000",
         "h": "2.11000000", "l": "1.95700000", "v": "7120.50000000", "q": "14640.75000000"},
        {"e": "24hrMiniTicker", "E": 1718003600355, "s": "ORBEUR", "c": "2.06000000", "o": "1.98500000",
         "h": "2.12000000", "l": "1.96000000", "v": "2985.00000000", "q": "6148.20000000"},
    ]
)


def test_tickers(spark):
    df = spark.createDataFrame([(TICKERS,)], "body string")
    rows = type_tickers(parse_tickers(df)).collect()
    assert len(rows) == 3
    assert (rows[0].symbol, rows[0].price, rows[0].time) == ("ORBUSDT", 2.055, dt.datetime(2024, 6, 10, 7, 13, 20, 321000))


# Fixture F10
EXCHANGE_INFO = {
    "timezone": "UTC",
    "serverTime": 1718003600777,
    "rateLimits": [
        {"rateLimitType": "REQUEST_WEIGHT", "interval": "MINUTE", "intervalNum": 1, "limit": 4800},
        {"rateLimitType": "ORDERS", "interval": "SECOND", "intervalNum": 1, "limit": 25},
    ],
    "exchangeFilters": [{"filterType": "EXCHANGE_MAX_NUM_ORDERS", "maxNumOrders": 350}],
    "symbols": [
        {
            "symbol": "QZALUM", "status": "TRADING", "baseAsset": "QZA", "baseAssetPrecision": 8,
            "quoteAsset": "LUM", "quotePrecision": 8, "quoteAssetPrecision": 8, "baseCommissionPrecision": 8,
            "quoteCommissionPrecision": 8, "orderTypes": ["LIMIT", "MARKET"], "icebergAllowed": True,
            "ocoAllowed": True, "otoAllowed": True, "quoteOrderQtyMarketAllowed": True, "allowTrailingStop": False,
            "cancelReplaceAllowed": False, "isSpotTradingAllowed": True, "isMarginTradingAllowed": True,
            "filters": [], "permissions": [], "permissionSets": [["SPOT"]],
            "defaultSelfTradePreventionMode": "NONE", "allowedSelfTradePreventionModes": ["NONE"],
        }
    ],
    "sors": [{"baseAsset": "LUM", "symbols": ["LUMUSDT", "LUMUSDC"]}],
}


def _flat(spark, doc):
    return flatten_exchange_info(spark.createDataFrame([(json.dumps(doc),)], "body string"))


def test_exchange_info_flatten(spark):
    t = _flat(spark, EXCHANGE_INFO)
    assert t["header"].first().timezone == "UTC"
    assert [r.limit for r in t["rate_limits"].orderBy("position").collect()] == [4800, 25]
    ef = t["exchange_filters"].first()
    assert (ef.filter_type, ef.maxNumOrders) == ("EXCHANGE_MAX_NUM_ORDERS", 350)
    assert t["symbols"].first().symbol == "QZALUM"
    assert t["symbol_filters"].count() == 0
    assert [tuple(r) for r in t["permission_sets"].select("symbol", "set_index", "permission").collect()] == [("QZALUM", 0, "SPOT")]
    assert [r.symbol for r in t["order_routing"].orderBy("position").collect()] == ["LUMUSDT", "LUMUSDC"]


def test_exchange_info_optional_lists(spark):
    doc = {k: v for k, v in EXCHANGE_INFO.items() if k not in ("rateLimits", "exchangeFilters", "sors")}
    t = _flat(spark, doc)
    assert t["rate_limits"].count() == 0 and t["order_routing"].count() == 0 and t["symbols"].count() == 1


def test_symbol_filters_tagged_union(spark):
    doc = json.loads(json.dumps(EXCHANGE_INFO))
    doc["symbols"][0]["filters"] = [
        {"filterType": "PRICE_FILTER", "minPrice": "0.01", "maxPrice": "1000.00", "tickSize": "0.01"},
        {"filterType": "NOTIONAL", "minNotional": "5", "applyMinToMarket": True, "maxNotional": "9000000",
         "applyMaxToMarket": False, "avgPriceMins": 5},
        {"filterType": "TRAILING_DELTA", "minTrailingAboveDelta": 10, "maxTrailingAboveDelta": 2000,
         "minTrailingBelowDelta": 10, "maxTrailingBelowDelta": 2000},
    ]
    rows = _flat(spark, doc)["symbol_filters"].orderBy("position").collect()
    assert [r.filter_type for r in rows] == ["PRICE_FILTER", "NOTIONAL", "TRAILING_DELTA"]
    assert rows[0].tickSize == "0.01" and rows[0].avgPriceMins is None
    assert rows[1].applyMinToMarket is True and rows[2].maxTrailingBelowDelta == 2000

    missing = json.loads(json.dumps(EXCHANGE_INFO))
    missing["symbols"][0]["filters"] = [{"filterType": "LOT_SIZE", "minQty": "1", "maxQty": "2"}]
    with pytest.raises(ERRORS):
        _flat(spark, missing)["symbol_filters"].collect()
    unknown = json.loads(json.dumps(EXCHANGE_INFO))
    unknown["symbols"][0]["filters"] = [{"filterType": "NOT_A_FILTER"}]
    with pytest.raises(ERRORS):
        _flat(spark, unknown)["symbol_filters"].collect()


def test_bad_rate_limit_type_raises(spark):
    doc = json.loads(json.dumps(EXCHANGE_INFO))
    doc["rateLimits"][0]["rateLimitType"] = "SOMETHING"
    with pytest.raises(ERRORS):
        _flat(spark, doc)["rate_limits"].collect()


def test_checks_survive_projection(spark):
    doc = json.loads(json.dumps(EXCHANGE_INFO))
    doc["symbols"][0]["filters"] = [{"filterType": "NOT_A_FILTER", "minPrice": "1"}]
    doc["sors"] = [{"symbols": ["LUMUSDT"]}]
    doc["rateLimits"][0]["rateLimitType"] = "SOMETHING"
    t = _flat(spark, doc)
    for table, column in (("symbol_filters", "minPrice"), ("order_routing", "symbol"), ("rate_limits", "limit")):
        with pytest.raises(ERRORS):
            t[table].select(column).collect()


@pytest.mark.parametrize("parse", [lambda d: type_stream_klines(parse_stream_klines(d)), parse_notifications, lambda d: type_tickers(parse_tickers(d))])
def test_payloads_are_parsed_once(spark, parse):
    df = spark.createDataFrame([("{}",)], "body string").repartition(2)
    for out in (parse(df), parse(df).select(parse(df).columns[0])):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_exchange_documents_are_parsed_once(spark):
    from wickline.sources.exchange_info import TABLES, exchange_table

    df = spark.createDataFrame([("{}",)], "body string").repartition(2)
    for name in TABLES:
        out = exchange_table(df, name)
        assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
        with pytest.raises(ERRORS):
            out.select(out.columns[-1]).collect()
