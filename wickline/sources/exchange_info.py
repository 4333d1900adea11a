"""Exchange-info documents (SRC-10) and their tagged-union filters (SRC-11).

One document per row of a string column.  ``read_documents`` parses each
document once into a tree that one generator hands to all seven tables; every
list of the tree is exploded with Spark generators (``posexplode``), so
documents are processed in parallel and nothing is gathered on the driver.  Each
row carries the document's server time.  A missing optional list gives no rows;
a missing required field, an unknown rate-limit type or an unknown filter tag
raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.functions.time import from_epoch_millis

S, L, B = T.StringType(), T.LongType(), T.BooleanType()

# Fields required by each filter type (all other fields absent).
SYMBOL_FILTER_FIELDS: dict[str, list[str]] = {
    "PRICE_FILTER": ["minPrice", "maxPrice", "tickSize"],
    "PERCENT_PRICE": ["multiplierUp", "multiplierDown", "avgPriceMins"],
    "PERCENT_PRICE_BY_SIDE": ["bidMultiplierUp", "bidMultiplierDown", "askMultiplierUp", "askMultiplierDown", "avgPriceMins"],
    "LOT_SIZE": ["minQty", "maxQty", "stepSize"],
    "MIN_NOTIONAL": ["minNotional", "applyToMarket", "avgPriceMins"],
    "NOTIONAL": ["minNotional", "applyMinToMarket", "maxNotional", "applyMaxToMarket", "avgPriceMins"],
    "ICEBERG_PARTS": ["limit"],
    "MARKET_LOT_SIZE": ["minQty", "maxQty", "stepSize"],
    "MAX_NUM_ORDERS": ["maxNumOrders"],
    "MAX_NUM_ALGO_ORDERS": ["maxNumAlgoOrders"],
    "MAX_NUM_ICEBERG_ORDERS": ["maxNumIcebergOrders"],
    "MAX_POSITION": ["maxPosition"],
    "TRAILING_DELTA": ["minTrailingAboveDelta", "maxTrailingAboveDelta", "minTrailingBelowDelta", "maxTrailingBelowDelta"],
}
EXCHANGE_FILTER_FIELDS: dict[str, list[str]] = {
    "EXCHANGE_MAX_NUM_ORDERS": ["maxNumOrders"],
    "EXCHANGE_MAX_NUM_ALGO_ORDERS": ["maxNumAlgoOrders"],
    "EXCHANGE_MAX_NUM_ICEBERG_ORDERS": ["maxNumIcebergOrders"],
}
# Type of every filter field.
FILTER_FIELD_TYPES: dict[str, T.DataType] = {
    "minPrice": S, "maxPrice": S, "tickSize": S,
    "multiplierUp": S, "multiplierDown": S, "avgPriceMins": L,
    "bidMultiplierUp": S, "bidMultiplierDown": S, "askMultiplierUp": S, "askMultiplierDown": S,
    "minQty": S, "maxQty": S, "stepSize": S,
    "minNotional": S, "applyToMarket": B, "applyMinToMarket": B, "maxNotional": S, "applyMaxToMarket": B,
    "limit": L,
    "maxNumOrders": L, "maxNumAlgoOrders": L, "maxNumIcebergOrders": L,
    "maxPosition": S,
    "minTrailingAboveDelta": L, "maxTrailingAboveDelta": L, "minTrailingBelowDelta": L, "maxTrailingBelowDelta": L,
}
RATE_LIMIT_TYPES = ["REQUEST_WEIGHT", "ORDERS", "RAW_REQUESTS"]

# Symbol fields and types; quotePrecision is the only optional one.
SYMBOL_FIELDS: list[tuple[str, T.DataType]] = [
    ("symbol", S), ("status", S), ("baseAsset", S), ("baseAssetPrecision", L), ("quoteAsset", S),
    ("quotePrecision", L), ("quoteAssetPrecision", L), ("baseCommissionPrecision", L),
    ("quoteCommissionPrecision", L), ("orderTypes", T.ArrayType(S)), ("icebergAllowed", B),
    ("ocoAllowed", B), ("otoAllowed", B), ("quoteOrderQtyMarketAllowed", B), ("allowTrailingStop", B),
    ("cancelReplaceAllowed", B), ("isSpotTradingAllowed", B), ("isMarginTradingAllowed", B),
    ("filters", None), ("permissions", T.ArrayType(S)), ("permissionSets", T.ArrayType(T.ArrayType(S))),
    ("defaultSelfTradePreventionMode", S), ("allowedSelfTradePreventionModes", T.ArrayType(S)),
]
SYMBOL_OPTIONAL = {"quotePrecision"}


def filter_struct() -> T.StructType:
    """Superset of every filter variant; absent fields parse as NULL."""
    return T.StructType([T.StructField("filterType", S)] + [T.StructField(n, t) for n, t in FILTER_FIELD_TYPES.items()])


def exchange_info_schema() -> T.StructType:
    flt = T.ArrayType(filter_struct())
    symbol = T.StructType([T.StructField(n, flt if n == "filters" else t) for n, t in SYMBOL_FIELDS])
    rate = T.StructType([T.StructField("rateLimitType", S), T.StructField("interval", S), T.StructField("intervalNum", L), T.StructField("limit", L)])
    sor = T.StructType([T.StructField("baseAsset", S), T.StructField("symbols", T.ArrayType(S))])
    return T.StructType(
        [
            T.StructField("timezone", S),
            T.StructField("serverTime", L),
            T.StructField("rateLimits", T.ArrayType(rate)),
            T.StructField("exchangeFilters", flt),
            T.StructField("symbols", T.ArrayType(symbol)),
            T.StructField("sors", T.ArrayType(sor)),
        ]
    )


def _require(df: DataFrame, cond: str, message: str) -> DataFrame:
    """``df`` unchanged; a row that fails ``cond`` raises.  A filter, so the
    check stays whatever columns are used later."""
    return df.filter(F.expr(f"CASE WHEN coalesce({cond}, false) THEN true ELSE CAST(raise_error({message}) AS BOOLEAN) END"))


def _all_present(prefix: str, fields: list[str]) -> str:
    return " AND ".join([f"{prefix}.`{f}` IS NOT NULL" for f in fields]) or "true"


def resolve_filters(df: DataFrame, struct_col: str = "filter", variants: dict[str, list[str]] | None = None) -> DataFrame:
    """SRC-11: check each filter's tag and that its required fields are present.

    Output keeps ``filter_type`` and every field of the superset struct; the
    fields a tag does not define stay NULL.
    """
    variants = variants if variants is not None else SYMBOL_FILTER_FIELDS
    tag = f"`{struct_col}`.filterType"
    known = ", ".join(f"'{v}'" for v in variants)
    cases = " ".join(f"WHEN '{name}' THEN {_all_present(f'`{struct_col}`', fields)}" for name, fields in variants.items())
    message = (
        f"concat('invalid filter (', coalesce({tag}, 'no filterType'), "
        f"CASE WHEN {tag} IN ({known}) THEN '): missing field' ELSE '): unknown type' END, ': ', to_json(`{struct_col}`))"
    )
    checked = _require(df, f"CASE {tag} {cases} ELSE false END", message)
    rest = [f"`{struct_col}`.`{n}` AS `{n}`" for n in FILTER_FIELD_TYPES]
    others = [f"`{c}`" for c in df.columns if c != struct_col]
    return checked.selectExpr(*others, f"{tag} AS filter_type", *rest)


def read_documents(df: DataFrame, body_col: str = "body") -> DataFrame:
    """Documents -> ``server_time`` and ``doc``, the whole tree, each parsed once.

    The tree comes out of a generator, which Catalyst neither moves the checks
    and projections above it below nor evaluates twice; a plain column would be
    inlined, and the document parsed again, wherever it is used.  A document
    without time zone, server time or symbols raises.
    """
    tree = F.transform(F.array(F.from_json(F.col(body_col), exchange_info_schema())), lambda d: F.struct(d.alias("doc")))
    parsed = df.select(F.explode_outer(tree).alias("__read")).select("__read.doc")
    checked = _require(parsed, _all_present("doc", ["timezone", "serverTime", "symbols"]), "concat('invalid exchange info: ', coalesce(to_json(doc), 'unparseable'))")
    return checked.select(from_epoch_millis(F.col("doc.serverTime")).alias("server_time"), "doc")


def _header(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("doc.timezone AS timezone", "server_time", "size(doc.symbols) AS symbol_count")


def _rate_limits(docs: DataFrame) -> DataFrame:
    rates = docs.selectExpr("server_time", "posexplode(doc.rateLimits) AS (position, r)")
    kinds = ", ".join(f"'{k}'" for k in RATE_LIMIT_TYPES)
    fields = _all_present("r", ["interval", "intervalNum", "limit"])
    rates = _require(rates, f"r.rateLimitType IN ({kinds}) AND {fields}", "concat('invalid rate limit: ', coalesce(to_json(r), 'NULL'))")
    return rates.selectExpr("server_time", "position", "r.rateLimitType AS rate_limit_type", "r.interval AS interval", "r.intervalNum AS interval_num", "r.limit AS limit")


def _exchange_filters(docs: DataFrame) -> DataFrame:
    return resolve_filters(docs.selectExpr("server_time", "posexplode(doc.exchangeFilters) AS (position, filter)"), "filter", EXCHANGE_FILTER_FIELDS)


def _checked_symbols(docs: DataFrame) -> DataFrame:
    rows = docs.selectExpr("server_time", "posexplode(doc.symbols) AS (symbol_index, s)")
    required = [n for n, _ in SYMBOL_FIELDS if n not in SYMBOL_OPTIONAL]
    return _require(rows, _all_present("s", required), "concat('invalid symbol: ', coalesce(to_json(s), 'NULL'))")


def _symbols(docs: DataFrame) -> DataFrame:
    scalar = [n for n, _ in SYMBOL_FIELDS if n not in ("filters", "permissionSets")]
    return _checked_symbols(docs).selectExpr("server_time", "symbol_index", *[f"s.`{n}` AS `{n}`" for n in scalar])


def _symbol_filters(docs: DataFrame) -> DataFrame:
    rows = _checked_symbols(docs).selectExpr("server_time", "s.symbol AS symbol", "posexplode(s.filters) AS (position, filter)")
    return resolve_filters(rows, "filter", SYMBOL_FILTER_FIELDS)


def _permission_sets(docs: DataFrame) -> DataFrame:
    sets = _checked_symbols(docs).selectExpr("server_time", "s.symbol AS symbol", "posexplode(s.permissionSets) AS (set_index, perms)")
    return sets.selectExpr("server_time", "symbol", "set_index", "posexplode(perms) AS (position, permission)")


def _order_routing(docs: DataFrame) -> DataFrame:
    sors = docs.selectExpr("server_time", "posexplode(doc.sors) AS (group_index, g)")
    sors = _require(sors, _all_present("g", ["baseAsset", "symbols"]), "concat('invalid order routing: ', coalesce(to_json(g), 'NULL'))")
    return sors.selectExpr("server_time", "group_index", "g.baseAsset AS base_asset", "posexplode(g.symbols) AS (position, symbol)")


TABLES = {
    "header": _header,
    "rate_limits": _rate_limits,
    "exchange_filters": _exchange_filters,
    "symbols": _symbols,
    "symbol_filters": _symbol_filters,
    "permission_sets": _permission_sets,
    "order_routing": _order_routing,
}


def exchange_table(df: DataFrame, table: str, body_col: str = "body") -> DataFrame:
    """One of the seven tables (a key of ``TABLES``) of a column of documents."""
    return TABLES[table](read_documents(df, body_col))


def flatten_exchange_info(df: DataFrame, body_col: str = "body") -> dict[str, DataFrame]:
    """SRC-10: header, rate_limits, exchange_filters, symbols, symbol_filters,
    permission_sets, order_routing.  Each child row carries ``server_time``."""
    docs = read_documents(df, body_col)
    return {name: table(docs) for name, table in TABLES.items()}
