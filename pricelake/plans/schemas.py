"""Schemas of the warehouse tables (what the DDL of a database would declare).

Parquet enforces no keys: the keys below are the merge keys of the writers
and the subject of the quality checks. ODS day-partitioned tables also carry
``day`` (the UTC day of ``date_extracted``) as their partition column.
"""

from __future__ import annotations

from pyspark.sql import types as T

from pricelake.functions.json_fields import PRICE_TYPE
from pricelake.operators.staging import BOOK_A_PRICES, PERIOD_STATS, PERIODS
from pricelake.sources.raw import POSITION

_S, _TS, _D, _I, _L, _DBL = T.StringType(), T.TimestampType(), T.DateType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


RAW = _struct(("payload", _S), ("created_at", _TS), ("ingest_date", _D), ("load_pos", POSITION),
              ("body", T.VariantType()), ("unparsed", _S), ("payload_hash", _L))

PRODUCT = _struct(("id_name", _S), ("name", _S), ("item_page", _S), ("market_page", _S))
BOOK_A = _struct(("id_name", _S), ("date_extracted", _TS), *[(p, PRICE_TYPE) for p in BOOK_A_PRICES])
HISTORY = _struct(
    ("id_name", _S),
    *[(f"{pr}_{s}", _I if s == "volume" else PRICE_TYPE) for pr in PERIODS for s in PERIOD_STATS],
    ("date_extracted", _TS),
)
BOOK_B = _struct(("id_name", _S), ("date_extracted", _TS), ("price", PRICE_TYPE))

SALES_HISTORY = _struct(("item_name", _S), ("date_extracted", _D), ("avg_price_24h", PRICE_TYPE), ("volume_24h", _I))
GROUP_ANALYTICS = _struct(("group_name", _S), ("date_extracted", _D), ("avg_price", _DBL), ("total_volume", _L))
ORDER_BOOKS = _struct(("item_name", _S), ("price_a", PRICE_TYPE), ("price_b", PRICE_TYPE),
                      ("price_diff", T.DecimalType(19, 4)), ("date_extracted", _TS))
ARBITRAGE = _struct(("item_name", _S), ("buy_platform", _S), ("sell_platform", _S),
                    ("profit_abs", T.DecimalType(19, 4)), ("profit_pct", _DBL), ("date_extracted", _TS))
VOLATILITY = _struct(("item_name", _S), ("spread_7d", T.DecimalType(19, 4)), ("volatility_index", _DBL),
                     ("volume_7d", _I), ("date_extracted", _D))

ODS = {"product": PRODUCT, "book_a": BOOK_A, "history": HISTORY, "book_b": BOOK_B}
MARTS = {"sales_history": SALES_HISTORY, "group_analytics": GROUP_ANALYTICS, "order_books": ORDER_BOOKS,
         "arbitrage": ARBITRAGE, "volatility": VOLATILITY}

# Merge keys (the UNIQUE / PRIMARY KEY a database would enforce).
KEYS = {
    "product": ["id_name"], "book_a": ["id_name", "date_extracted"], "history": ["id_name", "date_extracted"],
    "book_b": ["id_name", "date_extracted"], "sales_history": ["item_name", "date_extracted"],
    "group_analytics": ["group_name", "date_extracted"], "order_books": ["item_name", "date_extracted"],
    "arbitrage": ["item_name", "date_extracted"], "volatility": ["item_name", "date_extracted"],
}
