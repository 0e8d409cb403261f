"""Trade history arrays -> one row per trade.

A payload ``{"prices": [["Oct 17 2025 01: +0", "12.34", 3], ...]}`` becomes
rows ``(name, app_id, ts_text, ts, price, amount, source, currency, raw)``.
The date text is kept as sent; ``ts`` is the UTC time it names (the hour less
the ``: +3`` offset); text that does not parse gives NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The trade-date text format (month abbreviation, day, year,
# hour, then ": +<offset>") and the defaults the loader tags rows with (app id,
# source tag, currency code).
TRADE_TS_PATTERN = "MMM dd yyyy HH z"
TRADE_TS_SUFFIX = r":\s*([+-]\d{1,2})$"
DEFAULT_APP_ID = 730
DEFAULT_SOURCE = "steam_pricehistory"
DEFAULT_CURRENCY = "5"
PRICES_SCHEMA = "struct<prices: array<array<string>>>"


def explode_trades(
    df: DataFrame,
    name_col: str = "market_hash_name",
    json_col: str = "payload",
    app_id: int | None = DEFAULT_APP_ID,
    source: str = DEFAULT_SOURCE,
    currency: str | None = DEFAULT_CURRENCY,
) -> DataFrame:
    """Explode each row's price triples; price -> double, amount -> bigint.

    Bad price or amount text raises (ANSI cast), as the loader's own
    ``float()``/``int()`` would.
    """
    prices = F.from_json(F.col(json_col), PRICES_SCHEMA)["prices"]
    e = F.col("__e")
    ts_text = e[0]
    local = F.try_to_timestamp(
        F.concat(F.regexp_replace(ts_text, TRADE_TS_SUFFIX, ""), F.lit(" UTC")), F.lit(TRADE_TS_PATTERN))
    offset = F.coalesce(F.nullif(F.regexp_extract(ts_text, TRADE_TS_SUFFIX, 1), F.lit("")).cast("int"), F.lit(0))
    return df.select(F.col(name_col).alias("name"), F.explode(prices).alias("__e")).select(
        "name",
        F.lit(app_id).cast("int").alias("app_id"),
        ts_text.alias("ts_text"),
        F.timestamp_add("HOUR", -offset, local).alias("ts"),
        e[1].cast("double").alias("price"),
        e[2].cast("bigint").alias("amount"),
        F.lit(source).alias("source"),
        F.lit(currency).cast("string").alias("currency"),
        F.lit(None).cast("string").alias("raw"),
    )
