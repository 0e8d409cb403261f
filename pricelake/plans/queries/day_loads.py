"""Day loads: book-B staging, book-A day upsert, catalog loader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import catalog, merge, staging
from pricelake.plans import fixture_views as fv
from pricelake.plans.queries.base import _dbl, register, uuid5_sql, LOAD_TS
from pricelake.sources import raw as rawsrc

def _iso_utc(col: str) -> F.Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _user_name(col: str = "user_id") -> F.Column:
    return F.concat(F.lit("user "), F.col(col).cast("string"))


@register("stage_book_b", f"""
SELECT {uuid5_sql("'user ' || CAST(user_id AS VARCHAR)")} AS id_name, ts AS date_extracted,
       CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS price
FROM events WHERE event_type = 'purchase'
""")
def q_stage_book_b(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases as listings: the listing time travels inside the payload as
    ISO text; the load happens an hour later."""
    ev = fv.Tables(spark, sf).events.filter(F.col("event_type") == "purchase")
    rows = ev.select(_user_name().alias("market_hash_name"), _iso_utc("ts").alias("created_at"),
                     F.col("value").cast("string").alias("price"),
                     (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("load_ts"))
    raw = rawsrc.payloads_from_rows(rows, ["market_hash_name", "created_at", "price"], ts_col="load_ts")
    book = staging.dedup_staged(staging.stage_book_b(raw))
    return _dbl(book, "price").withColumn("date_extracted", F.col("date_extracted").cast("timestamp_ntz"))


def _book_a_raw(events: DataFrame, factor: float) -> DataFrame:
    rows = events.filter(F.col("event_type").isin(*fv.BOOK_A_TYPES)).select(
        _user_name().alias("market_hash_name"),
        (F.col("value") * factor).cast("string").alias("suggested_price"),
        F.col("value").cast("string").alias("min_price"),
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("value").cast("string")).alias("max_price"),
        "ts")
    return rawsrc.payloads_from_rows(rows, ["market_hash_name", "suggested_price", "min_price", "max_price"],
                                     ts_col="ts")


@register("ods_book_a_day", f"""
WITH a AS (
  SELECT {uuid5_sql("'user ' || CAST(user_id AS VARCHAR)")} AS id_name, ts AS date_extracted,
         CASE WHEN CAST(ts AS DATE) = DATE '2024-01-30' THEN value ELSE value * 2 END AS sp,
         value AS mn, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS mx
  FROM events WHERE event_type IN ('view', 'click')
)
SELECT id_name, date_extracted, CAST(CAST(sp AS DECIMAL(18,4)) AS DOUBLE) AS suggested_price,
       CAST(CAST(mn AS DECIMAL(18,4)) AS DOUBLE) AS min_price, CAST(CAST(mx AS DECIMAL(18,4)) AS DOUBLE) AS max_price,
       CAST(NULL AS DOUBLE) AS mean_price, CAST(NULL AS DOUBLE) AS median_price
FROM a
""")
def q_ods_book_a_day(spark: SparkSession, sf: str) -> DataFrame:
    """Day load of book A: the table holds every view/click with a doubled
    (wrong) price; the raw zone's 2024-01-30 load is filtered by its partition
    day, staged, deduplicated and upserted, fixing that day's prices."""
    ev = fv.Tables(spark, sf).events
    existing = staging.dedup_staged(staging.stage_book_a(_book_a_raw(ev, 2.0)))
    day_rows = staging.dedup_staged(staging.stage_book_a(staging.for_day(_book_a_raw(ev, 1.0), "2024-01-30")))
    out = merge.upsert(existing, day_rows, ["id_name", "date_extracted"])
    out = _dbl(out, *staging.BOOK_A_PRICES)
    return out.withColumn("date_extracted", F.col("date_extracted").cast("timestamp_ntz"))


def _catalog_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Catalog fixture: one items load and one statistics load built from the
    part table, positioned in the load by part key (a later part of the same
    name wins), and an existing catalog that already has image links."""
    part = fv.Tables(spark, sf).part
    items = part.select("p_partkey",
        F.col("p_name").alias("market_hash_name"), F.lit("EUR").alias("currency"),
        F.col("p_retailprice").alias("suggested_price"), F.col("p_type").alias("item_page"),
        F.col("p_size").alias("quantity"))
    stats = part.select("p_partkey",
        F.col("p_name").alias("market_hash_name"), F.lit("EUR").alias("currency"),
        F.col("p_brand").alias("item_page"),
        *[F.struct(F.col("p_retailprice").alias("min"), (F.col("p_retailprice") * (i + 2)).alias("max"),
                   F.col("p_size").alias("volume")).alias(pr) for i, pr in enumerate(staging.PERIODS[:3])])
    names = part.select(F.col("p_name").alias("market_hash_name")).distinct()
    existing = names.select(
        "market_hash_name", F.lit("EUR").alias("currency"), F.lit(0.0).alias("suggested_price"),
        F.lit(None).cast("string").alias("item_page"), F.lit(None).cast("string").alias("market_page"),
        *[F.lit(None).cast("double").alias(c) for c in ("min_price", "max_price", "mean_price", "median_price")],
        *[F.lit(None).cast("bigint").alias(c) for c in ("quantity", "created_at", "updated_at")],
        F.concat(F.lit("img/"), F.col("market_hash_name")).alias("image_url"))
    def load(df):
        return rawsrc.payloads_from_rows(df, [c for c in df.columns if c != "p_partkey"],
                                         ingest_ts=LOAD_TS, pos_col="p_partkey")

    return load(items), load(stats), existing


_CATALOG_LAST = """
WITH last AS (
  SELECT p.* FROM part p
  WHERE p.p_partkey = (SELECT MAX(q.p_partkey) FROM part q WHERE q.p_name = p.p_name)
)
"""


@register("load_catalog_items", _CATALOG_LAST + """
SELECT p_name AS market_hash_name, 'EUR' AS currency, p_retailprice AS suggested_price, p_type AS item_page,
       CAST(NULL AS VARCHAR) AS market_page, CAST(NULL AS DOUBLE) AS min_price, CAST(NULL AS DOUBLE) AS max_price,
       CAST(NULL AS DOUBLE) AS mean_price, CAST(NULL AS DOUBLE) AS median_price, CAST(p_size AS BIGINT) AS quantity,
       CAST(NULL AS BIGINT) AS created_at, CAST(NULL AS BIGINT) AS updated_at, 'img/' || p_name AS image_url
FROM last
""")
def q_load_catalog_items(spark: SparkSession, sf: str) -> DataFrame:
    items, _, existing = _catalog_loads(spark, sf)
    new_catalog, _ = catalog.load_catalog(items, existing)
    return new_catalog


@register("load_catalog_stats", _CATALOG_LAST + "\nUNION ALL\n".join(
    f"""SELECT p_name AS market_hash_name, 'EUR' AS currency, p_brand AS item_page, CAST(NULL AS VARCHAR) AS market_page,
       '{pr}' AS period, {f"p_retailprice AS min, p_retailprice * {i + 2} AS max" if i < 3 else
                          "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max"},
       CAST(NULL AS DOUBLE) AS avg, CAST(NULL AS DOUBLE) AS median,
       {"CAST(p_size AS BIGINT)" if i < 3 else "CAST(NULL AS BIGINT)"} AS volume
FROM last""" for i, pr in enumerate(staging.PERIODS)))
def q_load_catalog_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of the same load: last row per name wins, unpivoted to four
    periods (the missing 90-day block gives a row of NULLs)."""
    items, stats, existing = _catalog_loads(spark, sf)
    _, agg = catalog.load_catalog(items, existing, stats, None, extracted_at=LOAD_TS)
    return agg.drop("extracted_at")
