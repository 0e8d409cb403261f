"""Keys, JSON staging, catalog build, period unpivot and keep-latest on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.json_fields import json_int, json_text
from pricelake.functions.keys import uuid5
from pricelake.operators import catalog, staging
from pricelake.plans import fixture_views as fv
from pricelake.plans.queries.base import _dbl, register, uuid5_sql, AS_OF, LOAD_TS
from pricelake.sources import raw as rawsrc


@register("product_keys", f"""
SELECT name, {uuid5_sql('name')} AS id_name FROM (SELECT DISTINCT p_name AS name FROM part)
""")
def q_product_keys(spark: SparkSession, sf: str) -> DataFrame:
    names = fv.Tables(spark, sf).part.select(F.col("p_name").alias("name")).distinct()
    return names.select("name", uuid5("name").alias("id_name"))


@register("json_field", """
SELECT event_id, CAST(NULLIF(json_extract_string(props, '$.k'), '') AS INTEGER) AS k,
       CAST(NULLIF(json_extract_string(props, '$.missing'), '') AS INTEGER) AS missing
FROM events
""")
def q_json_field(spark: SparkSession, sf: str) -> DataFrame:
    ev = fv.Tables(spark, sf).events
    return ev.select("event_id", json_int(json_text("props", "$.k")).alias("k"),
                     json_int(json_text("props", "$.missing")).alias("missing"))


def _history_payload_rows(lineitem: DataFrame) -> DataFrame:
    """Lines as history payloads: 24 h stats from the line's numbers, the
    7-day block permuted, the 30-day block missing on returned lines, and the
    90-day minimum as text ('' on open lines)."""
    li = lineitem
    block = lambda mn, mx, av, md, vol: F.struct(
        F.col(mn).alias("min"), F.col(mx).alias("max"), F.col(av).alias("avg"),
        F.col(md).alias("median"), F.col(vol).alias("volume"))
    return li.select(
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("market_hash_name"),
        block("l_discount", "l_tax", "l_extendedprice", "l_quantity", "l_linenumber").alias("last_24_hours"),
        block("l_tax", "l_extendedprice", "l_quantity", "l_discount", "l_linenumber").alias("last_7_days"),
        F.when(F.col("l_returnflag") != "R",
               block("l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_linenumber")).alias("last_30_days"),
        F.struct(
            F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(F.col("l_discount").cast("string")).alias("min"),
            F.col("l_extendedprice").alias("max"), F.col("l_tax").alias("avg"),
            F.col("l_quantity").alias("median"), F.col("l_linenumber").alias("volume"),
        ).alias("last_90_days"),
        "l_shipdate",
    )


def _d(col: str) -> str:
    return f"CAST(CAST({col} AS DECIMAL(18,4)) AS DOUBLE)"


@register("stage_history", f"""
SELECT {uuid5_sql("'part ' || CAST(l_partkey AS VARCHAR)")} AS id_name,
  {_d('l_discount')} AS last_24_hours_min, {_d('l_tax')} AS last_24_hours_max,
  {_d('l_extendedprice')} AS last_24_hours_avg, {_d('l_quantity')} AS last_24_hours_median,
  CAST(l_linenumber AS INTEGER) AS last_24_hours_volume,
  {_d('l_tax')} AS last_7_days_min, {_d('l_extendedprice')} AS last_7_days_max,
  {_d('l_quantity')} AS last_7_days_avg, {_d('l_discount')} AS last_7_days_median,
  CAST(l_linenumber AS INTEGER) AS last_7_days_volume,
  CASE WHEN l_returnflag <> 'R' THEN {_d('l_quantity')} END AS last_30_days_min,
  CASE WHEN l_returnflag <> 'R' THEN {_d('l_discount')} END AS last_30_days_max,
  CASE WHEN l_returnflag <> 'R' THEN {_d('l_tax')} END AS last_30_days_avg,
  CASE WHEN l_returnflag <> 'R' THEN {_d('l_extendedprice')} END AS last_30_days_median,
  CASE WHEN l_returnflag <> 'R' THEN CAST(l_linenumber AS INTEGER) END AS last_30_days_volume,
  CASE WHEN l_linestatus <> 'O' THEN {_d('l_discount')} END AS last_90_days_min,
  {_d('l_extendedprice')} AS last_90_days_max, {_d('l_tax')} AS last_90_days_avg,
  {_d('l_quantity')} AS last_90_days_median, CAST(l_linenumber AS INTEGER) AS last_90_days_volume,
  l_shipdate AS date_extracted
FROM lineitem
""")
def q_stage_history(spark: SparkSession, sf: str) -> DataFrame:
    src = _history_payload_rows(fv.Tables(spark, sf).lineitem)
    raw = rawsrc.payloads_from_rows(src, [c for c in src.columns if c != "l_shipdate"], ts_col="l_shipdate")
    staged = staging.stage_history(raw).drop("src_ts", "src_pos", "src_hash")
    dec = [c for c in staged.columns if c.endswith(("_min", "_max", "_avg", "_median"))]
    return _dbl(staged, *dec).withColumn("date_extracted", F.col("date_extracted").cast("timestamp_ntz"))




@register("build_product", f"""
WITH u AS (
  SELECT p_name AS name, p_type AS item_page, p_brand AS market_page FROM part
  UNION ALL SELECT n_name, NULL, '/n/' || CAST(n_regionkey AS VARCHAR) FROM nation
  UNION ALL SELECT r_name, NULL, NULL FROM region
), r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY name ORDER BY item_page NULLS LAST, market_page NULLS LAST) AS rn
  FROM (SELECT DISTINCT * FROM u WHERE name IS NOT NULL AND name <> '')
)
SELECT {uuid5_sql('name')} AS id_name, name, item_page, market_page FROM r WHERE rn = 1
""")
def q_build_product(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog from three raw loads of the same day: part names under the market
    name field, nation names under the plain name field, region names alone."""
    t = fv.Tables(spark, sf)
    parts = t.part.select(F.col("p_name").alias("market_hash_name"), F.col("p_brand").alias("name"),
                          F.col("p_type").alias("item_page"), F.col("p_brand").alias("market_page"))
    nations = t.nation.select(F.col("n_name").alias("name"),
                              F.concat(F.lit("/n/"), F.col("n_regionkey").cast("string")).alias("market_page"))
    regions = t.region.select(F.col("r_name").alias("market_hash_name"))
    raws = [rawsrc.payloads_from_rows(x, ingest_ts=LOAD_TS) for x in (parts, nations, regions)]
    return catalog.build_product(raws, None, as_of=AS_OF)


_PERIOD_STARTS = [("last_24_hours", "2024-01-30"), ("last_7_days", "2024-01-24"),
                  ("last_30_days", "2024-01-01"), ("last_90_days", "2023-11-02")]


def _user_period_stats(events: DataFrame) -> DataFrame:
    """Per user, wide statistics of the 4 periods ending 2024-01-30 (one pass)."""
    v = F.col("value").cast("decimal(18,4)")
    aggs = []
    for name, start in _PERIOD_STARTS:
        inside = F.col("ts") >= F.lit(f"{start} 00:00:00").cast("timestamp_ntz")
        x = F.when(inside, v)
        aggs += [
            F.min(x).alias(f"{name}_min"), F.max(x).alias(f"{name}_max"),
            F.try_divide(F.sum(x).cast("double"), F.count(x)).alias(f"{name}_avg"),
            F.lit(None).cast("double").alias(f"{name}_median"),
            F.count(x).cast("int").alias(f"{name}_volume"),
        ]
    return events.groupBy(F.col("user_id")).agg(*aggs)


@register("unpivot_periods", "\nUNION ALL\n".join(f"""
SELECT user_id, '{name}' AS period,
  CAST(MIN(CASE WHEN ts >= TIMESTAMP '{start}' THEN CAST(value AS DECIMAL(18,4)) END) AS DOUBLE) AS min,
  CAST(MAX(CASE WHEN ts >= TIMESTAMP '{start}' THEN CAST(value AS DECIMAL(18,4)) END) AS DOUBLE) AS max,
  CAST(SUM(CASE WHEN ts >= TIMESTAMP '{start}' THEN CAST(value AS DECIMAL(18,4)) END) AS DOUBLE)
    / NULLIF(COUNT(CASE WHEN ts >= TIMESTAMP '{start}' THEN value END), 0) AS avg,
  CAST(NULL AS DOUBLE) AS median,
  CAST(COUNT(CASE WHEN ts >= TIMESTAMP '{start}' THEN value END) AS INTEGER) AS volume
FROM events GROUP BY user_id""" for name, start in _PERIOD_STARTS))
def q_unpivot_periods(spark: SparkSession, sf: str) -> DataFrame:
    wide = _user_period_stats(fv.Tables(spark, sf).events)
    long = staging.unpivot_periods(wide, ["user_id"])
    return _dbl(long, "min", "max")


@register("latest_event_per_user_day", """
SELECT DISTINCT ON (user_id, CAST(ts AS DATE)) user_id, CAST(ts AS DATE) AS day, event_id, ts, event_type, value
FROM events ORDER BY user_id, CAST(ts AS DATE), ts DESC, event_id DESC
""")
def q_latest_event_per_user_day(spark: SparkSession, sf: str) -> DataFrame:
    """T8 on its own: the last event of every user and day."""
    from pricelake.operators.latest import latest_per_key

    ev = fv.Tables(spark, sf).events.withColumn("day", F.to_date("ts"))
    out = latest_per_key(ev, ["user_id", "day"], [F.col("ts").desc(), F.col("event_id").desc()])
    return out.select("user_id", "day", "event_id", "ts", "event_type", "value")
