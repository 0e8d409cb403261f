"""The raw zone's parsed payloads, strict documents, page tokens, and the marts' shared history on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import marts, staging
from pricelake.plans import fixture_views as fv
from pricelake.plans.queries.base import ORACLES, _dbl, register, uuid5_sql
from pricelake.plans.queries.day_loads import _book_a_raw, _iso_utc, _user_name
from pricelake.plans.queries.marts import FIXTURE_GROUP_RULES, _line_tie
from pricelake.plans.queries.staging import _history_payload_rows
from pricelake.sources import pages as pg
from pricelake.sources import raw as rawsrc


def _parsed(raw: DataFrame) -> DataFrame:
    """What a raw zone keeps for staging: the parsed payload without its text."""
    return rawsrc.with_body(raw).drop("payload")


@register("stage_history_variant", ORACLES["stage_history"])
def q_stage_history_variant(spark: SparkSession, sf: str) -> DataFrame:
    """T6 from VARIANT: the fields are taken from the parsed payload."""
    src = _history_payload_rows(fv.Tables(spark, sf).lineitem)
    raw = rawsrc.payloads_from_rows(src, [c for c in src.columns if c != "l_shipdate"], ts_col="l_shipdate")
    staged = staging.stage_history(_parsed(raw)).drop("src_ts", "src_pos", "src_hash")
    dec = [c for c in staged.columns if c.endswith(("_min", "_max", "_avg", "_median"))]
    return _dbl(staged, *dec).withColumn("date_extracted", F.col("date_extracted").cast("timestamp_ntz"))


@register("stage_book_a_variant", f"""
SELECT {uuid5_sql("'user ' || CAST(user_id AS VARCHAR)")} AS id_name, ts AS date_extracted,
       CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS suggested_price, CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS min_price,
       CASE WHEN event_type = 'view' THEN NULL ELSE CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) END AS max_price,
       CAST(NULL AS DOUBLE) AS mean_price, CAST(NULL AS DOUBLE) AS median_price
FROM events WHERE event_type IN ('view', 'click')
""")
def q_stage_book_a_variant(spark: SparkSession, sf: str) -> DataFrame:
    """T5 from VARIANT."""
    book = staging.dedup_staged(staging.stage_book_a(_parsed(_book_a_raw(fv.Tables(spark, sf).events, 1.0))))
    return _dbl(book, *staging.BOOK_A_PRICES).withColumn("date_extracted", F.col("date_extracted").cast("timestamp_ntz"))


@register("stage_book_b_variant", ORACLES.get("stage_book_b"))
def q_stage_book_b_variant(spark: SparkSession, sf: str) -> DataFrame:
    """T7 from VARIANT."""
    ev = fv.Tables(spark, sf).events.filter(F.col("event_type") == "purchase")
    rows = ev.select(_user_name().alias("market_hash_name"), _iso_utc("ts").alias("created_at"),
                     F.col("value").cast("string").alias("price"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("load_ts"))
    raw = rawsrc.payloads_from_rows(rows, ["market_hash_name", "created_at", "price"], ts_col="load_ts")
    book = staging.dedup_staged(staging.stage_book_b(_parsed(raw)))
    return _dbl(book, "price").withColumn("date_extracted", F.col("date_extracted").cast("timestamp_ntz"))


# Documents of ten kinds: whole roots with white space around them, and nine ways to be malformed or empty.
_TEXTS = (
    ('\n{"k":@}', "chr(10) || '{\"k\":' || o_orderkey || '}'"),
    ('\t[{"k":@}, {"k":0}]\r\n', "chr(9) || '[{\"k\":' || o_orderkey || '}, {\"k\":0}]' || chr(13) || chr(10)"),
    ('[{"k":@}]\n[{"k":1}]', "'[{\"k\":' || o_orderkey || '}]' || chr(10) || '[{\"k\":1}]'"),
    ('[{"k":@}] garbage', "'[{\"k\":' || o_orderkey || '}] garbage'"),
    ('"text @"', "'\"text ' || o_orderkey || '\"'"),
    ('﻿{"k":@}', "chr(65279) || '{\"k\":' || o_orderkey || '}'"),
    ('{"k":@}],[{"k":1}', "'{\"k\":' || o_orderkey || '}],[{\"k\":1}'"),
    (" \n", "' ' || chr(10)"),
    ("{'k':@}", "'{''k'':' || o_orderkey || '}'"),
    ("[]", "'[]'"),
)
_STRICT_SQL = "WITH d AS (SELECT o_orderkey, CASE o_orderkey % 10 " + " ".join(
    f"WHEN {i} THEN {sql}" for i, (_, sql) in enumerate(_TEXTS)) + " END AS value FROM orders) "


def _strict_documents(spark: SparkSession, sf: str) -> DataFrame:
    o = fv.Tables(spark, sf).orders
    k = F.col("o_orderkey").cast("string")
    text = None
    for i, (form, _) in enumerate(_TEXTS):
        before, _, after = form.partition("@")
        value = F.concat(F.lit(before), k, F.lit(after)) if "@" in form else F.lit(form)
        here = F.col("o_orderkey") % 10 == i
        text = F.when(here, value) if text is None else text.when(here, value)
    return o.select("o_orderkey", text.alias("value"))


@register("strict_documents", _STRICT_SQL + """
SELECT o_orderkey, CAST(0 AS BIGINT) AS load_pos, '{"k":' || o_orderkey || '}' AS payload FROM d WHERE o_orderkey % 10 IN (0, 1)
UNION ALL SELECT o_orderkey, CAST(1 AS BIGINT), '{"k":0}' FROM d WHERE o_orderkey % 10 = 1
""")
def q_strict_documents(spark: SparkSession, sf: str) -> DataFrame:
    """S1: white space around a root value is no fault; anything else around it is."""
    return rawsrc.documents_to_payloads(_strict_documents(spark, sf), lenient=True, keep=("o_orderkey",)).select(
        "o_orderkey", "load_pos", "payload")


@register("strict_documents_rejected", _STRICT_SQL + "SELECT o_orderkey, value FROM d WHERE o_orderkey % 10 BETWEEN 2 AND 8")
def q_strict_documents_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """S1: every document that gives no payload, except empty arrays, is set aside."""
    return rawsrc.rejected_documents(_strict_documents(spark, sf), keep=("o_orderkey",)).select("o_orderkey", "value")


@register("page_images_hidden", """
SELECT page_id, url || '?a=1&b=' || CAST(page_id AS VARCHAR) AS image_url
FROM pages WHERE page_id % 7 <> 4 AND url IS NOT NULL
""")
def q_page_images_hidden(spark: SparkSession, sf: str) -> DataFrame:
    """S8: image tags in comments, scripts, styles, attribute values and CDATA sections come first and don't count."""
    p = fv.Tables(spark, sf).pages.filter("url IS NOT NULL")
    image = F.replace(F.concat("url", F.lit("?a=1&b="), F.col("page_id").cast("string")), F.lit("&"), F.lit("&amp;"))
    real = F.concat(F.lit('<meta property="og:image" content="'), image, F.lit('">'))
    old = '<meta property="og:image" content="old">'
    hidden = (f"<!-- {old} -->", f"<script type=\"a>b\">var a = '{old}';</script>", f"<STYLE>/* {old} */</style >",
              f"<div data-x='{old}'></div>", None, f"<![CDATA[ {old} ]]>", f"<!-- > {old} --!><p title=\"{old.replace(chr(34), chr(39))}\">")
    html = None
    for i, text in enumerate(hidden):
        value = F.concat(F.lit("<!-- "), real) if text is None else F.concat(F.lit(f"<!DOCTYPE html><html>{text}"), real)
        here = F.col("page_id") % len(hidden) == i
        html = F.when(here, value) if html is None else html.when(here, value)
    return p.select("page_id", pg.meta_content(html, "og:image").alias("image_url")).filter("image_url IS NOT NULL")


_LATEST = """
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {key}, day ORDER BY l_shipdate DESC, l_partkey, l_orderkey, l_linenumber,
                               l_extendedprice, l_quantity) AS rn FROM h {join}
"""


@register("history_marts", f"""
WITH h AS (
  SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_tax, l_discount,
         p_name, CASE WHEN p_name ILIKE '%WIDGET%' THEN 'Widget' WHEN p_name ILIKE '%gear%' THEN 'Gear'
                      WHEN p_name ILIKE '%rod%' OR p_name ILIKE '%bolt%' THEN 'Fastener' END AS grp
  FROM lineitem JOIN part ON p_partkey = l_partkey
), n AS ({_LATEST.format(key='p_name', join='')}), i AS ({_LATEST.format(key='l_partkey', join='')})
SELECT 'sales_history' AS mart, p_name AS key, day, CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DOUBLE) AS a,
       CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS b, CAST(NULL AS DOUBLE) AS c FROM n WHERE rn = 1
UNION ALL
SELECT 'group_analytics', grp, day, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / COUNT(l_extendedprice),
       CAST(SUM(CAST(l_quantity AS INTEGER)) AS DOUBLE), NULL FROM i WHERE rn = 1 AND grp IS NOT NULL GROUP BY grp, day
UNION ALL
SELECT 'volatility', p_name, day, CAST(CAST(l_extendedprice AS DECIMAL(18,4)) - CAST(l_tax AS DECIMAL(18,4)) AS DOUBLE),
       CASE WHEN CAST(l_discount AS DECIMAL(18,4)) > 0
            THEN CAST(CAST(l_extendedprice AS DECIMAL(18,4)) - CAST(l_tax AS DECIMAL(18,4)) AS DOUBLE) / CAST(CAST(l_discount AS DECIMAL(18,4)) AS DOUBLE)
            ELSE 0 END, CAST(CAST(l_linenumber AS INTEGER) AS DOUBLE) FROM n WHERE rn = 1
""")
def q_history_marts(spark: SparkSession, sf: str) -> DataFrame:
    """A1, A2 and A5 from one stored last snapshot per product and day."""
    t = fv.Tables(spark, sf)
    line = t.lineitem
    history = line.select(
        F.col("l_partkey").alias("id_name"), F.col("l_shipdate").alias("date_extracted"),
        fv.price("l_extendedprice").alias("last_24_hours_avg"), F.col("l_quantity").cast("int").alias("last_24_hours_volume"),
        fv.price("l_tax").alias("last_7_days_min"), fv.price("l_extendedprice").alias("last_7_days_max"),
        fv.price("l_discount").alias("last_7_days_avg"), F.col("l_linenumber").cast("int").alias("last_7_days_volume"),
        *fv.LINE_TIE_BREAKS)
    rows = marts.history_marts(history, fv.product_from_parts(t.part), FIXTURE_GROUP_RULES, _line_tie())
    columns = {"sales_history": ("item_name", "avg_price_24h", "volume_24h", None),
               "group_analytics": ("group_name", "avg_price", "total_volume", None),
               "volatility": ("item_name", "spread_7d", "volatility_index", "volume_7d")}
    parts = [rows[m].select(F.lit(m).alias("mart"), F.col(key).alias("key"), F.col("date_extracted").alias("day"),
                            *[(F.lit(None) if c is None else F.col(c)).cast("double").alias(n) for n, c in zip("abc", values)])
             for m, (key, *values) in columns.items()]
    return reduce(DataFrame.unionByName, parts)


def _odd_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Views and clicks as book A, staged leniently: some prices are no numbers."""
    ev = fv.Tables(spark, sf).events.filter(F.col("event_type").isin(*fv.BOOK_A_TYPES))
    value = F.col("value").cast("string")
    rows = ev.select(
        _user_name().alias("market_hash_name"), F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("about "), F.col("event_id").cast("string")))
        .otherwise(value).alias("suggested_price"), F.when(F.col("event_id") % 5 == 0, "").otherwise(value).alias("min_price"),
        F.when(F.col("event_id") % 3 == 0, "1,5").otherwise(value).alias("max_price"), "ts", "event_id")
    raw = rawsrc.payloads_from_rows(rows, ["market_hash_name", "suggested_price", "min_price", "max_price"], ts_col="ts", pos_col="event_id")
    return staging.stage_book_a(_parsed(raw), lenient=True)


@register("lenient_book_a", """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) END AS suggested_price,
       CASE WHEN event_id % 5 <> 0 THEN CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) END AS min_price,
       CASE WHEN event_id % 3 <> 0 THEN CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) END AS max_price,
       CAST((event_id % 7 = 0)::INT + (event_id % 3 = 0)::INT AS BIGINT) AS rejects
FROM events WHERE event_type IN ('view', 'click')
""")
def q_lenient_book_a(spark: SparkSession, sf: str) -> DataFrame:
    """T5, lenient: unreadable numbers are NULL and counted; blank ones are NULL."""
    staged = _odd_numbers(spark, sf)
    return _dbl(staged, "suggested_price", "min_price", "max_price").select(
        F.col("src_pos.row").alias("event_id"), "suggested_price", "min_price", "max_price", F.size(staging.REJECTS).cast("bigint").alias("rejects"))


@register("lenient_book_a_rejects", """
SELECT event_id, 'suggested_price' AS field, 'about ' || CAST(event_id AS VARCHAR) AS text
FROM events WHERE event_type IN ('view', 'click') AND event_id % 7 = 0
UNION ALL SELECT event_id, 'max_price', '1,5' FROM events WHERE event_type IN ('view', 'click') AND event_id % 3 = 0
""")
def q_lenient_book_a_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Each text that a lenient load could not type, with its field."""
    return staging.rejected_fields(_odd_numbers(spark, sf)).select(F.col("src_pos.row").alias("event_id"), "field", "text")
