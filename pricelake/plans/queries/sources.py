"""Source operators on the driver tables: trade arrays, page HTML, request
URLs, top-N per listed id and request filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.plans import fixture_views as fv
from pricelake.plans.queries.base import register
from pricelake.sources import pages as pg
from pricelake.sources import raw as rawsrc
from pricelake.sources import trades


@register("explode_trades", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS name, 730 AS app_id,
       strftime(l_shipdate, '%b %d %Y %H') || CASE l_linenumber % 3 WHEN 0 THEN ': +0' WHEN 1 THEN ': +3' ELSE ': -5' END AS ts_text,
       l_shipdate - to_hours(CASE l_linenumber % 3 WHEN 0 THEN 0 WHEN 1 THEN 3 ELSE -5 END) AS ts,
       l_extendedprice AS price, CAST(l_quantity AS BIGINT) AS amount,
       'steam_pricehistory' AS source, '5' AS currency, CAST(NULL AS VARCHAR) AS raw
FROM lineitem
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), 730,
       strftime(l_shipdate, '%b %d %Y %H') || CASE l_linenumber % 3 WHEN 0 THEN ': +0' WHEN 1 THEN ': +3' ELSE ': -5' END,
       l_shipdate - to_hours(CASE l_linenumber % 3 WHEN 0 THEN 0 WHEN 1 THEN 3 ELSE -5 END),
       l_extendedprice * (1 - l_discount), CAST(l_quantity AS BIGINT),
       'steam_pricehistory', '5', CAST(NULL AS VARCHAR)
FROM lineitem
""")
def q_explode_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Each line as one trade-history payload holding two trades (list and
    discounted price) at one of three offsets, exploded back to rows. No grouping: a payload is
    built from its own row, so no key gathers rows anywhere."""
    li = fv.Tables(spark, sf).lineitem
    third = F.col("l_linenumber") % 3
    suffix = F.when(third == 0, ": +0").when(third == 1, ": +3").otherwise(": -5")
    when = F.concat(F.date_format("l_shipdate", "MMM dd yyyy HH"), suffix)
    qty = F.col("l_quantity").cast("bigint").cast("string")
    prices = F.array(
        F.array(when, F.col("l_extendedprice").cast("string"), qty),
        F.array(when, (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("string"), qty),
    )
    docs = li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("market_hash_name"),
        F.to_json(F.struct(prices.alias("prices"))).alias("payload"))
    out = trades.explode_trades(docs)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("page_meta", """
SELECT page_id,
  NULLIF(regexp_extract(html, '<html[^>]*\\slang="([^"]*)"', 1), '') AS lang,
  NULLIF(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
  NULLIF(regexp_extract(html, '<meta[^>]*\\scharset="([^"]*)"', 1), '') AS charset,
  CAST(NULL AS VARCHAR) AS og_image
FROM pages
""")
def q_page_meta(spark: SparkSession, sf: str) -> DataFrame:
    p = fv.Tables(spark, sf).pages
    return p.select("page_id", pg.html_lang("html").alias("lang"), pg.html_title("html").alias("title"),
                    pg.html_charset("html").alias("charset"), pg.meta_content("html", "og:image").alias("og_image"))


@register("url_names", """
SELECT page_id, trim(n) AS name FROM (
  SELECT page_id, unnest(string_split(url_decode(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1)), ',')) AS n
  FROM pages WHERE regexp_extract(url, '[?&]utm_source=([^&#]*)', 1) <> ''
) WHERE trim(n) <> ''
""")
def q_url_names(spark: SparkSession, sf: str) -> DataFrame:
    return pg.names_from_url(fv.Tables(spark, sf).pages, "url", "utm_source", keep=("page_id",))


@register("cheapest_lines", """
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity FROM (
  SELECT l.*, ROW_NUMBER() OVER (PARTITION BY l_partkey
           ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_quantity) AS rn
  FROM lineitem l WHERE l_partkey IN (SELECT p_partkey FROM part)
) WHERE rn <= 5
""")
def q_cheapest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 cheapest lines of every listed part (the id list is the part table)."""
    from pricelake.operators.latest import top_n_per_key

    t = fv.Tables(spark, sf)
    order = [F.col(c) for c in ("l_extendedprice", "l_orderkey", "l_linenumber", "l_quantity")]
    top = top_n_per_key(t.lineitem, "l_partkey", order, 5, ids=t.part, id_col="p_partkey")
    return top.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")




@register("cheapest_listings", """
SELECT id, price, sticker_counter, created_at, name AS market_hash_name, skin_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY skin_id ORDER BY price, id) AS rn FROM (
    SELECT l_orderkey * 10 + l_linenumber AS id, l_extendedprice AS price, l_linenumber AS sticker_counter,
           l_returnflag AS created_at, l_linestatus AS name, l_partkey AS skin_id FROM lineitem)
  WHERE skin_id IN (SELECT p_partkey FROM part WHERE p_size > 10)
) WHERE rn <= 3
""")
def q_cheapest_listings(spark: SparkSession, sf: str) -> DataFrame:
    """The 3 cheapest lines, as listings, of every larger part."""
    from pricelake.operators.listings import cheapest_listings

    t = fv.Tables(spark, sf)
    listings = t.lineitem.selectExpr(
        "l_orderkey * 10 + l_linenumber AS id", "l_extendedprice AS price", "l_linenumber AS sticker_counter",
        "l_returnflag AS created_at", "l_linestatus AS name", "l_partkey AS skin_id")
    return cheapest_listings(listings, t.part.filter("p_size > 10").selectExpr("p_partkey AS id"), n=3)


@register("request_filter", """
SELECT p_partkey, p_name AS market_hash_name, p_size FROM part
WHERE p_size > 25 AND p_name IN (SELECT p_name FROM part WHERE p_type = 'ECONOMY')
""")
def q_request_filter(spark: SparkSession, sf: str) -> DataFrame:
    """S11: the tradable flag as a row predicate and a name list (the names
    of economy parts) as a semi join."""
    from pricelake.operators.filters import request_filter

    part = fv.Tables(spark, sf).part
    items = part.select("p_partkey", F.col("p_name").alias("market_hash_name"), "p_size",
                        (F.col("p_size") > 25).alias("tradable"))
    names = part.filter(F.col("p_type") == "ECONOMY").select(F.col("p_name").alias("name"))
    return request_filter(items, "tradable", names).drop("tradable")


@register("page_images", """
SELECT page_id, url || '?a=1&b=' || CAST(page_id AS VARCHAR) AS image_url
FROM pages WHERE page_id % 5 <> 4 AND url IS NOT NULL
""")
def q_page_images(spark: SparkSession, sf: str) -> DataFrame:
    """The image tag in every spelling: both attribute orders, both quotes and none, encoded ampersands,
    a second tag that doesn't count, and none at all."""
    p = fv.Tables(spark, sf).pages.filter("url IS NOT NULL")
    image = F.replace(F.concat("url", F.lit("?a=1&b="), F.col("page_id").cast("string")), F.lit("&"), F.lit("&amp;"))
    form = F.col("page_id") % 5
    second = F.lit("<meta property=\"og:image\" content=\"late\">")
    tag = (F.when(form == 0, F.concat(F.lit("<meta property=\"og:image\" content=\""), image, F.lit("\">"), second))
           .when(form == 1, F.concat(F.lit("<META content='"), image, F.lit("' property='og:image' />"), second))
           .when(form == 2, F.concat(F.lit("<meta property=og:image content="), image, F.lit(" >")))
           .when(form == 3, F.concat(F.lit("<meta name='x' content='y'><meta content=\""), image, F.lit("\" property='og:image'>")))
           .otherwise("<meta property=\"og:title\" content=\"x\">"))
    html = F.concat(F.lit("<html><head>"), tag, F.lit("</head></html>"))
    return p.select("page_id", pg.meta_content(html, "og:image").alias("image_url")).filter("image_url IS NOT NULL")


_DOCUMENTS_SQL = """
WITH d AS (
  SELECT o_orderkey, CASE o_orderkey % 4
    WHEN 0 THEN '{"k":' || o_orderkey || ',"s":"' || o_orderstatus || '"}'
    WHEN 1 THEN '[{"k":' || o_orderkey || '},{"k":' || (o_orderkey + 1) || '}]'
    WHEN 2 THEN '[]' ELSE '{"k":' || o_orderkey || ',' END AS value
  FROM orders
)
"""


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """A text document per order: an object, an array, an empty array or broken JSON."""
    o = fv.Tables(spark, sf).orders
    k = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 4
    text = (F.when(kind == 0, F.concat(F.lit('{"k":'), k, F.lit(',"s":"'), "o_orderstatus", F.lit('"}')))
            .when(kind == 1, F.concat(F.lit('[{"k":'), k, F.lit('},{"k":'), (F.col("o_orderkey") + 1).cast("string"), F.lit("}]")))
            .when(kind == 2, F.lit("[]")).otherwise(F.concat(F.lit('{"k":'), k, F.lit(","))))
    return o.select("o_orderkey", text.alias("value"))


@register("load_documents", _DOCUMENTS_SQL + """
SELECT o_orderkey, CAST(0 AS BIGINT) AS load_pos, value AS payload FROM d WHERE o_orderkey % 4 = 0
UNION ALL SELECT o_orderkey, CAST(0 AS BIGINT), '{"k":' || o_orderkey || '}' FROM d WHERE o_orderkey % 4 = 1
UNION ALL SELECT o_orderkey, CAST(1 AS BIGINT), '{"k":' || (o_orderkey + 1) || '}' FROM d WHERE o_orderkey % 4 = 1
""")
def q_load_documents(spark: SparkSession, sf: str) -> DataFrame:
    return rawsrc.documents_to_payloads(_documents(spark, sf), lenient=True, keep=("o_orderkey",)).select(
        "o_orderkey", "load_pos", "payload")


@register("rejected_documents", _DOCUMENTS_SQL + "SELECT o_orderkey, value FROM d WHERE o_orderkey % 4 = 3")
def q_rejected_documents(spark: SparkSession, sf: str) -> DataFrame:
    return rawsrc.rejected_documents(_documents(spark, sf), keep=("o_orderkey",)).select("o_orderkey", "value")
