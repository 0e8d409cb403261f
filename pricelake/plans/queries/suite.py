"""The whole ODS suite with every check firing, table summaries, and profiles kept by day, on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.keys import uuid5
from pricelake.operators import quality as qc
from pricelake.operators.staging import PERIODS
from pricelake.plans import fixture_views as fv
from pricelake.plans.queries.base import register, uuid5_sql

#: The suite's present: line dates lie on both sides of it, events behind it.
SUITE_NOW = "1997-06-01 00:00:00"

# Which of (discount, tax, price, quantity) gives a period its min, max, avg and median: each period breaks its order on other lines.
_BLOCKS = {
    "last_24_hours": ("l_discount", "l_tax", "l_extendedprice", "l_quantity"),
    "last_7_days": ("l_tax", "l_extendedprice", "l_quantity", "l_discount"),
    "last_30_days": ("l_discount", "l_quantity", "l_tax", "l_tax"),
    "last_90_days": ("l_tax", "l_discount", "l_discount", "l_tax"),
}


def _faulty_ods(t: fv.Tables):
    """Customers and part names as products, some without a key, with a wrong one or twice; views and clicks
    as book A, purchases as book B and lines as history, with every fault the suite looks for."""
    from pricelake.plans.ods import Ods

    kind = F.col("c_custkey") % 10
    # Keys are made once a name; the aggregate keeps their long expression out of whatever reads them.
    keyed = t.customer.groupBy("c_custkey", "c_name").agg(F.first(uuid5("c_name")).alias("key"))
    customers = keyed.select(F.when(kind == 1, F.lit(None)).when(kind == 2, F.concat(F.lit("bad-"), F.col("c_custkey").cast("string")))
                             .otherwise(F.col("key")).alias("id_name"), F.col("c_name").alias("name"), kind.alias("kind"))
    twice = customers.filter("kind = 3").withColumn("id_name", F.concat(F.lit("dup-"), "name"))
    parts = t.part.filter("p_size > 25").select(uuid5("p_name").alias("id_name"), F.col("p_name").alias("name")).distinct()
    product = customers.unionByName(twice).drop("kind").unionByName(parts).withColumns(
        {"item_page": F.lit(None).cast("string"), "market_page": F.lit(None).cast("string")})
    names = keyed.select(F.col("c_custkey").alias("user_id"), "key")
    events = t.events.join(names, "user_id", "left")
    fault = F.col("user_id") % 10
    key = F.when(fault == 5, F.lit(None)).otherwise(F.coalesce("key", F.lit("nobody")))
    v = F.col("value").cast("decimal(18,4)")
    seen = events.withColumn("n", F.explode(F.when(fault == 4, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).select(
        key.alias("id_name"), F.col("ts").cast("timestamp").alias("date_extracted"), "event_type", v.alias("v"))
    none = F.lit(None).cast("decimal(18,4)")
    book_a = seen.filter("event_type IN ('view', 'click')").select(
        "id_name", "date_extracted", F.col("v").alias("suggested_price"), F.col("v").alias("min_price"),
        F.when(F.col("event_type") == "view", F.col("v") / 2).otherwise(F.col("v")).cast("decimal(18,4)").alias("max_price"),
        none.alias("mean_price"), none.alias("median_price"))
    book_b = seen.filter("event_type = 'purchase'").select("id_name", "date_extracted", (F.col("v") - 100).alias("price"))
    stats = [F.col(c).cast("decimal(18,4)").alias(f"{p}_{s}") for p, block in _BLOCKS.items() for s, c in zip(("min", "max", "avg", "median"), block)]
    volumes = [F.when(F.col("l_linenumber") == i + 1, -1).otherwise(F.col("l_linenumber")).cast("int").alias(f"{p}_volume")
               for i, p in enumerate(PERIODS)]
    part_keys = t.part.groupBy(F.col("p_partkey").alias("l_partkey"), "p_name").agg(F.first(uuid5("p_name")).alias("key"))
    row = F.struct(F.col("key").alias("id_name"), *stats, *volumes, F.col("l_shipdate").cast("timestamp").alias("date_extracted"))
    # One line column is several statistics here: behind the generator they are columns of their own, as in a stored
    # table (the optimizer would else infer filters for every combination of equal columns).
    history = t.lineitem.join(part_keys, "l_partkey").select(F.explode(F.array(row)).alias("h")).select("h.*")
    return Ods(product=product, book_a=book_a, history=history, book_b=book_b)


def _order_sql(block: tuple[str, ...]) -> str:
    mn, mx, av, md = (f"CAST({c} AS DECIMAL(18,4))" for c in block)
    return f"({mx} < {mn} OR {md} < {mn} OR {mx} < {md} OR {av} < {mn} OR {mx} < {av})"


_FAULTY_SQL = f"""
WITH customers AS (
  SELECT CASE c_custkey % 10 WHEN 1 THEN NULL WHEN 2 THEN 'bad-' || c_custkey ELSE {uuid5_sql('c_name')} END AS id_name, c_name AS name, c_custkey % 10 AS kind
  FROM customer
), product AS (
  SELECT id_name, name FROM customers UNION ALL SELECT 'dup-' || name, name FROM customers WHERE kind = 3
  UNION ALL SELECT DISTINCT {uuid5_sql('p_name')}, p_name FROM part WHERE p_size > 25
), seen AS (
  SELECT CASE WHEN user_id % 10 = 5 THEN NULL ELSE coalesce({uuid5_sql('c_name')}, 'nobody') END AS id_name, ts, event_type,
         CAST(value AS DECIMAL(18,4)) AS v, unnest(CASE WHEN user_id % 10 = 4 THEN [1, 2] ELSE [1] END) AS n
  FROM events LEFT JOIN customer ON c_custkey = user_id
), a AS (SELECT * FROM seen WHERE event_type IN ('view', 'click')), b AS (SELECT * FROM seen WHERE event_type = 'purchase'),
h AS (SELECT {uuid5_sql('p_name')} AS id_name, l_shipdate AS ts, lineitem.* FROM lineitem JOIN part ON p_partkey = l_partkey),
now AS (SELECT TIMESTAMP '{SUITE_NOW}' + INTERVAL 5 MINUTE AS late)
"""

_BOOK_SQL = """
  UNION ALL SELECT '{t}.ahead_of_time', count(*) FROM {v}, now WHERE ts > late
  UNION ALL SELECT '{t}.twice', count(*) FROM (SELECT 1 FROM {v} GROUP BY id_name, ts HAVING count(*) > 1)
  UNION ALL SELECT '{t}.unknown_product', count(*) FROM {v} WHERE NOT EXISTS (SELECT 1 FROM product p WHERE p.id_name = {v}.id_name)
"""


@register("ods_full_report", _FAULTY_SQL + ", r AS (" + f"""
  SELECT 'product.key_null' AS "check", count(*) AS violations FROM product WHERE id_name IS NULL OR name IS NULL
  UNION ALL SELECT 'product.key_wrong', count(*) FROM product WHERE id_name IS DISTINCT FROM {uuid5_sql('name')}
  UNION ALL SELECT 'product.name_split', count(*) FROM (SELECT 1 FROM product GROUP BY name HAVING count(DISTINCT id_name) > 1)
  UNION ALL SELECT 'book_a.key_null', count(*) FROM a WHERE id_name IS NULL OR ts IS NULL
  UNION ALL SELECT 'book_a.price', count(*) FROM a WHERE v < 0 OR (event_type = 'view' AND v > CAST(v / 2 AS DECIMAL(18,4)))
  UNION ALL SELECT 'book_b.price', count(*) FROM b WHERE v < 100
  UNION ALL SELECT 'history.volume', count(*) FROM h WHERE l_linenumber <= {len(PERIODS)}
""" + "".join(f"  UNION ALL SELECT 'history.order.{p}', count(*) FROM h WHERE {_order_sql(b)}\n" for p, b in _BLOCKS.items())
    + "".join(_BOOK_SQL.format(t=t, v=v) for t, v in (("book_a", "a"), ("book_b", "b"), ("history", "h")))
    + """) SELECT "check", violations FROM r WHERE violations > 0""")
def q_ods_full_report(spark: SparkSession, sf: str) -> DataFrame:
    """Q25: every check of every table (history included) in one run; each of them finds something."""
    from pricelake.plans.ods_checks import ods_report

    return ods_report(_faulty_ods(fv.Tables(spark, sf)), SUITE_NOW).select("check", "violations")


def _bigints(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in df.columns if c.startswith(("null_", "rows_"))})


@register("ods_history_summary", """
SELECT count(*) AS rows_total, CAST(0 AS BIGINT) AS null_24h_avg, CAST(0 AS BIGINT) AS null_7d_avg,
       CAST(0 AS BIGINT) AS null_30d_avg, CAST(0 AS BIGINT) AS null_90d_avg
FROM lineitem JOIN part ON p_partkey = l_partkey
""")
def q_ods_history_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Q23 on the faulty ODS."""
    from pricelake.plans.ods_checks import ods_summaries

    return _bigints(ods_summaries(_faulty_ods(fv.Tables(spark, sf)))["history"])


@register("ods_book_b_summary", """
SELECT CAST(sum(CASE WHEN user_id % 10 = 4 THEN 2 ELSE 1 END) AS BIGINT) AS rows_total, CAST(0 AS BIGINT) AS null_price
FROM events WHERE event_type = 'purchase'
""")
def q_ods_book_b_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Q24 on the faulty ODS."""
    from pricelake.plans.ods_checks import ods_summaries

    return _bigints(ods_summaries(_faulty_ods(fv.Tables(spark, sf)))["book_b"])


_PROFILED = {"null_value": "odd_value", "null_type": "odd_type"}
_ODD_SQL = """
WITH e AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS odd_value,
                  CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS odd_type FROM events)
SELECT {day}count(*) AS rows_total, CAST(count(*) - count(odd_value) AS BIGINT) AS null_value,
       CAST(count(*) - count(odd_type) AS BIGINT) AS null_type FROM e {group}
"""


def _odd_events(spark: SparkSession, sf: str) -> DataFrame:
    return fv.Tables(spark, sf).events.select(
        F.to_date("ts").alias("day"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("odd_value"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("odd_type"))


@register("profile_by_day", _ODD_SQL.format(day="day, ", group="GROUP BY day"))
def q_profile_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Q21-Q24 as counts per day, which later runs add to."""
    return qc.daily_profile(_odd_events(spark, sf), _PROFILED, "day")


@register("profile_merged", _ODD_SQL.format(day="", group=""))
def q_profile_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The whole table's profile, added up from the days'."""
    return qc.merged_profile(qc.daily_profile(_odd_events(spark, sf), _PROFILED, "day"))
