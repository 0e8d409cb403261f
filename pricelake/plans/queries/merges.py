"""Merge family M1–M5 on per-(user, day) event statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import merge
from pricelake.plans import fixture_views as fv
from pricelake.plans.queries.base import register

# Target: per (user, day) before 2024-01-20, max value and first event id.
# Source: per (user, day) from 2024-01-15, min value and last event id.
# Days 15-19 conflict; earlier days are target-only, later days source-only.


_MERGE_KEYS = ["user_id", "day"]

_MERGE_INPUTS_SQL = """
WITH t AS (
  SELECT user_id, CAST(ts AS DATE) AS day, MAX(value) AS value, MIN(event_id) AS event_id
  FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY user_id, CAST(ts AS DATE)
), s AS (
  SELECT user_id, CAST(ts AS DATE) AS day, MIN(value) AS value, MAX(event_id) AS event_id
  FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY user_id, CAST(ts AS DATE)
)
"""


def _merge_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    ev = fv.Tables(spark, sf).events
    day = F.to_date("ts").alias("day")
    cut_t = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    cut_s = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    target = ev.filter(F.col("ts") < cut_t).groupBy("user_id", day).agg(
        F.max("value").alias("value"), F.min("event_id").alias("event_id"))
    source = ev.filter(F.col("ts") >= cut_s).groupBy("user_id", day).agg(
        F.min("value").alias("value"), F.max("event_id").alias("event_id"))
    return target, source


@register("upsert", _MERGE_INPUTS_SQL + """
SELECT COALESCE(s.user_id, t.user_id) AS user_id, COALESCE(s.day, t.day) AS day,
       CASE WHEN s.user_id IS NOT NULL THEN s.value ELSE t.value END AS value,
       CASE WHEN s.user_id IS NOT NULL THEN s.event_id ELSE t.event_id END AS event_id
FROM t FULL OUTER JOIN s ON t.user_id = s.user_id AND t.day = s.day
""")
def q_upsert(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _merge_inputs(spark, sf)
    return merge.upsert(target, source, _MERGE_KEYS)


@register("insert_ignore", _MERGE_INPUTS_SQL + """
SELECT COALESCE(t.user_id, s.user_id) AS user_id, COALESCE(t.day, s.day) AS day,
       CASE WHEN t.user_id IS NOT NULL THEN t.value ELSE s.value END AS value,
       CASE WHEN t.user_id IS NOT NULL THEN t.event_id ELSE s.event_id END AS event_id
FROM t FULL OUTER JOIN s ON t.user_id = s.user_id AND t.day = s.day
""")
def q_insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _merge_inputs(spark, sf)
    return merge.insert_ignore(target, source, _MERGE_KEYS)


@register("update_from", _MERGE_INPUTS_SQL + """
SELECT t.user_id, t.day,
       CASE WHEN s.user_id IS NOT NULL THEN s.value ELSE t.value END AS value,
       t.event_id
FROM t LEFT JOIN s ON t.user_id = s.user_id AND t.day = s.day
""")
def q_update_from(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _merge_inputs(spark, sf)
    return merge.update_from(target, source, _MERGE_KEYS, ["value"])


@register("upsert_preserving", _MERGE_INPUTS_SQL + """
SELECT s.user_id, s.day, s.value,
       CASE WHEN t.user_id IS NOT NULL THEN t.event_id ELSE s.event_id END AS event_id
FROM s LEFT JOIN t ON t.user_id = s.user_id AND t.day = s.day
UNION ALL
SELECT t.user_id, t.day, t.value, t.event_id
FROM t WHERE (t.user_id, t.day) NOT IN (SELECT (user_id, day) FROM s)
""")
def q_upsert_preserving(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _merge_inputs(spark, sf)
    return merge.upsert(target, source, _MERGE_KEYS, update_cols=["value"])


@register("insert_new", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
""")
def q_insert_new(spark: SparkSession, sf: str) -> DataFrame:
    """Orders not yet present among the orders with a returned line."""
    t = fv.Tables(spark, sf)
    returned = t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    source = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return merge.new_rows(returned, source, ["o_orderkey"])




@register("insert_new_table", _MERGE_INPUTS_SQL + """
SELECT * FROM t
UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = s.user_id AND t.day = s.day)
""")
def q_insert_new_table(spark: SparkSession, sf: str) -> DataFrame:
    """The whole new content: the target and the source rows whose key it lacks."""
    target, source = _merge_inputs(spark, sf)
    return merge.insert_new(target, source, _MERGE_KEYS)


@register("replace_table", _MERGE_INPUTS_SQL + "SELECT user_id, day, value, event_id FROM s")
def q_replace_table(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _merge_inputs(spark, sf)
    return merge.replace(target, source.select("event_id", "value", "day", "user_id"))


@register("append_rows", _MERGE_INPUTS_SQL + "SELECT * FROM t UNION ALL SELECT * FROM s")
def q_append_rows(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _merge_inputs(spark, sf)
    return merge.append(target, source.select("event_id", "value", "day", "user_id"))
