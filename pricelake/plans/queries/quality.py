"""Quality checks Q1–Q25 and the freshness gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.keys import uuid5
from pricelake.operators import freshness as fresh
from pricelake.operators import quality as qc
from pricelake.operators.joins import join_dimension
from pricelake.plans import fixture_views as fv
from pricelake.plans.queries.base import register, uuid5_sql, AS_OF_TS

def _labelled_docs(t: fv.Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left")


@register("check_null_keys", """
SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE l.quality IS NULL OR l.toxic IS NULL
""")
def q_check_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    return qc.null_keys(_labelled_docs(fv.Tables(spark, sf)), ["quality", "toxic"], ["doc_id", "quality", "toxic"])


def _stored_part_keys(part: DataFrame) -> DataFrame:
    """Part catalog with seeded key faults: no key for the smallest sizes, and
    a key made from the upper-cased name for one brand (a normalisation bug)."""
    key = (F.when(F.col("p_size") < 3, F.lit(None).cast("string"))
           .when(F.col("p_brand") == "Brand#1", uuid5(F.upper("p_name")))
           .otherwise(uuid5("p_name")))
    return part.select("p_partkey", key.alias("id_name"), F.col("p_name").alias("name"))


@register("check_wrong_keys", f"""
WITH s AS (
  SELECT p_partkey, p_name AS name,
         CASE WHEN p_size < 3 THEN NULL
              WHEN p_brand = 'Brand#1' THEN {uuid5_sql('upper(p_name)')}
              ELSE {uuid5_sql('p_name')} END AS id_name
  FROM part
)
SELECT p_partkey, id_name, name FROM s WHERE id_name IS DISTINCT FROM {uuid5_sql('name')}
""")
def q_check_wrong_keys(spark: SparkSession, sf: str) -> DataFrame:
    stored = _stored_part_keys(fv.Tables(spark, sf).part)
    return qc.wrong_keys(stored, "id_name", "name", show=["p_partkey", "id_name", "name"])


@register("check_one_to_many", """
SELECT p_name AS name, COUNT(DISTINCT p_partkey) AS cnt FROM part GROUP BY p_name
HAVING COUNT(DISTINCT p_partkey) > 1
""")
def q_check_one_to_many(spark: SparkSession, sf: str) -> DataFrame:
    return qc.one_to_many(fv.product_from_parts(fv.Tables(spark, sf).part), "name", "id_name")


@register("check_duplicates", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS cnt FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def q_check_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return qc.duplicates(fv.Tables(spark, sf).lineitem, ["l_orderkey", "l_linenumber"])


@register("check_orphans", """
SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL
""")
def q_check_orphans(spark: SparkSession, sf: str) -> DataFrame:
    t = fv.Tables(spark, sf)
    return qc.orphans(t.documents, t.labels, "doc_id", show=["doc_id", "source"])


@register("check_invalid_prices", """
SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, o.o_totalprice
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE l.l_extendedprice < 0 OR l.l_discount < 0 OR l.l_tax < 0 OR o.o_totalprice < 0
   OR (l.l_extendedprice IS NOT NULL AND o.o_totalprice IS NOT NULL AND l.l_extendedprice > o.o_totalprice)
""")
def q_check_invalid_prices(spark: SparkSession, sf: str) -> DataFrame:
    """A line priced above its whole order, or any negative price."""
    t = fv.Tables(spark, sf)
    lines = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice"), "l_orderkey")
    pred = qc.invalid_prices(["l_extendedprice", "l_discount", "l_tax", "o_totalprice"],
                             "l_extendedprice", "o_totalprice")
    return qc.violations(lines, pred, ["l_orderkey", "l_linenumber", "l_extendedprice", "o_totalprice"])


@register("check_negative_values", """
SELECT c_custkey, c_acctbal FROM customer WHERE COALESCE(c_acctbal, 0) < 0
""")
def q_check_negative_values(spark: SparkSession, sf: str) -> DataFrame:
    return qc.violations(fv.Tables(spark, sf).customer, qc.negative_values(["c_acctbal"]), ["c_custkey", "c_acctbal"])


_VOLUMES = {"last_24_hours_volume": "l_quantity - 10", "last_7_days_volume": "l_linenumber - 2",
            "last_30_days_volume": "l_quantity - 30", "last_90_days_volume": "l_orderkey"}


@register("check_negative_volumes", "SELECT l_orderkey, l_linenumber, "
          + ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in _VOLUMES.items())
          + " FROM lineitem WHERE " + " OR ".join(f"{e} < 0" for e in _VOLUMES.values()))
def q_check_negative_volumes(spark: SparkSession, sf: str) -> DataFrame:
    """Any of the four volumes below zero."""
    lines = fv.Tables(spark, sf).lineitem.selectExpr(
        "l_orderkey", "l_linenumber", *[f"CAST({e} AS BIGINT) AS {n}" for n, e in _VOLUMES.items()])
    return qc.violations(lines, qc.negative_values(list(_VOLUMES)), ["l_orderkey", "l_linenumber", *_VOLUMES])


@register("check_future", """
SELECT event_id, user_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-30 00:00:00' + INTERVAL 5 MINUTE
""")
def q_check_future(spark: SparkSession, sf: str) -> DataFrame:
    return qc.future_rows(fv.Tables(spark, sf).events, "ts", AS_OF_TS, show=["event_id", "user_id", "ts"])


def _part_price_stats(t: fv.Tables) -> DataFrame:
    """Per part, four statistic blocks from its lines, some slots from the list
    price, some swapped or empty, so that every order rule is broken by some part."""
    ext = F.col("l_extendedprice")
    per_part = t.lineitem.groupBy("l_partkey").agg(
        F.min(ext).alias("mn"), F.max(ext).alias("mx"),
        (F.sum(ext.cast("decimal(18,2)")).cast("double") / F.count(ext)).alias("av"))
    j = per_part.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    return j.select(
        "l_partkey",
        F.col("mn").alias("last_24_hours_min"), F.col("mx").alias("last_24_hours_max"),
        (F.col("p_retailprice") * 20).alias("last_24_hours_median"), F.col("av").alias("last_24_hours_avg"),
        F.col("mn").alias("last_7_days_min"), F.col("mx").alias("last_7_days_max"),
        F.col("av").alias("last_7_days_median"), (F.col("p_retailprice") * 10).alias("last_7_days_avg"),
        F.col("mx").alias("last_30_days_min"), F.col("mn").alias("last_30_days_max"),
        F.lit(None).cast("double").alias("last_30_days_median"), F.lit(None).cast("double").alias("last_30_days_avg"),
        F.lit(None).cast("double").alias("last_90_days_min"), F.col("av").alias("last_90_days_max"),
        (F.col("p_retailprice") * 15).alias("last_90_days_median"), F.col("mn").alias("last_90_days_avg"),
    )


_PART_STATS_SQL = """
WITH a AS (
  SELECT l_partkey, MIN(l_extendedprice) AS mn, MAX(l_extendedprice) AS mx,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_extendedprice) AS av
  FROM lineitem GROUP BY l_partkey
), s AS (
  SELECT a.l_partkey, mn, mx, p.p_retailprice * 20 AS md24, av, p.p_retailprice * 10 AS av7,
         p.p_retailprice * 15 AS md90, CAST(NULL AS DOUBLE) AS nil
  FROM a JOIN part p ON p.p_partkey = a.l_partkey
)
"""


def _inv_sql(period: str, mn: str, md: str, mx: str, av: str) -> str:
    conds = [f"({a} IS NOT NULL AND {b} IS NOT NULL AND {a} > {b})"
             for a, b in ((mn, mx), (mn, md), (md, mx), (mn, av), (av, mx))]
    return (f"SELECT l_partkey, '{period}' AS period, {mn} AS min, {md} AS median, {mx} AS max, {av} AS avg "
            f"FROM s WHERE " + " OR ".join(conds))


@register("check_period_invariants", _PART_STATS_SQL + _inv_sql("last_24_hours", "mn", "md24", "mx", "av")
          + "\nUNION ALL\n" + _inv_sql("last_7_days", "mn", "av", "mx", "av7")
          + "\nUNION ALL\n" + _inv_sql("last_30_days", "mx", "nil", "mn", "nil")
          + "\nUNION ALL\n" + _inv_sql("last_90_days", "nil", "md90", "av", "mn"))
def q_check_period_invariants(spark: SparkSession, sf: str) -> DataFrame:
    stats = _part_price_stats(fv.Tables(spark, sf))
    return qc.period_violations(stats, ["last_24_hours", "last_7_days", "last_30_days", "last_90_days"], ["l_partkey"])


@register("null_profile", """
SELECT COUNT(*) AS rows_total,
       CAST(SUM(CASE WHEN l.quality IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_quality,
       CAST(SUM(CASE WHEN l.toxic IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def q_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    prof = qc.null_profile(_labelled_docs(fv.Tables(spark, sf)), {"null_quality": "quality", "null_toxic": "toxic"})
    return prof.withColumns({c: F.col(c).cast("bigint") for c in ("null_quality", "null_toxic")})


@register("row_counts", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS \"table\", COUNT(*) AS rows_total FROM {n}" for n in ("part", "orders", "lineitem", "events")))
def q_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = fv.Tables(spark, sf)
    return qc.row_counts({n: getattr(t, n) for n in ("part", "orders", "lineitem", "events")})


@register("quality_report", """
SELECT 'events: future times' AS "check", COUNT(*) AS violations FROM events
  WHERE ts > TIMESTAMP '2024-01-30 00:00:00' + INTERVAL 5 MINUTE
UNION ALL SELECT 'customer: negative balance', COUNT(*) FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'lineitem: duplicate (order, line)', COUNT(*) FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
UNION ALL SELECT 'documents: no label', COUNT(*) FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL SELECT 'part: name with several ids', COUNT(*) FROM (
  SELECT 1 FROM part GROUP BY p_name HAVING COUNT(DISTINCT p_partkey) > 1)
""")
def q_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """The suite over several tables as one job; the report keeps every
    failing check with its violation count (and a bounded sample)."""
    t = fv.Tables(spark, sf)
    parts = [
        qc.row_checks(t.events, {"events: future times": qc.future_time("ts", AS_OF_TS, ts_type="timestamp_ntz")},
                      ["event_id", "ts"]),
        qc.row_checks(t.customer, {"customer: negative balance": qc.invalid_prices(["c_acctbal"])},
                      ["c_custkey", "c_acctbal"]),
        qc.as_check("lineitem: duplicate (order, line)", qc.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])),
        qc.as_check("documents: no label", qc.orphans(t.documents, t.labels, "doc_id", show=["doc_id"])),
        qc.as_check("part: name with several ids", qc.one_to_many(fv.product_from_parts(t.part))),
    ]
    return qc.suite_report(parts).select("check", "violations")


@register("freshness", """
SELECT 'events' AS "table", DATE '2024-01-30' AS day, COUNT(*) AS rows_today, COUNT(*) > 0 AS fresh
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30'
UNION ALL
SELECT 'orders', DATE '2024-01-30', COUNT(*), COUNT(*) > 0 FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '2024-01-30'
""")
def q_freshness(spark: SparkSession, sf: str) -> DataFrame:
    t = fv.Tables(spark, sf)
    return fresh.freshness({"events": (t.events, "ts"), "orders": (t.orders, "o_orderdate")}, "2024-01-30")




@register("check_orders_without_lines", """
SELECT o.o_orderkey, o.o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def q_check_orders_without_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orphans the other way round: the referenced table is the big fact table."""
    t = fv.Tables(spark, sf)
    return qc.orphans(t.orders, t.lineitem, "o_orderkey", "l_orderkey", show=["o_orderkey", "o_orderstatus"])


def _fixture_ods(t: fv.Tables):
    """An ODS built from the driver tables: customers as products keyed by the
    name's key; views/clicks as book A (a view's max price is half its min:
    an invalid row); purchases as book B priced 100 lower (some negative)."""
    from pricelake.plans.ods import Ods

    cust = t.customer.select("c_custkey", F.col("c_name").alias("name"), uuid5("c_name").alias("id_name"))
    product = cust.select("id_name", "name", F.lit(None).cast("string").alias("item_page"),
                          F.lit(None).cast("string").alias("market_page"))
    ev = join_dimension(t.events, cust.select(F.col("c_custkey").alias("user_id"), "id_name"), "user_id")
    v = F.col("value").cast("decimal(18,4)")
    book_a = ev.filter(F.col("event_type").isin("view", "click")).select(
        "id_name", F.col("ts").cast("timestamp").alias("date_extracted"), v.alias("suggested_price"),
        v.alias("min_price"),
        F.when(F.col("event_type") == "view", v / 2).otherwise(v).cast("decimal(18,4)").alias("max_price"),
        F.lit(None).cast("decimal(18,4)").alias("mean_price"), F.lit(None).cast("decimal(18,4)").alias("median_price"))
    book_b = ev.filter(F.col("event_type") == "purchase").select(
        "id_name", F.col("ts").cast("timestamp").alias("date_extracted"), (v - 100).alias("price"))
    return Ods(product=product, book_a=book_a, book_b=book_b)


@register("ods_quality_report", """
WITH e AS (SELECT * FROM events WHERE user_id IN (SELECT c_custkey FROM customer)),
r AS (
  SELECT 'book_a.price' AS "check", COUNT(*) AS violations
  FROM e WHERE event_type = 'view' AND CAST(value AS DECIMAL(18,4)) > CAST(value AS DECIMAL(18,4)) / 2
  UNION ALL SELECT 'book_a.ahead_of_time', COUNT(*) FROM e
  WHERE event_type IN ('view', 'click') AND ts > TIMESTAMP '2024-01-30 00:00:00' + INTERVAL 5 MINUTE
  UNION ALL SELECT 'book_b.price', COUNT(*) FROM e WHERE event_type = 'purchase' AND value < 100
  UNION ALL SELECT 'book_b.ahead_of_time', COUNT(*) FROM e
  WHERE event_type = 'purchase' AND ts > TIMESTAMP '2024-01-30 00:00:00' + INTERVAL 5 MINUTE
)
SELECT "check", violations FROM r WHERE violations > 0
""")
def q_ods_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """The whole ODS suite (every check of every table, one job) on the fixture ODS."""
    from pricelake.plans.ods_checks import ods_report

    return ods_report(_fixture_ods(fv.Tables(spark, sf)), AS_OF_TS).select("check", "violations")


@register("ods_book_a_summary", """
SELECT COUNT(*) AS rows_total,
       CAST(SUM(0) AS BIGINT) AS null_min, CAST(SUM(0) AS BIGINT) AS null_max,
       CAST(COUNT(*) AS BIGINT) AS null_mean, CAST(COUNT(*) AS BIGINT) AS null_median
FROM events WHERE event_type IN ('view', 'click') AND user_id IN (SELECT c_custkey FROM customer)
""")
def q_ods_book_a_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The book-A summary of the ODS suite (row total and NULLs per price) on the fixture ODS."""
    from pricelake.plans.ods_checks import ods_summaries

    out = ods_summaries(_fixture_ods(fv.Tables(spark, sf)))["book_a"]
    return out.withColumns({c: F.col(c).cast("bigint") for c in out.columns if c.startswith("null_")})
