"""Views of the driver's synthetic tables in the warehouse's ODS shape.

The checked queries run the library operators on these views, so each one
exercises the same code a production job would run. The mapping:

* product  <- customer (id = c_custkey, name = c_name) for the books/volatility,
              part (id = p_partkey, name = p_name; 64 names over many ids) for
              the sales-history marts
* book A   <- events of type view/click (price = value), book B <- purchases
* history  <- lineitem lines as snapshots of a part at its ship date (24 h
              average = extended price, volume = quantity), and per
              (user, event type, day) statistics of events as 7-day snapshots

Prices are cast to the ODS price type (decimal(18,4)) exactly as staging does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.json_fields import PRICE_TYPE
from pricelake.session import apply_defaults

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def parallelism(spark: SparkSession) -> int:
    """Task slots of the session (the shuffle-partition setting where the
    session has no local context, e.g. a remote client)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Tables:
    """The driver tables of one scale; makes the session's days UTC days."""

    spark: SparkSession
    sf_dir: str

    def __post_init__(self) -> None:
        apply_defaults(self.spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


def price(c: str) -> F.Column:
    return F.col(c).cast(PRICE_TYPE)


def product_from_customers(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").alias("id_name"), F.col("c_name").alias("name"))


def product_from_parts(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("id_name"), F.col("p_name").alias("name"))


BOOK_A_TYPES = ("view", "click")
BOOK_B_TYPES = ("purchase",)


def book_a_from_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin(*BOOK_A_TYPES)).select(
        F.col("user_id").alias("id_name"),
        F.col("ts").alias("date_extracted"),
        price("value").alias("suggested_price"),
        "event_id",
    )


def book_b_from_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin(*BOOK_B_TYPES)).select(
        F.col("user_id").alias("id_name"),
        F.col("ts").alias("date_extracted"),
        price("value").alias("price"),
        "event_id",
    )


# Columns that, with the part and ship date, make a lineitem row unique.
LINE_TIE_BREAKS = ("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


def history_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_partkey").alias("id_name"),
        F.col("l_shipdate").alias("date_extracted"),
        price("l_extendedprice").alias("last_24_hours_avg"),
        F.col("l_quantity").cast("int").alias("last_24_hours_volume"),
        *LINE_TIE_BREAKS,
    )


def history_from_events(events: DataFrame) -> DataFrame:
    """One snapshot per (user, event type, day), stamped with its last event time."""
    v = price("value")
    return (
        events.groupBy(
            F.col("user_id").alias("id_name"), "event_type", F.to_date("ts").alias("d")
        )
        .agg(
            F.max("ts").alias("date_extracted"),
            F.min(v).alias("last_7_days_min"),
            F.max(v).alias("last_7_days_max"),
            (F.sum(v).cast("double") / F.count(v)).alias("last_7_days_avg"),
            F.count(F.lit(1)).cast("int").alias("last_7_days_volume"),
        )
        .drop("d")
    )
