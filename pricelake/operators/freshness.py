"""Freshness gate: does each table have rows for the UTC day ``as_of``?

Counts of stored tables can come from the footers of their files: no row is read.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _day(as_of) -> _dt.date:
    return as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)[:10])


def freshness(tables: Mapping[str, tuple[DataFrame, str]], as_of, day_is_column: bool = False) -> DataFrame:
    """``(table, day, rows_today, fresh)`` for each ``name -> (df, time_or_day_col)``.

    With ``day_is_column=True`` the column is a date partition column and the
    filter prunes to that partition; otherwise it is a timestamp whose UTC day
    is compared. All tables are counted in one job.
    """
    day = _day(as_of)
    parts = []
    for name, (df, col) in tables.items():
        pred = (F.col(col) == F.lit(day)) if day_is_column else (F.to_date(F.col(col)) == F.lit(day))
        parts.append(df.filter(pred).agg(F.count(F.lit(1)).alias("rows_today"))
                     .select(F.lit(name).alias("table"), F.lit(day).alias("day"), "rows_today"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("fresh", F.col("rows_today") > 0)


def is_fresh(df: DataFrame, col: str, as_of, day_is_column: bool = False) -> bool:
    """True when at least one row exists for the day; stops at the first row found."""
    day = _day(as_of)
    pred = (F.col(col) == F.lit(day)) if day_is_column else (F.to_date(F.col(col)) == F.lit(day))
    return len(df.filter(pred).limit(1).take(1)) > 0


@contextmanager
def footer_counts(spark: SparkSession) -> Iterator[None]:
    """While it lasts, Parquet tables are read through the reader that answers counts from file footers."""
    wanted = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def counted(spark: SparkSession, path: str, day_col: str | None = None, as_of=None) -> DataFrame:
    """``(rows_total)`` of the Parquet table at ``path``, or of one day of it (``day_col`` its partition column).

    To be planned and run within ``footer_counts``: the count is pushed into the scan.
    """
    df = spark.read.parquet(path)
    if day_col is not None:
        df = df.filter(F.col(day_col) == F.lit(_day(as_of)))
    return df.agg(F.count(F.lit(1)).alias("rows_total"))


def stored_freshness(spark: SparkSession, paths: Mapping[str, str], as_of, day_col: str = "ingest_date") -> DataFrame:
    """``freshness`` of stored tables ``name -> path``, partitioned by ``day_col``, from their file footers (a row a table)."""
    day = _day(as_of)
    with footer_counts(spark):
        rows = [(name, day, int(counted(spark, path, day_col, day).first()[0] or 0)) for name, path in paths.items()]
    out = spark.createDataFrame(rows, "table string, day date, rows_today bigint")
    return out.withColumn("fresh", F.col("rows_today") > 0)
