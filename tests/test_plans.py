"""Plan-shape checks: the physical plans the operators are designed for."""

import os

import pytest

from pricelake.plans.registry import QUERIES

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_books_join_reuses_window_shuffles(spark, no_broadcast):
    plan = _plan(QUERIES["arbitrage"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("WindowGroupLimit") >= 4  # partial + final on both books
    # two shuffles for the two books (shared by the book join) + two for the product join
    assert plan.count("Exchange hashpartitioning") == 4


def test_latest_uses_partial_limit_before_shuffle(spark):
    plan = _plan(QUERIES["sales_history"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scans_prune_columns_and_push_filters(spark):
    df = QUERIES["arbitrage"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(event_type" in text or "PushedFilters: [IsNotNull(event_type)" in text
    assert "props" not in text  # unused JSON column is never read


def test_merges_do_not_shuffle_target_when_source_small(spark):
    plan = _plan(QUERIES["upsert"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_name_marts_shuffle_history_once_without_broadcast(spark, no_broadcast):
    plan = _plan(QUERIES["volatility"](spark, SF_SMALL))
    # two-level: window (id, day) shuffle of the history, then the product join and
    # the (name, day) window run on reduced rows
    assert plan.count("WindowGroupLimit") >= 4


def test_hot_key_is_cut_before_the_shuffle(spark):
    """One key holds a third of the rows: the partial limit leaves it one row
    per map task, and the result is whole and right."""
    from pyspark.sql import functions as F

    from pricelake.operators.latest import latest_per_key

    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    ).repartition(6)
    out = latest_per_key(df, ["k"], [F.col("v").desc()])
    plan = _plan(out)
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange") or "Partial" in plan
    got = {r.k: r.v for r in out.collect()}
    assert len(got) == n - n // 3 + 1 and got[-1] == max(i for i in range(n) if i % 3 == 0)


def test_day_filter_prunes_raw_partitions(spark, tmp):
    from pyspark.sql import functions as F

    from pricelake.operators import staging
    from pricelake.sources import raw as rawsrc

    rows = spark.createDataFrame([("x",)], "p string")
    for day in ("2025-11-01", "2025-11-02", "2025-11-03"):
        rawsrc.land(rawsrc.payloads_from_rows(rows, ingest_ts=f"{day} 10:00:00"), os.path.join(tmp, "raw"))
    day = staging.for_day(rawsrc.read_raw(spark, os.path.join(tmp, "raw")), "2025-11-02")
    plan = _plan(day)
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "= 2025-11-02" in plan
    assert day.count() == 1 and day.select(F.col("ingest_date").cast("string")).first()[0] == "2025-11-02"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name,table,wide", [
    ("check_orphans", "documents", "text"), ("check_null_keys", "documents", "text"),
    ("null_profile", "documents", "text"), ("url_names", "pages", "html"), ("quality_report", "documents", "text"),
])
def test_wide_columns_are_pruned(spark, name, table, wide):
    import re

    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for scan in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*" + table + r"\.parquet", plan):
        assert wide not in [c.split("#")[0] for c in scan.split(",")]


def test_latest_needs_an_order(spark):
    from pricelake.operators.latest import latest_per_key

    with pytest.raises(ValueError):
        latest_per_key(spark.range(3), ["id"], [])
    with pytest.raises(ValueError):
        latest_per_key(spark.range(3), ["id"], [spark.range(1).id], n=0)
