"""Lenient loads with rejects, the suite over history, profiles kept by day, counts from footers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pricelake.operators import freshness, staging
from pricelake.plans import ods, ods_checks
from pricelake.sources import raw as rawsrc

from conftest import SF_SMALL, rows

TS, DAY = "2025-11-05 10:00:00", "2025-11-05"


def _land(spark, tmp, root, kind, docs, ts=TS):
    path = os.path.join(tmp, f"{kind}-{abs(hash(json.dumps(docs)))}.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(docs, f)
    rawsrc.land(rawsrc.load_raw(spark, path, ts), os.path.join(root, kind))


def test_lenient_day_files_and_counts_what_it_could_not_type(spark, tmp):
    raw_root, ods_root = os.path.join(tmp, "raw"), os.path.join(tmp, "ods")
    _land(spark, tmp, raw_root, "items", [{"name": "A", "suggested_price": "1,5", "min_price": "", "max_price": 3},
                                          {"name": "B", "suggested_price": "free", "min_price": "low"}])
    _land(spark, tmp, raw_root, "history", [{"name": "A", "last_7_days": {"avg": "2.5", "volume": "4.5"}}])
    _land(spark, tmp, raw_root, "listings", [{"name": "A", "price": 1, "created_at": "yesterday"}, {"name": "B", "price": 2, "created_at": f"{DAY}T01:00:00Z"}])
    with pytest.raises(Exception):
        ods.run_ods_day(spark, raw_root, ods_root, DAY)
    for _ in range(2):  # a rerun replaces the rejects of the first
        out = ods.run_ods_day(spark, raw_root, ods_root, DAY, lenient=True)
        assert {k: v for k, v in out.items() if k.startswith("rejects")} == {"rejects.items": 3, "rejects.history": 1, "rejects.listings": 1}
        got = spark.read.parquet(os.path.join(ods_root, "rejects"))
        assert sorted((r.batch, r.field, r.text) for r in got.collect()) == [
            ("history", "last_7_days_volume", "4.5"), ("items", "min_price", "low"), ("items", "suggested_price", "1,5"),
            ("items", "suggested_price", "free"), ("listings", "created_at", "yesterday")]
    tables_ = ods.read_ods(spark, ods_root)
    book = tables_.book_a.collect()
    # Typed values, NULLs of blank or absent fields and rejects account for every field.
    fields = sum(getattr(r, c) is not None for r in book for c in staging.BOOK_A_PRICES)
    assert len(book) == 2 and fields == 1 and tables_.book_b.count() == 1
    _land(spark, tmp, raw_root, "items", [{"name": "A", "suggested_price": "1.5"}])
    assert ods.run_ods_day(spark, raw_root, ods_root, DAY, lenient=True)["rejects.items"] == 0
    assert spark.read.parquet(os.path.join(ods_root, "rejects")).filter("batch = 'items'").count() == 0


def test_strict_staging_has_no_reject_column(spark):
    raw = rawsrc.payloads_from_rows(spark.createDataFrame([("A", "1")], "name string, price string"), ingest_ts=TS)
    assert staging.REJECTS not in staging.stage_book_b(raw).columns
    assert staging.REJECTS not in staging.dedup_staged(staging.stage_book_a(raw, lenient=True)).columns


def test_every_check_of_the_suite_finds_something(spark):
    from pricelake.plans import fixture_views as fv
    from pricelake.plans.queries.suite import SUITE_NOW, _faulty_ods

    found = {r.check for r in ods_checks.ods_report(_faulty_ods(fv.Tables(spark, SF_SMALL)), SUITE_NOW).collect()}
    expected = {"product.key_null", "product.key_wrong", "product.name_split", "book_a.key_null", "history.volume",
                *[f"history.order.{p}" for p in staging.PERIODS], *[f"{t}.price" for t in ("book_a", "book_b")],
                *[f"{t}.{w}" for t in ("book_a", "book_b", "history") for w in ("ahead_of_time", "twice", "unknown_product")]}
    assert found == expected


def test_profiles_are_kept_by_day_and_add_up(spark, tmp):
    raw_root, ods_root = os.path.join(tmp, "raw"), os.path.join(tmp, "ods")
    for day, items in (("2025-11-04", [{"name": "A", "min_price": 1}]), (DAY, [{"name": "A"}, {"name": "B", "min_price": 2}])):
        _land(spark, tmp, raw_root, "items", items, f"{day} 10:00:00")
        ods.run_ods_day(spark, raw_root, ods_root, day)

    def whole():
        return {k: rows(v) for k, v in ods_checks.ods_summaries(ods.read_ods(spark, ods_root)).items()}

    assert {k: rows(v) for k, v in ods_checks.kept_summaries(spark, ods_root).items()} == whole()
    path = os.path.join(ods_root, "profiles", "book_a")
    stamp = {d: os.path.getmtime(os.path.join(path, f"day={d}")) for d in ("2025-11-04", DAY)}
    _land(spark, tmp, raw_root, "items", [{"name": "A", "min_price": 5}, {"name": "B", "min_price": 2}, {"name": "C"}])
    ods.run_ods_day(spark, raw_root, ods_root, DAY)
    found, summaries = ods_checks.audit_ods_root(spark, ods_root, "2025-11-05 12:00:00", days=[DAY])
    assert found == [] and {k: [tuple(v.values())] for k, v in summaries.items()} == whole()
    assert os.path.getmtime(os.path.join(path, "day=2025-11-04")) == stamp["2025-11-04"]
    # A day that a run has not named, but nobody has counted yet, is counted too.
    _land(spark, tmp, raw_root, "items", [{"name": "D"}], "2025-11-06 10:00:00")
    ods.run_ods_day(spark, raw_root, ods_root, "2025-11-06")
    assert {k: rows(v) for k, v in ods_checks.kept_summaries(spark, ods_root, [DAY]).items()} == whole()


def test_counts_come_from_file_footers(spark, tmp):
    path = os.path.join(tmp, "t")
    spark.range(100).withColumn("ingest_date", F.expr(f"date_add(DATE '{DAY}', cast(id % 3 as int))")).write.partitionBy("ingest_date").parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with freshness.footer_counts(spark):
        df = freshness.counted(spark, path, "ingest_date", DAY)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan and df.first()[0] == 34
        assert freshness.counted(spark, path).first()[0] == 100
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    got = freshness.stored_freshness(spark, {"t": path}, DAY).unionByName(freshness.stored_freshness(spark, {"t": path}, "2025-12-24"))
    plain = [freshness.freshness({"t": (spark.read.parquet(path), "ingest_date")}, d, day_is_column=True) for d in (DAY, "2025-12-24")]
    assert rows(got) == rows(plain[0].unionByName(plain[1]))


def test_an_update_never_multiplies_rows(spark):
    from pricelake.operators import merge

    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (None, "n", 1), (None, "m", 1)], "k int, v string, at int")
    with pytest.raises(Exception, match="holds a key twice"):
        merge.update_from(target, twice, ["k"], ["v"]).collect()
    assert rows(merge.update_from(target, twice, ["k"], ["v"], order=[F.col("at").desc()])) == [(1, "y"), (2, "b")]
    assert rows(merge.update_from(target, twice.filter("at = 1"), ["k"], ["v"])) == [(1, "x"), (2, "b")]
