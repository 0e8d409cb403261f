"""End to end: JSON documents -> raw zone -> ODS -> marts -> checks."""

import json
import os

from pyspark.sql import functions as F

from pricelake.operators import quality as qc
from pricelake.plans import mart_refresh, ods, ods_checks
from pricelake.sources import raw as rawsrc

from conftest import rows

DAY = "2025-11-05"
TS = "2025-11-05 10:00:00"


def _docs(tmp):
    items = [
        {"market_hash_name": "AK-47 | Redline", "currency": "EUR", "suggested_price": 10, "min_price": 9,
         "max_price": 12, "mean_price": 10.5, "median_price": 10, "item_page": "https://x/ak", "market_page": "https://m/ak"},
        {"market_hash_name": "AWP | Asiimov", "suggested_price": "50.5", "min_price": "", "max_price": 60},
        {"name": "★ Karambit | Fade", "suggested_price": 300},
    ]
    history = [
        {"market_hash_name": "AK-47 | Redline", "last_24_hours": {"min": 9, "max": 11, "avg": 10, "median": 10, "volume": 5},
         "last_7_days": {"min": 8, "max": 12, "avg": 10, "median": 10, "volume": 30}},
        {"market_hash_name": "AWP | Asiimov", "last_24_hours": {"min": 49, "max": 52, "avg": 50, "median": 50, "volume": 2},
         "last_7_days": {"min": 45, "max": 55, "avg": 0, "median": 50, "volume": 9}},
    ]
    listings = [
        {"id": 1, "skin_id": 7, "price": 9, "created_at": "2025-11-05T08:00:00Z", "market_hash_name": "AK-47 | Redline"},
        {"id": 2, "skin_id": 7, "price": 8, "created_at": "2025-11-05T09:00:00Z", "market_hash_name": "AK-47 | Redline"},
        {"id": 3, "skin_id": 8, "price": 300, "created_at": "2025-11-05T07:00:00Z", "name": "★ Karambit | Fade"},
        {"id": 4, "skin_id": 9, "price": 51, "created_at": "2025-11-04T07:00:00Z", "market_hash_name": "AWP | Asiimov"},
    ]
    paths = {}
    for name, body in (("items", items), ("history", history), ("listings", listings)):
        d = os.path.join(tmp, "landing", name)
        os.makedirs(d)
        with open(os.path.join(d, f"{name}.json"), "w", encoding="utf-8") as f:
            json.dump(body, f, ensure_ascii=False)
        paths[name] = d
    return paths


def test_end_to_end_twice_is_idempotent(spark, tmp):
    paths = _docs(tmp)
    raw_root, ods_root = os.path.join(tmp, "raw"), os.path.join(tmp, "ods")
    for name, p in paths.items():
        rawsrc.land(rawsrc.load_raw(spark, p, TS), os.path.join(raw_root, name))

    ods.run_ods_day(spark, raw_root, ods_root, DAY)
    first = ods.read_ods(spark, ods_root)
    snap1 = {k: rows(getattr(first, k).drop("day") if "day" in getattr(first, k).columns else getattr(first, k))
             for k in ("product", "book_a", "history", "book_b")}
    assert len(snap1["product"]) == 3 and len(snap1["book_a"]) == 3 and len(snap1["history"]) == 2
    assert len(snap1["book_b"]) == 4  # one listing per (item, time)

    # rerun of the same day: merges are idempotent
    rawsrc.land(rawsrc.load_raw(spark, paths["items"], TS), os.path.join(raw_root, "items"))
    ods.run_ods_day(spark, raw_root, ods_root, DAY)
    second = ods.read_ods(spark, ods_root)
    snap2 = {k: rows(getattr(second, k).drop("day") if "day" in getattr(second, k).columns else getattr(second, k))
             for k in ("product", "book_a", "history", "book_b")}
    assert snap1 == snap2

    # the ODS checks flag exactly the seeded fault (AWP's 7-day average 0 is below its minimum)
    rep = {r.check: r.violations for r in ods_checks.ods_report(second, "2025-11-05 12:00:00").collect()}
    assert rep == {"history.order.last_7_days": 1}
    summaries = ods_checks.ods_summaries(second)
    assert summaries["book_a"].first().null_min == 2

    # marts
    out = mart_refresh.refresh_marts({}, mart_refresh.mart_rows(second, market_a="A", market_b="B"))
    arb = {r.item_name: r for r in out["arbitrage"].collect()}
    assert set(arb) == {"AK-47 | Redline"}  # knife: equal prices; AWP: listing from another day
    assert arb["AK-47 | Redline"].buy_platform == "B" and float(arb["AK-47 | Redline"].profit_abs) == 2.0
    assert out["order_books"].count() == 2
    vol = {r.item_name: r.volatility_index for r in out["volatility"].collect()}
    assert vol == {"AK-47 | Redline": 0.4, "AWP | Asiimov": 0.0}
    assert out["group_analytics"].count() == 2  # AK-47 and AWP groups
    again = mart_refresh.refresh_marts(out, mart_rows := mart_refresh.mart_rows(second))
    assert again["sales_history"].count() == out["sales_history"].count()
    assert mart_rows["arbitrage"].count() == 1


def test_checks_catch_seeded_faults(spark):
    prod = spark.createDataFrame([("bad-key", "x")], "id_name string, name string")
    book = spark.createDataFrame(
        [("bad-key", "2025-11-05 10:00:00", -1.0, 5.0, 1.0), ("bad-key", "2025-11-05 10:00:00", 1.0, 1.0, 1.0),
         ("orphan", "2030-01-01 00:00:00", 1.0, 1.0, 1.0)],
        "id_name string, date_extracted string, suggested_price double, min_price double, max_price double",
    ).withColumn("date_extracted", F.col("date_extracted").cast("timestamp")) \
     .withColumn("mean_price", F.lit(None).cast("double")).withColumn("median_price", F.lit(None).cast("double"))
    rep = {r.check: r.violations for r in ods_checks.ods_report(ods.Ods(product=prod, book_a=book), "2025-11-05 12:00:00").collect()}
    assert rep == {
        "product.key_wrong": 1,
        "book_a.price": 1,
        "book_a.twice": 1,
        "book_a.unknown_product": 1,
        "book_a.ahead_of_time": 1,
    }


def test_mart_runner_idempotent(spark, tmp):
    paths = _docs(tmp)
    raw_root, ods_root, marts_root = (os.path.join(tmp, x) for x in ("raw", "ods", "marts"))
    for name, p in paths.items():
        rawsrc.land(rawsrc.load_raw(spark, p, TS), os.path.join(raw_root, name))
    ods.run_ods_day(spark, raw_root, ods_root, DAY)
    assert set(mart_refresh.run_marts(spark, ods_root, marts_root)) == set(mart_refresh.MART_NAMES)
    first = {m: rows(spark.read.parquet(os.path.join(marts_root, m))) for m in mart_refresh.MART_NAMES}
    mart_refresh.run_marts(spark, ods_root, marts_root, days=["2025-11-05"])  # days as text work too
    second = {m: rows(spark.read.parquet(os.path.join(marts_root, m))) for m in mart_refresh.MART_NAMES}
    assert first == second
    assert len(first["arbitrage"]) == 1 and len(first["order_books"]) == 2


def test_two_days(spark, tmp):
    import datetime as dt

    paths = _docs(tmp)
    raw_root, ods_root = os.path.join(tmp, "raw"), os.path.join(tmp, "ods")
    for name, p in paths.items():
        rawsrc.land(rawsrc.load_raw(spark, p, TS), os.path.join(raw_root, name))
    ods.run_ods_day(spark, raw_root, ods_root, DAY)
    day2 = os.path.join(tmp, "landing2")
    os.makedirs(day2)
    with open(os.path.join(day2, "h.json"), "w") as f:
        json.dump({"market_hash_name": "New | Item", "last_24_hours": {"avg": 1, "volume": 1}}, f)
    with open(os.path.join(day2, "l.json"), "w") as f:
        json.dump([{"id": 9, "price": 2, "created_at": "2025-11-06T01:00:00Z", "market_hash_name": "New | Item"}], f)
    ts2 = "2025-11-06 10:00:00"
    rawsrc.land(rawsrc.load_raw(spark, os.path.join(day2, "h.json"), ts2), os.path.join(raw_root, "history"))
    rawsrc.land(rawsrc.load_raw(spark, os.path.join(day2, "l.json"), ts2), os.path.join(raw_root, "listings"))

    gate = {r.table: r.rows_today for r in ods.raw_freshness(spark, raw_root, "2025-11-06").collect()}
    assert gate == {"items": 0, "history": 1, "listings": 1}

    ods.run_ods_day(spark, raw_root, ods_root, "2025-11-06")
    o = ods.read_ods(spark, ods_root)
    assert o.product.count() == 4  # catalog accumulates
    assert sorted(r.day for r in o.history.select("day").distinct().collect()) == [dt.date(2025, 11, 5), dt.date(2025, 11, 6)]
    assert o.history.count() == 3 and o.book_a.count() == 3
    # each day holds that day's listings
    assert [float(r.price) for r in o.book_b.filter("day = '2025-11-06'").collect()] == [2.0]
    rep = ods_checks.check_ods_root(spark, ods_root, "2025-11-06 12:00:00", fail=False)
    assert {r.check for r in rep.collect()} == {"history.order.last_7_days"}
    # checking only the day just loaded: day 1's fault is not in it
    ods_checks.check_ods_root(spark, ods_root, "2025-11-06 12:00:00", days=["2025-11-06"])
    import pytest

    from pricelake.operators.quality import QualityError

    with pytest.raises(QualityError):  # ... but checking day 1 finds it
        ods_checks.check_ods_root(spark, ods_root, "2025-11-06 12:00:00", days=[dt.date(2025, 11, 5)])


def test_ods_day_dataframe_api(spark, tmp):
    """The same day load on DataFrames only (no paths): twice gives the same tables."""
    paths = _docs(tmp)
    raw = ods.Raw(**{k: rawsrc.load_raw(spark, p, TS) for k, p in paths.items()})
    first = ods.ods_day(raw, ods.Ods(), DAY)
    second = ods.ods_day(raw, first, DAY)
    for name in ("product", "book_a", "history", "book_b"):
        assert rows(getattr(first, name)) == rows(getattr(second, name)), name
    assert first.product.count() == 3 and first.book_b.count() == 4


def test_tables_match_declared_schemas(spark, tmp):
    from pricelake.plans import schemas

    paths = _docs(tmp)
    raw = ods.Raw(**{k: rawsrc.load_raw(spark, p, TS) for k, p in paths.items()})
    assert [(f.name, f.dataType) for f in raw.items.schema.fields] == \
        [(f.name, f.dataType) for f in schemas.RAW.fields]
    o = ods.ods_day(raw, ods.Ods(), DAY)
    for name, schema in schemas.ODS.items():
        got = [(f.name, f.dataType) for f in getattr(o, name).schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields], name
    for name, df in mart_refresh.mart_rows(o).items():
        got = [(f.name, f.dataType) for f in df.schema.fields]
        assert got == [(f.name, f.dataType) for f in schemas.MARTS[name].fields], name


def test_day_scoped_marts_prune_partitions(spark, tmp):
    paths = _docs(tmp)
    raw_root, ods_root = os.path.join(tmp, "raw"), os.path.join(tmp, "ods")
    for name, p in paths.items():
        rawsrc.land(rawsrc.load_raw(spark, p, TS), os.path.join(raw_root, name))
    ods.run_ods_day(spark, raw_root, ods_root, DAY)
    o = ods.read_ods(spark, ods_root)
    rows_ = mart_refresh.mart_rows(o, days=[DAY])
    plan = rows_["sales_history"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2025-11-05" in plan
    assert rows_["sales_history"].count() == 2


def test_marts_run_again_after_an_empty_mart(spark, tmp):
    """Equal prices leave the arbitrage mart empty; the next runs read it as an empty table."""
    from pricelake.plans.mart_refresh import run_marts
    from pricelake.sources import tables

    ods_root, marts_root = os.path.join(tmp, "ods"), os.path.join(tmp, "marts")
    import datetime as dt

    t = dt.datetime(2025, 11, 5, 8)
    tables.VersionedTable(spark, f"{ods_root}/product").write(
        spark.createDataFrame([("i", "Lamp", None, None)], "id_name string, name string, item_page string, market_page string"))
    price = "cast(price as decimal(18,4))"
    a = spark.createDataFrame([("i", t, 5.0)], "id_name string, date_extracted timestamp, price double")
    from pricelake.operators.staging import BOOK_A_PRICES

    tables.with_day(a.selectExpr("id_name", "date_extracted", *[f"{price} as {c}" for c in BOOK_A_PRICES])).write.partitionBy(
        "day").parquet(f"{ods_root}/book_a")
    tables.with_day(a.selectExpr("id_name", "date_extracted", f"{price} as price")).write.partitionBy("day").parquet(f"{ods_root}/book_b")
    for _ in range(2):
        assert "arbitrage" in run_marts(spark, ods_root, marts_root)
    assert spark.read.parquet(f"{marts_root}/order_books").count() == 1


def test_listings_stream_fills_the_book_marts(spark, tmp):
    """Batch, then a stream of listings on the same root: order books and arbitrage see the new listing."""
    from pricelake.plans.mart_refresh import run_marts
    from pricelake.streaming import ingest

    raw_root, ods_root, marts_root = (os.path.join(tmp, d) for d in ("raw", "ods", "marts"))
    for k, p in _docs(tmp).items():
        rawsrc.land(rawsrc.load_raw(spark, p, TS), os.path.join(raw_root, k))
    ods.run_ods_day(spark, raw_root, ods_root, DAY)
    run_marts(spark, ods_root, marts_root)
    before = spark.read.parquet(f"{marts_root}/order_books").count()
    o = ods.read_ods(spark, ods_root)
    name = o.product.join(o.book_a, "id_name").first()
    feed = os.path.join(tmp, "feed")
    os.makedirs(feed)
    with open(os.path.join(feed, "l.json"), "w") as f:
        f.write(json.dumps({"id": 77, "price": 1, "created_at": f"{name.day}T00:30:00Z", "market_hash_name": name.name}) + "\n")
    ingest.ingest_stream(spark, feed, os.path.join(tmp, "ck"), ingest.merge_and_refresh_batch(spark, ods_root, marts_root, kind="listings"))
    assert ods.read_ods(spark, ods_root).book_b.filter("price = 1").count() == 1
    assert spark.read.parquet(f"{marts_root}/order_books").count() >= max(1, before)
