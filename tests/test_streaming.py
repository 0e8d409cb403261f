import json
import os

from pricelake.streaming import ingest


def _write(d, name, items):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        for it in items:
            f.write(json.dumps(it) + "\n")


def test_stream_picks_each_file_once(spark, tmp):
    landing, ckpt, out = (os.path.join(tmp, x) for x in ("landing", "ckpt", "book_a"))
    os.makedirs(landing)
    _write(landing, "a.jsonl", [{"market_hash_name": "A", "suggested_price": 1},
                                {"market_hash_name": "B", "suggested_price": 2}])
    seen = []

    def handler(batch, epoch):
        seen.append(batch.count())
        ingest.merge_batch(spark, out, "items")(batch, epoch)

    ingest.ingest_stream(spark, landing, ckpt, handler)
    assert spark.read.parquet(out).count() == 2
    ingest.ingest_stream(spark, landing, ckpt, handler)  # nothing new
    assert sum(seen) == 2
    _write(landing, "b.jsonl", [{"market_hash_name": "C", "suggested_price": 3}])
    ingest.ingest_stream(spark, landing, ckpt, handler)
    assert sum(seen) == 3 and spark.read.parquet(out).count() == 3


def test_stream_refreshes_marts_of_touched_days(spark, tmp):
    import datetime as dt

    from pricelake.sources import tables

    landing, ckpt, ods_root, marts_root = (os.path.join(tmp, x) for x in ("landing", "ckpt", "ods", "marts"))
    os.makedirs(landing)
    # the catalog is empty: the stream's own names fill it
    snap = {"market_hash_name": "AK-47 | Redline",
            "last_24_hours": {"min": 9, "max": 11, "avg": 10, "median": 10, "volume": 5},
            "last_7_days": {"min": 8, "max": 12, "avg": 10, "median": 10, "volume": 30}}
    _write(landing, "h1.jsonl", [snap])
    ingest.ingest_stream(spark, landing, ckpt, ingest.merge_and_refresh_batch(spark, ods_root, marts_root, "history"))
    vol = spark.read.parquet(os.path.join(marts_root, "volatility")).collect()
    assert len(vol) == 1 and vol[0].volatility_index == 0.4
    landed = dt.datetime.fromtimestamp(os.path.getmtime(os.path.join(landing, "h1.jsonl")), dt.timezone.utc)
    assert vol[0].date_extracted == landed.date()
    prod = tables.VersionedTable(spark, os.path.join(ods_root, "product")).read()
    assert [r.name for r in prod.collect()] == ["AK-47 | Redline"]


def test_stream_fan_out(spark, tmp):
    from pricelake.sources.raw import Sink

    landing, ckpt, a, b = (os.path.join(tmp, x) for x in ("landing", "ckpt", "a", "b"))
    os.makedirs(landing)
    _write(landing, "x.jsonl", [{"name": "A"}, {"name": "B"}])
    ingest.ingest_stream(spark, landing, ckpt, ingest.fan_out_batch([Sink(a), Sink(b, fmt="json")]))
    assert spark.read.parquet(a).count() == 2 and spark.read.json(b).count() == 2


def test_stream_rerun_stamps_like_the_first_run(spark, tmp):
    """Same files, fresh checkpoint: same load times, so the merge is unchanged."""
    landing, out = os.path.join(tmp, "landing"), os.path.join(tmp, "book_a")
    os.makedirs(landing)
    _write(landing, "a.jsonl", [{"market_hash_name": "A", "suggested_price": 1}])
    ingest.ingest_stream(spark, landing, os.path.join(tmp, "ck1"), ingest.merge_batch(spark, out, "items"))
    first = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    ingest.ingest_stream(spark, landing, os.path.join(tmp, "ck2"), ingest.merge_batch(spark, out, "items"))
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == first


def test_stream_whole_documents(spark, tmp):
    landing = os.path.join(tmp, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "d.json"), "w") as f:
        f.write(json.dumps([{"name": "A"}, {"name": "B"}]))
    seen = []
    ingest.ingest_stream(spark, landing, os.path.join(tmp, "ck"),
                         lambda df, e: seen.extend(r.payload for r in df.collect()), json_lines=False)
    assert sorted(json.loads(p)["name"] for p in seen) == ["A", "B"]


def test_default_checkpoint_under_shared_dir(spark, tmp):
    landing = os.path.join(tmp, "landing")
    os.makedirs(landing)
    _write(landing, "a.jsonl", [{"name": "A"}])
    seen = []
    for _ in range(2):
        ingest.ingest_stream(spark, landing, None, lambda df, e: seen.append(df.count()))
    assert sum(seen) == 1  # second run resumed from the shared checkpoint


def test_stream_keeps_array_lines_and_quarantines_broken_ones(spark, tmp):
    landing, aside, out = (os.path.join(tmp, x) for x in ("landing", "aside", "book_a"))
    os.makedirs(landing)
    with open(os.path.join(landing, "a.jsonl"), "w") as f:
        f.write('{"market_hash_name": "A", "suggested_price": 1}\n[{"market_hash_name": "B"}, {"market_hash_name": "C"}]\n'
                '{"market_hash_name": "D", \n\n17\n{"market_hash_name": "A", "suggested_price": 2}\n')
    raw = []

    def handler(batch, epoch):
        raw.extend(batch.collect())
        ingest.merge_batch(spark, out, "items")(batch, epoch)

    ingest.ingest_stream(spark, landing, os.path.join(tmp, "ck"), handler, quarantine=aside)
    assert sorted(json.loads(r.payload)["market_hash_name"] for r in raw) == ["A", "A", "B", "C"]
    # Positions follow the lines, then the place in an array line.
    assert len({r.load_pos for r in raw}) == 4 and None not in {r.load_pos.row for r in raw}
    assert json.loads(max(raw, key=lambda r: r.load_pos).payload)["suggested_price"] == 2
    assert spark.read.parquet(out).count() == 3
    gone = spark.read.parquet(aside).collect()
    assert sorted(r.value.strip() for r in gone) == ["17", '{"market_hash_name": "D",']
    assert all(r.file.endswith("a.jsonl") and r.landed_at == raw[0].created_at for r in gone)


def test_stream_quarantines_broken_documents(spark, tmp):
    landing = os.path.join(tmp, "landing")
    os.makedirs(landing)
    for name, text in (("a.json", '[{"name": "A"}]'), ("b.json", '[{"name": ')):
        with open(os.path.join(landing, name), "w") as f:
            f.write(text)
    seen = []
    ingest.ingest_stream(spark, landing, os.path.join(tmp, "ck"), lambda df, e: seen.extend(df.collect()), json_lines=False)
    assert [json.loads(r.payload)["name"] for r in seen] == ["A"]
    gone = spark.read.parquet(ingest.quarantine_dir(spark, landing)).collect()
    assert [r.value for r in gone] == ['[{"name": '] and gone[0].file.endswith("b.json")
