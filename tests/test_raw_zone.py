"""Raw loads: strict roots, positions, parsed payloads, batches that count once."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pricelake.operators import staging
from pricelake.sources import raw as rawsrc
from pricelake.streaming import ingest

from conftest import rows

TS = "2025-11-05 10:00:00"
GOOD = {'\n{"k":1}': ['{"k":1}'], '\t[{"k":2},\r\n {"k":3}] \n': ['{"k":2}', '{"k":3}'], "[]": [], "[ ]\n": [],
        '[{"k":"]"}, [1, 2], 5, null]': ['{"k":"]"}', "[1,2]", "5", "null"], '{"a":{"b":[]}}': ['{"a":{"b":[]}}']}
BAD = ["hello garbage", '"[1]"', "17", "null", "true", '﻿{"k":1}', '[{"k":1}]\n[{"k":2}]', '[{"k":3}] garbage', '{"k":1} {"k":2}',
       '{"k":1},{"k":2}', '{"k":1}],[{"k":2}', '[{"k":1}],[{"k":2}]', '[{"k":1}', '{"k":', "[1,]", "{'k':1}", '[{"k":1}]]', '{"k":1}}',
       '[1],["x"]]', "", " \n", "\x0b{}", '{"k":1}\x00']


def _texts(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_roots_are_taken_whole_or_not_at_all(spark):
    for text, expected in GOOD.items():
        df = _texts(spark, [text])
        for lenient in (False, True):
            got = rawsrc.documents_to_payloads(df, lenient=lenient).orderBy("load_pos").collect()
            assert [r.payload.replace(" ", "") for r in got] == expected and [r.load_pos for r in got] == list(range(len(expected)))
        assert rawsrc.rejected_documents(df).count() == 0
    everything = _texts(spark, [*GOOD, *BAD, None])
    assert rawsrc.documents_to_payloads(everything, lenient=True).count() == sum(map(len, GOOD.values()))
    assert sorted(r.value or "" for r in rawsrc.rejected_documents(everything).collect()) == sorted([*BAD, ""])
    for text in [*BAD, None]:
        with pytest.raises(Exception, match="malformed JSON document"):
            rawsrc.documents_to_payloads(_texts(spark, [text])).collect()


def test_files_and_lines_lose_nothing(spark, tmp):
    whole, lines = os.path.join(tmp, "whole"), os.path.join(tmp, "lines")
    os.makedirs(whole)
    os.makedirs(lines)
    for i, text in enumerate([*GOOD, *BAD]):
        with open(os.path.join(whole, f"{i:03}.json"), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    with open(os.path.join(lines, "a.jsonl"), "w", encoding="utf-8") as f:
        f.write('\n  {"k":1}\n\t\n[{"k":2}]\n17\n{"k":3} x\n')
    got = rawsrc.load_raw(spark, whole, TS, lenient=True)
    assert got.count() == sum(map(len, GOOD.values()))
    # The text reader gives no row at all for a file of no bytes.
    assert rawsrc.load_rejected(spark, whole).count() in (len(BAD), len(BAD) - 1)
    with pytest.raises(Exception, match="malformed JSON document"):
        rawsrc.load_raw(spark, whole, TS).count()
    assert sorted(r.payload for r in rawsrc.load_raw(spark, lines, TS, json_lines=True, lenient=True).collect()) == ['{"k":1}', '{"k":2}']
    assert sorted(r.value for r in rawsrc.load_rejected(spark, lines, json_lines=True).collect()) == ["17", '{"k":3} x']
    with pytest.raises(Exception, match="malformed JSON document"):
        rawsrc.load_raw(spark, lines, TS, json_lines=True).collect()


def test_streamed_lines_with_blanks_are_payloads(spark, tmp):
    landing, seen = os.path.join(tmp, "in"), []
    os.makedirs(landing)
    with open(os.path.join(landing, "a.jsonl"), "w") as f:
        f.write('\t{"k":1}\n \n[{"k":2}] more\n')
    ingest.ingest_stream(spark, landing, os.path.join(tmp, "ck"), lambda df, e: seen.extend(df.collect()), quarantine=os.path.join(tmp, "q"))
    assert [r.payload for r in seen] == ['{"k":1}']
    assert [r.value for r in spark.read.parquet(os.path.join(tmp, "q")).collect()] == ['[{"k":2}] more']


def test_positions_follow_path_split_row_and_item(spark, tmp):
    d = os.path.join(tmp, "in")
    os.makedirs(d)
    for name, n in (("b.jsonl", 3000), ("a.jsonl", 10)):
        with open(os.path.join(d, name), "w") as f:
            for i in range(n):
                f.write(f'[{{"n":"{name}","i":{2 * i}}},{{"n":"{name}","i":{2 * i + 1}}}]\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = rawsrc.load_raw(spark, d, TS, json_lines=True)
        assert raw.rdd.getNumPartitions() > 3
        got = [json.loads(r.payload) for r in raw.orderBy("load_pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(g["n"], g["i"]) for g in got] == [("a.jsonl", i) for i in range(20)] + [("b.jsonl", i) for i in range(6000)]


PAYLOADS = [
    '{"market_hash_name":"A","suggested_price":1.50,"min_price":"","max_price":null,"mean_price":"2","created_at":"2025-11-05T01:00:00Z","price":7}',
    '{"name":"★ B","suggested_price":12345678901.25,"min_price":1e2,"last_24_hours":{"min":1,"volume":"4"},"last_7_days":"","last_30_days":null,"price":"0.5"}',
    '{"name":"","market_hash_name":null}', "[1]", "5", "null", '{"name":"C","name":"D","price":3}', '{"name":"E","suggested_price":NaN}',
    '{"name":"F","last_24_hours":{"avg":{"x":1},"max":"9"},"price":2}', '{"name":12}', '{"name":"G `x`","price":"1"}',
]


def test_parsed_payloads_stage_like_their_text(spark):
    df = spark.createDataFrame([(p, i) for i, p in enumerate(PAYLOADS)], "payload string, i long")
    raw = df.select("payload", F.lit(TS).cast("timestamp").alias("created_at"), F.to_date(F.lit(TS)).alias("ingest_date"),
                    rawsrc.position(row=F.col("i")).alias("load_pos"))
    parsed = rawsrc.with_body(raw)
    assert parsed.filter("body is null").count() == parsed.filter("unparsed is not null").count() == 2  # repeated key, NaN
    for stage in (staging.stage_book_a, staging.stage_history, staging.stage_book_b):
        by_text = rows(stage(raw, lenient=True, keep_catalog=True))
        assert rows(stage(parsed.drop("payload"), lenient=True, keep_catalog=True)) == by_text and by_text


def test_staging_reads_neither_text_nor_parses(spark, tmp):
    """From a landed zone, staging reads the parsed payload only: no parse of a text column in the plan."""
    src = os.path.join(tmp, "in.jsonl")
    with open(src, "w") as f:
        f.write("\n".join(p for p in PAYLOADS[:2]) + "\n")
    zone = os.path.join(tmp, "zone")
    rawsrc.land(rawsrc.load_raw(spark, src, TS, json_lines=True), zone)
    staged = staging.stage_history(staging.for_day(rawsrc.read_raw(spark, zone), "2025-11-05"))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "payload#" not in plan and "parse_json" not in plan
    assert staged.count() == 2


def test_batches_count_once_however_often_they_are_tried(spark, tmp):
    path = os.path.join(tmp, "zone")

    def some(names, ts):
        return rawsrc.payloads_from_rows(spark.createDataFrame([(n,) for n in names], "name string"), ingest_ts=ts)

    for _ in range(2):
        rawsrc.append_raw(some(["a", "b"], TS), path, batch="feed-1")
        rawsrc.append_raw(some(["c"], TS), path, batch="feed 2/x=y")
    assert rawsrc.read_raw(spark, path).count() == 3
    # A retry that brings other days leaves nothing of the first try.
    both = some(["a"], TS).unionByName(some(["d"], "2025-11-06 10:00:00"))
    rawsrc.append_raw(both, path, batch="feed 2/x=y")
    rawsrc.append_raw(some(["e"], "2025-11-06 10:00:00"), path, batch="feed 2/x=y")
    got = sorted((json.loads(r.payload)["name"], str(r.ingest_date)) for r in rawsrc.read_raw(spark, path).collect())
    assert got == [("a", "2025-11-05"), ("b", "2025-11-05"), ("e", "2025-11-06")]
    plain = os.path.join(tmp, "plain")
    for _ in range(2):
        rawsrc.append_raw(some(["a"], TS), plain)
    assert rawsrc.read_raw(spark, plain).count() == 2
    with pytest.raises(ValueError):
        rawsrc.append_batch(some(["a", "b"], TS).withColumn("batch", F.get_json_object("payload", "$.name")), path)


def test_a_stream_that_fails_between_sinks_leaves_no_duplicates(spark, tmp):
    landing, a, b, zone, ck = (os.path.join(tmp, x) for x in ("landing", "a", "b", "zone", "ck"))
    os.makedirs(landing)

    def write(name, *names):
        with open(os.path.join(landing, name), "w") as f:
            f.write("".join(json.dumps({"name": n}) + "\n" for n in names))

    sinks = [rawsrc.Sink(a), rawsrc.Sink(b, fmt="json", partition_by=())]
    tries = []

    def handler(batch, epoch):
        tries.append(epoch)
        rawsrc.fan_out(batch, sinks[:1])
        ingest.land_batch(zone)(batch, epoch)
        if len(tries) in (1, 3):
            raise RuntimeError("the second sink is away")
        rawsrc.fan_out(batch, sinks[1:])

    for name, names in (("1.jsonl", ("A", "B")), ("2.jsonl", ("C",))):
        write(name, *names)
        with pytest.raises(Exception):
            ingest.ingest_stream(spark, landing, ck, handler)
        ingest.ingest_stream(spark, landing, ck, handler)
    assert tries == [0, 0, 1, 1]
    for got in (spark.read.parquet(a), spark.read.json(b), rawsrc.read_raw(spark, zone)):
        assert sorted(json.loads(r.payload)["name"] for r in got.collect()) == ["A", "B", "C"]
    # Another progress folder is another feed: it adds, and takes nothing away.
    ingest.ingest_stream(spark, landing, os.path.join(tmp, "ck2"), ingest.land_batch(zone))
    assert rawsrc.read_raw(spark, zone).count() == 6


def test_names_lose_any_white_space(spark, tmp):
    p = os.path.join(tmp, "names.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("\tTin Cup \n\t\n   Oak Stool \n\x1c\n")
    assert [r.name for r in rawsrc.read_names(spark, p).collect()] == ["Tin Cup", "Oak Stool"]
