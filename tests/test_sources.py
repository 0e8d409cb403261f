import datetime as dt
import os

from pricelake.operators.filters import request_filter
from pricelake.sources import pages as pg
from pricelake.sources import raw as rawsrc
from pricelake.sources import trades


def test_read_names_and_ids(spark, tmp):
    n = os.path.join(tmp, "names.txt")
    with open(n, "w") as f:
        f.write("  Copper Kettle, dented  \n\n★ Lamp\n   \n")
    assert [r.name for r in rawsrc.read_names(spark, n).collect()] == ["Copper Kettle, dented", "★ Lamp"]
    y = os.path.join(tmp, "ids.yaml")
    with open(y, "w") as f:
        f.write("id:\n" + "".join(f"  - {i}\n" for i in (9, 4, 7, 1)))
    assert [r.id for r in rawsrc.read_ids(spark, y, 3).collect()] == [9, 4, 7]
    assert rawsrc.read_ids(spark, y).count() == 4


def test_explode_trades(spark):
    df = spark.createDataFrame([
        ("A", '{"prices": [["Mar 05 2024 23: +0", "8.10", 4], ["Mar 06 2024 01: +3", "1", "2"], ["Mar 06 2024 21: -5", "2", "1"], ["soon", "3", "1"]]}'),
        ("B", '{"prices": []}'), ("C", "{}"),
    ], "market_hash_name string, payload string")
    out = trades.explode_trades(df, currency="3").collect()
    assert len(out) == 4
    r = out[0]
    assert (r.name, r.price, r.amount, r.source, r.currency, r.app_id) == ("A", 8.1, 4, "steam_pricehistory", "3", 730)
    assert r.ts == dt.datetime(2024, 3, 5, 23) and r.ts_text == "Mar 05 2024 23: +0"
    assert [x.ts for x in out[1:]] == [dt.datetime(2024, 3, 5, 22), dt.datetime(2024, 3, 7, 2), None]


def test_meta_both_orders(spark):
    html = [
        ('<meta property="og:image" content="http://i/1.png">', "a", "u"),
        ("<META content='http://i/2.png' property='og:image' />", "b", "u"),
        ('<meta property="og:image">', "c", "u"),
        ('<meta property="og:image" content="http://i/4.png">', None, "u"),
        ('<meta property="og:image" content="http://i/5.png">', "", "u"),
        ('<meta property="og:image" content="http://i/6.png">', "f", ""),
        ('<meta property="og:title" content="x">', "e", "u"),
        ('<meta property="og:image" content="http://i/7?a=1&amp;b=it\'s"><meta property="og:image" content="no">', "g", "u"),
        ("<meta content=http://i/8.png property=og:image>", "h", "u"),
    ]
    df = spark.createDataFrame(html, "html string, name string, url string")
    got = sorted((r.name, r.image_url) for r in pg.extract_meta(df).collect())
    assert got == [("a", "http://i/1.png"), ("b", "http://i/2.png"), ("g", "http://i/7?a=1&b=it's"), ("h", "http://i/8.png")]
    assert pg.extract_meta(df, limit=1).count() == 1
    stamped = pg.extract_meta(df, extracted_at="2025-11-05 10:00:00").first()
    assert stamped.extracted_at == dt.datetime(2025, 11, 5, 10)


def test_names_from_url(spark):
    url = "https://shop.example.org/find?page=2&market_hash_name=Tin+Cup+%28large%29%2C+Oak+%26+Ash+Stool"
    df = spark.createDataFrame([(url,)], "u string")
    got = [r.name for r in pg.names_from_url(df, "u").collect()]
    assert got == ["Tin Cup (large)", "Oak & Ash Stool"]


def test_request_filter(spark):
    df = spark.createDataFrame([("a", True), ("b", False), ("c", None), ("d", True)], "market_hash_name string, t boolean")
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    assert [r[0] for r in request_filter(df, "t", names).collect()] == ["a"]


def test_cheapest_listings(spark):
    from pricelake.operators.listings import cheapest_listings

    rows = [(i, float(100 - i), 0, "2025-11-05T00:00:00Z", f"n{i % 3}", i % 3) for i in range(30)]
    listings = spark.createDataFrame(rows, "id int, price double, sticker_counter int, created_at string, "
                                           "name string, skin_id int")
    ids = spark.createDataFrame([(0,), (2,), (7,)], "id int")
    out = cheapest_listings(listings, ids, n=3)
    assert out.columns == ["id", "price", "sticker_counter", "created_at", "market_hash_name", "skin_id"]
    got = sorted((r.skin_id, r.id) for r in out.collect())
    assert got == [(0, 21), (0, 24), (0, 27), (2, 23), (2, 26), (2, 29)]


def test_load_raw_suffix_filter(spark, tmp):
    d = os.path.join(tmp, "in")
    os.makedirs(d)
    for name, body in (("a.json", '[{"name": "x"}]'), ("b.tmp", '[{"name": "y"}]')):
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    assert rawsrc.load_raw(spark, d, "2025-11-05 10:00:00", suffix=".json").count() == 1
    assert rawsrc.load_raw(spark, d, "2025-11-05 10:00:00").count() == 2


def test_item_images(spark):
    items = spark.createDataFrame([("A", "u1"), ("B", "u2"), ("C", None), (None, "u1")],
                                  "market_hash_name string, item_page string")
    pages = spark.createDataFrame([("u1", '<meta property="og:image" content="http://i/a.png">'),
                                   ("u1", '<meta property="og:image" content="http://i/b.png">'),
                                   ("u2", "<html></html>")], "url string, html string")
    got = [(r.name, r.image_url, r.source) for r in pg.item_images(items, pages).collect()]
    assert got == [("A", "http://i/a.png", "og_image")]


def test_json_lines_lose_no_line(spark, tmp):
    """Array lines are unpacked; a broken line fails the load, or is set aside by a lenient one."""
    import pytest

    path = os.path.join(tmp, "in.jsonl")
    with open(path, "w") as f:
        f.write('{"a": 1}\n\n[{"a": 2}, {"a": 3}]\n{"a": \n[]\n')
    with pytest.raises(Exception):
        rawsrc.load_raw(spark, path, "2025-01-02 03:04:05", json_lines=True).collect()
    got = rawsrc.load_raw(spark, path, "2025-01-02 03:04:05", json_lines=True, lenient=True).collect()
    assert sorted(r.payload.replace(" ", "") for r in got) == ['{"a":1}', '{"a":2}', '{"a":3}']
    assert [r.value.strip() for r in rawsrc.load_rejected(spark, path, json_lines=True).collect()] == ['{"a":']


def test_later_file_wins_whatever_the_sizes(spark, tmp):
    """The last row of a load wins by file path and place, not by which file Spark reads first."""
    for big in ("1_first", "2_second"):
        d = os.path.join(tmp, big)
        os.makedirs(d)
        for name in ("1_first", "2_second"):
            filler = [f'{{"k": "f{i}", "v": "{"x" * 50}"}}' for i in range(2000 if name == big else 1)]
            with open(os.path.join(d, f"{name}.jsonl"), "w") as f:
                f.write("\n".join([*filler, f'{{"k": "same", "v": "{name}"}}']) + "\n")
        for lines in (True, False):
            if not lines:
                for name in ("1_first", "2_second"):
                    p = os.path.join(d, f"{name}.jsonl")
                    body = ",".join(x for x in open(p).read().split("\n") if x)
                    with open(p, "w") as f:
                        f.write(f"[{body}]")
            got = rawsrc.load_raw(spark, d, "2025-01-02 03:04:05", json_lines=lines)
            last = got.filter("payload like '%same%'").orderBy("load_pos").collect()
            assert ["1_first" in last[0].payload, "2_second" in last[1].payload] == [True, True]
        ids = os.path.join(tmp, f"ids_{big}")
        os.makedirs(ids)
        for name, first in (("1_first", 1), ("2_second", 100_001)):
            with open(os.path.join(ids, name), "w") as f:
                f.write("".join(f"{first + i}\n" for i in range(5000 if name == big else 3)))
        assert [r.id for r in rawsrc.read_ids(spark, ids, 2).collect()] == [1, 2]
