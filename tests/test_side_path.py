"""Catalog, statistics, trades and images from files to four tables that become current together."""

import datetime as dt
import json
import os

import pytest

from pricelake.plans.side_path import TABLES, run_side_path
from pricelake.sources import tables

from conftest import rows


def _dump(path, value):
    with open(path, "w", encoding="utf-8") as f:
        f.write(value if isinstance(value, str) else json.dumps(value))
    return path


def _inputs(spark, tmp, price):
    names = _dump(os.path.join(tmp, "names.txt"), "\tTin Cup\nOak Stool\n")
    items = _dump(os.path.join(tmp, "items.json"), [
        {"market_hash_name": "Tin Cup", "currency": "EUR", "suggested_price": price, "item_page": "u1", "image_url": "seen"},
        {"market_hash_name": "Rug", "currency": "EUR", "suggested_price": 2, "item_page": "u2"}])
    history = _dump(os.path.join(tmp, "history.json"), [
        {"market_hash_name": "Tin Cup", "currency": "EUR", "last_7_days": {"min": price, "volume": 3}}])
    histories = spark.createDataFrame([
        ("Tin Cup", json.dumps({"prices": [["Mar 05 2024 23: +0", str(price), 4], ["Mar 06 2024 01: +0", "1", "2"]]})),
        ("Rug", json.dumps({"prices": [["Mar 05 2024 23: +0", "9", 1]]})), ("Oak Stool", "{}")], "market_hash_name string, payload string")
    pages = spark.createDataFrame([("u1", '<!-- <meta property="og:image" content="old"> --><meta property="og:image" content="i1">'),
                                   ("u2", "<html></html>")], "url string, html string")
    return dict(items_path=items, history_path=history, names_path=names, histories=histories, pages=pages,
                extracted_at=dt.datetime(2025, 11, 5, 10))


def test_one_run_fills_all_four_tables_and_a_retry_adds_nothing(spark, tmp):
    root = os.path.join(tmp, "side")
    for _ in range(2):
        versions = run_side_path(spark, root, "run-1", **_inputs(spark, tmp, 5))
    assert versions == {name: 2 for name in TABLES}
    got = tables.TableSet(spark, root)
    assert [(r.name, r.price, r.amount, r.run) for r in got.read("trades").orderBy("ts").collect()] == [
        ("Tin Cup", 5.0, 4, "run-1"), ("Tin Cup", 1.0, 2, "run-1")]
    assert [(r.name, r.image_url, r.run) for r in got.read("images").collect()] == [("Tin Cup", "i1", "run-1")]
    assert got.read("sales_agg").count() == 4 and got.read("items").count() == 2
    run_side_path(spark, root, "run-2", **_inputs(spark, tmp, 6))
    assert got.read("trades").count() == 4 and got.read("images").count() == 2
    assert {r.market_hash_name: r.suggested_price for r in got.read("items").collect()} == {"Tin Cup": 6.0, "Rug": 2.0}
    # A run that brings the catalog alone leaves the other tables where they were.
    only = run_side_path(spark, root, "run-3", items_path=os.path.join(tmp, "items.json"))
    assert only["items"] == 4 and {only[t] for t in TABLES if t != "items"} == {3}


def test_a_failure_between_two_tables_leaves_the_old_set_current(spark, tmp, monkeypatch):
    root = os.path.join(tmp, "side")
    run_side_path(spark, root, "run-1", **_inputs(spark, tmp, 5))
    published = tables.TableSet(spark, root)
    before = {name: rows(published.read(name)) for name in TABLES}
    bad = _inputs(spark, tmp, 7)
    bad["histories"] = spark.createDataFrame([("Tin Cup", json.dumps({"prices": [["x", "no number", 1]]}))], "market_hash_name string, payload string")
    with pytest.raises(Exception):  # items and statistics are written, then the trades fail
        run_side_path(spark, root, "run-2", **bad)
    assert os.path.isdir(os.path.join(root, "items", "v=000002")) and published.versions() == {name: 1 for name in TABLES}
    assert {name: rows(published.read(name)) for name in TABLES} == before
    monkeypatch.setattr(tables.TableSet, "_write_marker", lambda *a: (_ for _ in ()).throw(RuntimeError("lost before the marker")))
    with pytest.raises(RuntimeError):
        run_side_path(spark, root, "run-2", **_inputs(spark, tmp, 7))
    assert {name: rows(published.read(name)) for name in TABLES} == before
    monkeypatch.undo()
    assert run_side_path(spark, root, "run-2", **_inputs(spark, tmp, 7)) == {name: 4 for name in TABLES}
    assert published.read("trades").count() == 4


def test_old_publications_go(spark, tmp):
    published = tables.TableSet(spark, os.path.join(tmp, "s"), keep=2)
    for i in range(4):
        published.publish({"a": spark.range(i + 1)} if i else {"a": spark.range(1), "b": spark.range(9)})
    assert published.versions() == {"a": 4, "b": 1} and published.read("a").count() == 4 and published.read("b").count() == 9
    assert sorted(os.listdir(os.path.join(tmp, "s", "a"))) == ["v=000003", "v=000004"]
    assert published.read("none") is None and tables.TableSet(spark, os.path.join(tmp, "new")).versions() == {}
