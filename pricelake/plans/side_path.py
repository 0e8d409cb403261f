"""The catalog's side path on paths: catalog, period statistics, trades and images, published together.

One run takes a load of items, optionally of aggregated history, the price
histories of the listed names and the stored item pages, and makes the four
tables current at once (``sources.tables.TableSet``):

* ``items``       upsert on (name, currency); image links of the catalog stay
* ``sales_agg``   upsert on (name, currency, period)
* ``trades``      rows of the listed names' price histories, appended
* ``images``      one row per item page with an image, appended

Trades and images carry the ``run`` they came with; running a run again
replaces its rows, so a retry adds nothing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.catalog import load_catalog, parse_items
from pricelake.operators.filters import request_filter
from pricelake.sources import pages as pg
from pricelake.sources import raw as rawsrc
from pricelake.sources import tables, trades

TABLES = ("items", "sales_agg", "trades", "images")


def _appended(current: DataFrame | None, fresh: DataFrame, run: str) -> DataFrame:
    """``current`` with the run's rows in the place of those an earlier try of it left."""
    fresh = fresh.withColumn("run", F.lit(run))
    return fresh if current is None else current.filter(F.col("run") != run).unionByName(fresh)


def listed_histories(histories: DataFrame, names: DataFrame, name_col: str = "market_hash_name") -> DataFrame:
    """The price histories (name, payload) of the names on the list."""
    return request_filter(histories, names=names, name_col=name_col)


def side_path_tables(
    current: dict[str, DataFrame | None],
    run: str,
    items_raw: DataFrame | None = None,
    history_raw: DataFrame | None = None,
    histories: DataFrame | None = None,
    names: DataFrame | None = None,
    pages: DataFrame | None = None,
    extracted_at: _dt.datetime | str | None = None,
    image_limit: int | None = 200,
) -> dict[str, DataFrame]:
    """New content of every table that the run's inputs change (DataFrames only).

    Trades need ``histories`` and ``names``, images ``items_raw`` and
    ``pages``. ``image_limit`` is a run's quota of images.
    """
    out: dict[str, DataFrame] = {}
    if items_raw is not None:
        items, agg = load_catalog(items_raw, current.get("items"), history_raw, current.get("sales_agg"), extracted_at)
        out["items"] = items
        if agg is not None:
            out["sales_agg"] = agg
    if histories is not None:
        if names is None:
            raise ValueError("a list of names is required with price histories")
        out["trades"] = _appended(current.get("trades"), trades.explode_trades(listed_histories(histories, names)), run)
    if items_raw is not None and pages is not None:
        found = pg.item_images(parse_items(items_raw), pages, limit=image_limit, extracted_at=extracted_at)
        out["images"] = _appended(current.get("images"), found, run)
    return out


def run_side_path(
    spark: SparkSession,
    root: str,
    run: str,
    items_path: str | None = None,
    history_path: str | None = None,
    histories: DataFrame | None = None,
    names_path: str | None = None,
    pages: DataFrame | None = None,
    extracted_at: _dt.datetime | str | None = None,
    image_limit: int | None = 200,
) -> dict[str, int]:
    """Load the run's files and publish the tables under ``root`` together; returns the current versions.

    ``items_path`` and ``history_path`` hold JSON documents, ``names_path``
    a name a line. A failure at any point leaves the tables of the run before current, all of them.
    """
    published = tables.TableSet(spark, root)
    stamp = extracted_at or "1970-01-01 00:00:00"

    def load(path: str | None) -> DataFrame | None:
        return None if path is None else rawsrc.load_raw(spark, path, stamp)

    current = {name: published.read(name) for name in TABLES}
    fresh = side_path_tables(
        current, run, load(items_path), load(history_path), histories,
        None if names_path is None else rawsrc.read_names(spark, names_path), pages, extracted_at, image_limit)
    published.publish(fresh)
    return published.versions()
