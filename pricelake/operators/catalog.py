"""Product catalog and the item/statistics catalog loader.

``build_product``: names from every raw source of the day -> one row per
name with its key; insert-ignore into the existing catalog (first writer of a
key wins, later loads never rename a product).

``load_catalog``: the side-path loader — items upserted on (name, currency)
keeping an already extracted image link; period statistics unpivoted and
upserted on (name, currency, period) keeping page links and extraction time.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions.json_fields import payload_struct, string_struct
from pricelake.functions.keys import usable_name, uuid5
from pricelake.operators import merge
from pricelake.operators.staging import PERIOD_STATS, PERIODS, for_day, product_rows, unpivot_periods

PRODUCT_COLUMNS = ("id_name", "name", "item_page", "market_page")


def catalog_candidates(names: DataFrame) -> DataFrame:
    """``(name, item_page, market_page)`` rows -> one row per usable name.

    Among a name's rows the one with page links wins (non-NULL first, then the
    smallest text). Grouping is by *name* and the key is derived after the
    aggregate, so the hash runs once per distinct name; the aggregate is
    partial on the map side, so a name seen in a third of all rows still
    shuffles one row per task.
    """
    pick = F.min(F.struct(
        F.col("item_page").isNull().alias("n1"), F.col("item_page").alias("item_page"),
        F.col("market_page").isNull().alias("n2"), F.col("market_page").alias("market_page"),
    )).alias("best")
    per_name = names.filter(usable_name("name")).groupBy("name").agg(pick)
    return per_name.select(
        uuid5("name").alias("id_name"), "name",
        F.col("best.item_page").alias("item_page"), F.col("best.market_page").alias("market_page"),
    )


def build_product(
    raws: Sequence[DataFrame | None],
    existing: DataFrame | None = None,
    as_of: _dt.date | str | None = None,
) -> DataFrame:
    """Catalog after loading the day ``as_of`` of every raw source.

    Missing sources (None) count as empty. ``existing=None`` means an empty catalog.
    """
    parts = [product_rows(for_day(r, as_of) if as_of is not None else r) for r in raws if r is not None]
    if not parts:
        raise ValueError("no raw source given")
    fresh = catalog_candidates(reduce(DataFrame.unionByName, parts))
    if existing is None:
        return fresh
    return merge.insert_ignore(existing.select(*PRODUCT_COLUMNS), fresh, ["id_name"])


# The item fields the catalog loader stores, and the one column a
# conflict leaves as it was (filled later by the page extractor).
ITEM_FIELDS = (
    "market_hash_name", "currency", "suggested_price", "item_page", "market_page",
    "min_price", "max_price", "mean_price", "median_price", "quantity", "created_at", "updated_at",
    "image_url",
)
ITEM_KEYS = ("market_hash_name", "currency")
ITEM_PRESERVED = ("image_url",)
AGG_KEYS = ("market_hash_name", "currency", "period")

_ITEM_TYPES = {
    "suggested_price": "double", "min_price": "double", "max_price": "double", "mean_price": "double",
    "median_price": "double", "quantity": "bigint", "created_at": "bigint", "updated_at": "bigint",
}


def parse_items(raw: DataFrame) -> DataFrame:
    """Item payloads -> typed item rows, plus ``load_pos`` (later wins).

    The catalog loader never rejects a load over one odd value: text that is
    not a number becomes NULL (``try_cast``).
    """
    p = F.col("p")
    parsed = raw.select(payload_struct(raw.columns, string_struct(list(ITEM_FIELDS))).alias("p"), "load_pos")
    return parsed.select(
        *[p[f].try_cast(_ITEM_TYPES[f]).alias(f) if f in _ITEM_TYPES else p[f].alias(f) for f in ITEM_FIELDS],
        "load_pos",
    )


def parse_period_stats(raw: DataFrame) -> DataFrame:
    """History payloads -> wide rows ``(market_hash_name, currency, item_page,
    market_page, <period>_<stat>..., load_pos)``."""
    schema = string_struct(["market_hash_name", "currency", "item_page", "market_page",
                            *[(pr, list(PERIOD_STATS)) for pr in PERIODS]])
    p = F.col("p")
    parsed = raw.select(payload_struct(raw.columns, schema).alias("p"), "load_pos")
    stats = [
        p[pr][s].try_cast("bigint" if s == "volume" else "double").alias(f"{pr}_{s}")
        for pr in PERIODS for s in PERIOD_STATS
    ]
    return parsed.select(p["market_hash_name"].alias("market_hash_name"), p["currency"].alias("currency"),
                         p["item_page"].alias("item_page"), p["market_page"].alias("market_page"),
                         *stats, "load_pos")


def load_catalog(
    items_raw: DataFrame,
    catalog: DataFrame | None,
    history_raw: DataFrame | None = None,
    agg: DataFrame | None = None,
    extracted_at: _dt.datetime | str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Merge a load of items (and, if given, aggregated history) into the catalog.

    Within one load the *last* row of a key wins (rows apply in order). Returns
    ``(new_catalog, new_agg)``; ``new_agg`` is None when no history was given.
    History needs ``extracted_at``: a run's rows carry its time, not the clock's.
    """
    last_first = [F.col("load_pos").desc()]
    items = merge.dedup_source(parse_items(items_raw), list(ITEM_KEYS), last_first).drop("load_pos")
    if catalog is None:
        new_catalog = items
    else:
        update = [c for c in ITEM_FIELDS if c not in ITEM_KEYS and c not in ITEM_PRESERVED]
        new_catalog = merge.upsert(catalog.select(*ITEM_FIELDS), items, list(ITEM_KEYS), update_cols=update)
    if history_raw is None:
        return new_catalog, None
    if extracted_at is None:
        raise ValueError("extracted_at is required with history")
    wide = merge.dedup_source(parse_period_stats(history_raw), ["market_hash_name", "currency"], last_first)
    long = unpivot_periods(wide, ["market_hash_name", "currency", "item_page", "market_page"]).withColumn(
        "extracted_at",
        F.lit(extracted_at).cast("timestamp"),
    )
    if agg is None:
        return new_catalog, long
    return new_catalog, merge.upsert(agg.select(*long.columns), long, list(AGG_KEYS), update_cols=list(PERIOD_STATS))
