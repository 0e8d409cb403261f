"""Cheapest listings per listed id (the listing request, re-aimed at a table).

For every id in an id list, keep the ``n`` cheapest listings (price ascending,
listing id as tie-break), project the stored fields and carry the listing's
``name`` as ``market_hash_name`` on every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.operators.latest import top_n_per_key

# The listing fields kept, and how many listings per id.
LISTING_FIELDS = ("id", "price", "sticker_counter", "created_at", "name", "skin_id")
LISTINGS_PER_ID = 100


def cheapest_listings(
    listings: DataFrame,
    ids: DataFrame,
    n: int = LISTINGS_PER_ID,
    id_col: str = "id",
    key: str = "skin_id",
) -> DataFrame:
    """``n`` cheapest listings of each id in ``ids`` (a semi join, then a
    per-key top-n with a map-side partial limit)."""
    top = top_n_per_key(listings, key, [F.col("price").asc_nulls_last(), F.col("id")], n, ids=ids, id_col=id_col)
    return top.select(*[F.col(c).alias("market_hash_name") if c == "name" else F.col(c) for c in LISTING_FIELDS])
