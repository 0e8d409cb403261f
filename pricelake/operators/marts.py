"""Marts over the ODS tables: sales history, group analytics, two-market
order books, arbitrage and volatility.

Inputs use the ODS column names (see ``pricelake.plans.schemas``):

* ``history``: ``id_name, date_extracted, last_<period>_<stat>...``
* ``book_a``: ``id_name, date_extracted, suggested_price, ...``
* ``book_b``: ``id_name, date_extracted, price``
* ``product``: ``id_name, name``

Each function returns the rows a run would write; merging them into an
existing mart (upsert or insert-ignore on the mart key) is done with
``pricelake.operators.merge`` by the caller or by ``pricelake.plans.marts``.

Ratios and averages are doubles computed from an exact decimal difference or
sum, so results do not depend on the order rows were added in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.operators.joins import join_dimension, maybe_broadcast
from pricelake.operators.latest import daily_latest, latest_per_key

# The default product-group rules, in priority order (the first
# rule whose case-insensitive pattern matches the name wins; no match drops
# the product from the group mart).
DEFAULT_GROUP_RULES: list[tuple[str, list[str]]] = [
    ("AK-47", ["%AK-47%"]),
    ("AWP", ["%AWP%"]),
    ("M4A4", ["%M4A4%"]),
    ("M4A1-S", ["%M4A1-S%"]),
    ("Desert Eagle", ["%Desert Eagle%"]),
    ("Knife", ["%Knife%", "%Karambit%", "%Bayonet%", "%Butterfly%"]),
    ("Gloves", ["%Gloves%", "%Hand Wraps%"]),
]

# Keys of each mart (the UNIQUE constraint a merge into it resolves on).
MART_KEYS = {
    "sales_history": ["item_name", "date_extracted"],
    "group_analytics": ["group_name", "date_extracted"],
    "order_books": ["item_name", "date_extracted"],
    "arbitrage": ["item_name", "date_extracted"],
    "volatility": ["item_name", "date_extracted"],
}

_DBL = T.DoubleType()


def _ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when den is 0 (callers guard the sign)."""
    return F.try_divide(num.cast(_DBL), den.cast(_DBL))


def classify(name: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Group label of ``name``: first rule with a matching ILIKE pattern, else NULL."""
    expr = None
    for label, patterns in rules:
        cond = None
        for p in patterns:
            c = name.ilike(p)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr if expr is not None else F.lit(None).cast("string")


def _product(product: DataFrame) -> DataFrame:
    return product.select("id_name", F.col("name").alias("item_name"))


#: What the marts take from a history snapshot.
HISTORY_COLUMNS = ("id_name", "date_extracted", "last_24_hours_avg", "last_24_hours_volume", "last_7_days_min",
                   "last_7_days_max", "last_7_days_avg", "last_7_days_volume")


def daily_history(history: DataFrame, tie_breaks: Sequence[Column] = ()) -> DataFrame:
    """Last snapshot per (id, day), with ``report_date``: what all three history marts start from."""
    return daily_latest(history, "id_name", "date_extracted", tie_breaks, day_col="report_date")


def by_name_day(per_id: DataFrame, product: DataFrame, tie_breaks: Sequence[Column] = ()) -> DataFrame:
    """Last snapshot per (product *name*, day) of ``daily_history`` rows, with ``item_name``."""
    joined = join_dimension(per_id, _product(product), "id_name")
    return latest_per_key(joined, ["item_name", "report_date"],
                          [F.col("date_extracted").desc(), *tie_breaks, F.col("id_name")])


def latest_by_name_day(
    history: DataFrame,
    product: DataFrame,
    tie_breaks: Sequence[Column] = (),
) -> DataFrame:
    """Last snapshot per (product *name*, day), with ``item_name`` and ``report_date``.

    Two-level top-1: first per (id, day) — a partial limit before the shuffle
    cuts every key, hot ones included, to one row per task — then the product
    join (broadcast when its size estimate allows) and a second top-1 per
    (name, day) over the already reduced rows. The history itself is
    shuffled once, on compact id keys, and never for the join.

    With a total order this equals one top-1 per (name, day): a group's
    overall winner is also the winner of its own id.
    """
    return by_name_day(daily_history(history, tie_breaks), product, tie_breaks)


def _sales(latest: DataFrame) -> DataFrame:
    return latest.select(
        "item_name",
        F.col("report_date").alias("date_extracted"),
        F.col("last_24_hours_avg").alias("avg_price_24h"),
        F.col("last_24_hours_volume").alias("volume_24h"),
    )


def sales_history(
    history: DataFrame,
    product: DataFrame,
    tie_breaks: Sequence[Column] = (),
) -> DataFrame:
    """Last snapshot per (product name, day): 24 h average price and volume."""
    return _sales(latest_by_name_day(history, product, tie_breaks))


def _groups(product: DataFrame, rules: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    return _product(product).select(
        "id_name", classify(F.col("item_name"), rules).alias("group_name")
    ).filter(F.col("group_name").isNotNull())


def _group_days(per_id: DataFrame, groups: DataFrame) -> DataFrame:
    return (
        join_dimension(per_id, groups, "id_name")
        .select("group_name", "report_date",
                F.col("last_24_hours_avg").alias("p"), F.col("last_24_hours_volume").alias("v"))
        .groupBy("group_name", F.col("report_date").alias("date_extracted"))
        .agg(
            _ratio(F.sum("p"), F.count("p")).alias("avg_price"),
            F.sum(F.col("v").cast("bigint")).alias("total_volume"),
        )
    )


def group_analytics(
    history: DataFrame,
    product: DataFrame,
    rules: Sequence[tuple[str, Sequence[str]]] = DEFAULT_GROUP_RULES,
    tie_breaks: Sequence[Column] = (),
) -> DataFrame:
    """Per (group, day): average 24 h price and total 24 h volume of the
    latest snapshot of each product in the group.

    Products are classified on the dimension side. A semi join on the grouped
    ids comes first (it changes no row, and only grouped products' history
    is shuffled), then keep-latest, then the join, so the result is
    the same whether or not Spark broadcasts the products. The
    group aggregate has few keys and huge groups; Spark's partial (map-side)
    aggregation makes its shuffle one row per group per task.
    """
    groups = _groups(product, rules)
    kept = history.join(maybe_broadcast(groups.select("id_name")), "id_name", "left_semi")
    return _group_days(daily_history(kept, tie_breaks), groups)


def history_marts(
    history: DataFrame,
    product: DataFrame,
    rules: Sequence[tuple[str, Sequence[str]]] = DEFAULT_GROUP_RULES,
    tie_breaks: Sequence[Column] = (),
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> dict[str, DataFrame]:
    """Sales history, group analytics and volatility from one pass over the history.

    The rows are those of the three functions. The history is read and
    shuffled once, for the last snapshot per (id, day); ``store`` keeps these (one
    row a product and day), so no mart goes back to the history, and the last
    snapshot per (name, day), which two marts share.
    """
    per_id = store(daily_history(history, tie_breaks))
    by_name = store(by_name_day(per_id, product, tie_breaks))
    return {"sales_history": _sales(by_name), "group_analytics": _group_days(per_id, _groups(product, rules)),
            "volatility": _volatility(by_name)}


def joined_books(
    book_a: DataFrame,
    book_b: DataFrame,
    product: DataFrame,
    tie_breaks_a: Sequence[Column] = (),
    tie_breaks_b: Sequence[Column] = (),
    scale_b: float | None = None,
) -> DataFrame:
    """Latest row per (product, day) on each side, joined on product *and* day.

    Prices are compared as they are (no unit or currency conversion);
    ``scale_b`` multiplies side B's price when the markets quote differently.

    Both dedup windows are partitioned by (id_name, day) and the join is on
    the same columns, so the two window shuffles also serve the join. The
    product join comes last (broadcast when small). Returns
    ``item_name, price_a, price_b, date_extracted`` (side A's time).
    """
    a = daily_latest(
        book_a.filter(F.col("date_extracted").isNotNull()), "id_name", "date_extracted", tie_breaks_a
    ).select("id_name", "day", F.col("suggested_price").alias("price_a"), "date_extracted")
    b = daily_latest(
        book_b.filter(F.col("date_extracted").isNotNull()), "id_name", "date_extracted", tie_breaks_b
    ).select("id_name", "day", (F.col("price") if scale_b is None
                                else F.col("price") * F.lit(scale_b)).alias("price_b"))
    ab = a.join(b, on=["id_name", "day"], how="inner")
    return join_dimension(ab, _product(product), "id_name").select(
        "item_name", "price_a", "price_b", "date_extracted"
    )


def order_books(joined: DataFrame) -> DataFrame:
    """Two-market order book: both prices and their difference (A - B)."""
    return joined.select(
        "item_name",
        "price_a",
        "price_b",
        (F.col("price_a") - F.col("price_b")).alias("price_diff"),
        "date_extracted",
    )


def arbitrage(joined: DataFrame, market_a: str = "market_a", market_b: str = "market_b") -> DataFrame:
    """Buy on the cheaper market, sell on the other; only non-zero gaps.

    ``profit_pct`` is the gap as a percent of the lower price, 0 when the
    lower price is not positive.
    """
    a, b = F.col("price_a"), F.col("price_b")
    gap = F.abs(a - b)
    low = F.least(a, b)
    a_cheaper = a < b
    return joined.filter(gap > 0).select(
        "item_name",
        F.when(a_cheaper, F.lit(market_a)).otherwise(F.lit(market_b)).alias("buy_platform"),
        F.when(a_cheaper, F.lit(market_b)).otherwise(F.lit(market_a)).alias("sell_platform"),
        gap.alias("profit_abs"),
        F.when(low > 0, _ratio(gap, low) * F.lit(100.0)).otherwise(F.lit(0.0)).alias("profit_pct"),
        "date_extracted",
    )


def _volatility(latest: DataFrame) -> DataFrame:
    spread = F.col("last_7_days_max") - F.col("last_7_days_min")
    avg = F.col("last_7_days_avg")
    return latest.select(
        "item_name",
        spread.alias("spread_7d"),
        F.when(avg > 0, _ratio(spread, avg)).otherwise(F.lit(0.0)).alias("volatility_index"),
        F.col("last_7_days_volume").alias("volume_7d"),
        F.col("report_date").alias("date_extracted"),
    )


def volatility(
    history: DataFrame,
    product: DataFrame,
    tie_breaks: Sequence[Column] = (),
) -> DataFrame:
    """Per (product name, day), from the latest snapshot: 7-day spread
    (max - min), spread over 7-day average (0 when the average is not
    positive or NULL) and 7-day volume."""
    return _volatility(latest_by_name_day(history, product, tie_breaks))


__all__ = [
    "DEFAULT_GROUP_RULES", "MART_KEYS", "classify", "HISTORY_COLUMNS", "daily_history", "by_name_day",
    "latest_by_name_day", "history_marts", "sales_history", "group_analytics",
    "joined_books", "order_books", "arbitrage", "volatility",
]
