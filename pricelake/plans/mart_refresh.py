"""The marts job: recompute marts from the ODS tables and merge them in.

``days`` limits the recomputation to some UTC days (the days a load
touched); the marts are keyed by day, so recomputing a day and upserting it
is the same as recomputing everything — late snapshots simply replace their
day's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.operators import marts, merge
from pricelake.plans.ods import Ods

MART_NAMES = ("sales_history", "group_analytics", "order_books", "arbitrage", "volatility")
_UPSERT = {"sales_history", "group_analytics", "volatility"}


def _only_days(df: DataFrame | None, days: Sequence | None) -> DataFrame | None:
    """Rows of the given UTC days. Day-partitioned ODS tables are filtered on
    their ``day`` partition column, so only those days' files are read."""
    if df is None or days is None:
        return df
    col = F.col("day") if "day" in df.columns else F.to_date("date_extracted")
    return df.filter(col.isin(list(days)))


def mart_rows(
    ods: Ods,
    days: Sequence | None = None,
    rules=marts.DEFAULT_GROUP_RULES,
    market_a: str = "market_a",
    market_b: str = "market_b",
) -> dict[str, DataFrame]:
    """The rows each mart receives in this run."""
    hist = _only_days(ods.history, days)
    out: dict[str, DataFrame] = {}
    if hist is not None:
        out |= marts.history_marts(hist, ods.product, rules)
    a, b = _only_days(ods.book_a, days), _only_days(ods.book_b, days)
    if a is not None and b is not None:
        joined = marts.joined_books(a, b, ods.product)
        out["order_books"] = marts.order_books(joined)
        out["arbitrage"] = marts.arbitrage(joined, market_a, market_b)
    return out


def refresh_marts(existing: dict[str, DataFrame | None], rows: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """New mart contents: upsert for the daily marts, insert-ignore for the
    two book marts (keyed by the full timestamp, so history accumulates)."""
    out = {}
    for name, new in rows.items():
        cur = existing.get(name)
        keys = marts.MART_KEYS[name]
        if cur is None:
            out[name] = new
        elif name in _UPSERT:
            out[name] = merge.upsert(cur.select(*new.columns), new, keys)
        else:
            out[name] = merge.insert_ignore(cur.select(*new.columns), new, keys)
    return out


# ---------------------------------------------------------------- path runner

def run_marts(
    spark,
    ods_root: str,
    marts_root: str,
    days: Sequence | None = None,
    rules=marts.DEFAULT_GROUP_RULES,
    market_a: str = "market_a",
    market_b: str = "market_b",
) -> list[str]:
    """Recompute the marts (all days, or ``days``) and merge them into
    day-partitioned tables under ``marts_root``; returns the marts written.

    Only the days present in the new rows are rewritten. What several marts
    share is computed once and stored in the shared checkpoint folder until all
    are written: the last snapshot per product and day (the only shuffle of the
    history), the last per name and day, and the joined books.
    """
    from pricelake.plans.ods import read_ods
    from pricelake.sources import tables

    ods = read_ods(spark, ods_root)
    hist = _only_days(ods.history, days)
    a, b = _only_days(ods.book_a, days), _only_days(ods.book_b, days)
    rows: dict[str, DataFrame] = {}
    written = []
    with tables.scratch(spark) as store:
        if hist is not None:
            rows |= marts.history_marts(hist.select(*marts.HISTORY_COLUMNS), ods.product, rules, store=store)
        if a is not None and b is not None:
            joined = store(marts.joined_books(a, b, ods.product))
            rows["order_books"] = marts.order_books(joined)
            rows["arbitrage"] = marts.arbitrage(joined, market_a, market_b)
        for name, new in rows.items():
            keys = marts.MART_KEYS[name]
            op = ((lambda t, s, k=keys: merge.upsert(t, s, k)) if name in _UPSERT
                  else (lambda t, s, k=keys: merge.insert_ignore(t, s, k)))
            with_day = new.withColumn("day", F.to_date("date_extracted"))
            tables.merge_partitions(spark, f"{marts_root.rstrip('/')}/{name}", with_day, "day", op)
            written.append(name)
    return written
