"""The quality suite over the ODS tables (names as produced by ``plans.ods``)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.operators import quality as qc
from pricelake.operators.staging import BOOK_A_PRICES, PERIODS
from pricelake.plans.ods import ODS_KEYS, Ods


def _days_only(df: DataFrame | None, days) -> DataFrame | None:
    """Rows of the given UTC days; on a day-partitioned table this prunes."""
    if df is None or days is None:
        return df
    col = F.col("day") if "day" in df.columns else F.to_date("date_extracted")
    return df.filter(col.isin(list(days)))


def ods_check_parts(ods: Ods, as_of_ts, days=None) -> list[DataFrame]:
    """``(check, row)`` violation rows of every ODS check; one scan per table
    for the row-level checks. A check is named ``<table>.<what is wrong>``.

    ``days`` limits the book and history checks to those UTC days (the days a
    load touched). Keys include the timestamp, so a duplicate can only occur
    within one day; the catalog is always checked whole.
    """
    ods = Ods(ods.product, _days_only(ods.book_a, days), _days_only(ods.history, days),
              _days_only(ods.book_b, days))
    parts: list[DataFrame] = []
    p = ods.product
    if p is not None:
        parts.append(qc.row_checks(p, {
            "product.key_null": qc.any_null(["id_name", "name"]),
            "product.key_wrong": qc.key_mismatch("id_name", "name"),
        }, ["id_name", "name"]))
        parts.append(qc.as_check("product.name_split", qc.one_to_many(p)))
    if ods.book_a is not None:
        a = ods.book_a
        parts.append(qc.row_checks(a, {
            "book_a.key_null": qc.any_null(ODS_KEYS),
            "book_a.price": qc.invalid_prices(list(BOOK_A_PRICES), "min_price", "max_price"),
            "book_a.ahead_of_time": qc.future_time("date_extracted", as_of_ts),
        }, ODS_KEYS))
        parts.append(qc.as_check("book_a.twice", qc.duplicates(a, ODS_KEYS)))
        if p is not None:
            parts.append(qc.as_check("book_a.unknown_product", qc.orphans(a, p, "id_name", show=ODS_KEYS)))
    if ods.history is not None:
        h = ods.history
        preds = {f"history.order.{pr}": qc.period_invariants(pr) for pr in PERIODS}
        preds["history.volume"] = qc.negative_values([f"{pr}_volume" for pr in PERIODS])
        preds["history.ahead_of_time"] = qc.future_time("date_extracted", as_of_ts)
        parts.append(qc.row_checks(h, preds, ODS_KEYS))
        parts.append(qc.as_check("history.twice", qc.duplicates(h, ODS_KEYS)))
        if p is not None:
            parts.append(qc.as_check("history.unknown_product", qc.orphans(h, p, "id_name", show=ODS_KEYS)))
    if ods.book_b is not None:
        b = ods.book_b
        parts.append(qc.row_checks(b, {
            "book_b.price": qc.invalid_prices(["price"]),
            "book_b.ahead_of_time": qc.future_time("date_extracted", as_of_ts),
        }, ODS_KEYS))
        parts.append(qc.as_check("book_b.twice", qc.duplicates(b, ODS_KEYS)))
        if p is not None:
            parts.append(qc.as_check("book_b.unknown_product", qc.orphans(b, p, "id_name", show=ODS_KEYS)))
    return parts


def ods_report(ods: Ods, as_of_ts, days=None) -> DataFrame:
    return qc.suite_report(ods_check_parts(ods, as_of_ts, days))


#: What the summaries count NULLs of: output name -> column, by table.
PROFILED: dict[str, dict[str, str]] = {
    "product": {},
    "book_a": {"null_min": "min_price", "null_max": "max_price", "null_mean": "mean_price", "null_median": "median_price"},
    "history": {"null_24h_avg": "last_24_hours_avg", "null_7d_avg": "last_7_days_avg",
                "null_30d_avg": "last_30_days_avg", "null_90d_avg": "last_90_days_avg"},
    "book_b": {"null_price": "price"},
}


def ods_summaries(ods: Ods) -> dict[str, DataFrame]:
    """Row totals and NULL profiles per table (one aggregate each)."""
    present = {name: getattr(ods, name) for name in PROFILED}
    return {name: qc.null_profile(df, PROFILED[name]) for name, df in present.items() if df is not None}


def kept_summaries(spark, ods_root: str, days=None) -> dict[str, DataFrame]:
    """The summaries from profiles that are kept by day under ``<ods_root>/profiles``.

    Only ``days`` (the days a load touched) are counted again, and days that have no profile yet;
    a table's summary adds up its days. The first run counts all days. The catalog, which has no days, is counted whole.
    """
    from pricelake.plans.ods import read_ods
    from pricelake.sources import tables

    ods = read_ods(spark, ods_root)
    out: dict[str, DataFrame] = {}
    if ods.product is not None:
        out["product"] = qc.null_profile(ods.product, PROFILED["product"])
    for name in ("book_a", "history", "book_b"):
        df = getattr(ods, name)
        if df is None:
            continue
        path = f"{ods_root.rstrip('/')}/profiles/{name}"
        shape = qc.daily_profile(df, PROFILED[name]).schema
        tables.recover(spark, path)
        if tables.path_exists(spark, path):
            known = {r[0] for r in spark.read.schema(shape).parquet(path).select("day").distinct().collect()}
            stale = (tables.partition_days(spark, f"{ods_root.rstrip('/')}/{name}", "day") - known) | set(map(_date, days or ()))
            df = df.filter(F.col("day").isin(list(stale))) if stale else None
        if df is not None:
            tables.swap_in(spark, path, qc.daily_profile(df, PROFILED[name]).coalesce(1), "day")
        out[name] = qc.merged_profile(spark.read.schema(shape).parquet(path))
    return out


def _date(day) -> _dt.date:
    return day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day)[:10])


def collected_summaries(ods: Ods) -> dict[str, dict]:
    """The summaries as plain values: one row per table reaches the driver."""
    return {name: df.first().asDict() for name, df in ods_summaries(ods).items()}


def audit_ods_root(spark, ods_root: str, as_of_ts, days=None) -> tuple[list[dict], dict[str, dict]]:
    """(failing checks, summaries) of one run on the ODS tables under ``ods_root``; raises for neither.

    With ``days``, checks read these days only and the summaries come from kept profiles (``kept_summaries``)."""
    from pricelake.plans.ods import read_ods

    report = ods_report(read_ods(spark, ods_root), as_of_ts, days)
    found = [r.asDict() for r in report.orderBy("check").collect()]
    return found, {name: df.first().asDict() for name, df in kept_summaries(spark, ods_root, days).items()}


def run_checks(ods: Ods, as_of_ts, days=None) -> dict[str, dict]:
    """The summaries of every table; raises once, listing every failing check
    (with the summaries on the error). Bounded samples only reach the driver."""
    summaries = collected_summaries(ods)
    qc.assert_clean(ods_report(ods, as_of_ts, days), summaries)
    return summaries


def check_ods_root(spark, ods_root: str, as_of_ts, fail: bool = True, days=None) -> DataFrame:
    """Run the suite on the ODS tables under ``ods_root`` (only ``days``, when
    given); with ``fail``, raise once listing every failing check. Returns the report."""
    from pricelake.plans.ods import read_ods

    ods = read_ods(spark, ods_root)
    report = ods_report(ods, as_of_ts, days)
    if fail:
        qc.assert_clean(report, collected_summaries(ods))
    return report
