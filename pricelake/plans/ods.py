"""The daily raw -> ODS job, as DataFrame operators plus a path-based runner.

For the UTC day ``as_of``:

1. catalog: names from every raw source of the day -> insert-ignore by key;
2. book A and history: stage once, keep the latest load per
   (key, time), upsert on (key, time) — the update-then-insert-new pair of
   the original job is one upsert here;
3. book B: the day's deduplicated listings replace the table (on paths: their day).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.operators import merge, staging
from pricelake.operators.catalog import PRODUCT_COLUMNS, catalog_candidates
from pricelake.plans.schemas import ODS as ODS_SCHEMAS
from pricelake.sources import raw as rawsrc
from pricelake.sources import tables

ODS_KEYS = ["id_name", "date_extracted"]


@dataclass
class Raw:
    items: DataFrame | None = None
    history: DataFrame | None = None
    listings: DataFrame | None = None
    out_of_stock: DataFrame | None = None


@dataclass
class Ods:
    product: DataFrame | None = None
    book_a: DataFrame | None = None
    history: DataFrame | None = None
    book_b: DataFrame | None = None


def _merge_or_new(target: DataFrame | None, fresh: DataFrame) -> DataFrame:
    return fresh if target is None else merge.upsert(target.select(*fresh.columns), fresh, ODS_KEYS)


_STAGERS = (("items", staging.stage_book_a), ("history", staging.stage_history), ("listings", staging.stage_book_b))


def staged_day(raw: Raw, as_of, persist: bool = False, lenient: bool = False) -> tuple[Ods, dict[str, DataFrame]]:
    """The day's deduplicated rows of each ODS table (nothing merged yet).

    Each raw source of the day is parsed once: its staged rows carry the name
    and page links too, and feed both the catalog candidates and the book.
    With ``persist`` the staged rows are kept (memory, spilling to disk) for
    the several writes that read them; the second result holds them by source, so the
    caller can read and release them. ``lenient`` turns unreadable numbers and times
    into NULL instead of failing the load, and lists them (``staging.rejected_fields``).
    """
    from pyspark import StorageLevel

    kept: dict[str, DataFrame] = {}
    staged: dict[str, DataFrame] = {}
    for kind, stager in _STAGERS:
        df = getattr(raw, kind)
        if df is None:
            continue
        rows = stager(staging.for_day(df, as_of), lenient=lenient, keep_catalog=True)
        if persist:
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
            kept[kind] = rows
        staged[kind] = rows
    names = [staging.catalog_part(r) for r in staged.values()]
    if raw.out_of_stock is not None:
        names.append(staging.product_rows(staging.for_day(raw.out_of_stock, as_of)))
    product = catalog_candidates(reduce(DataFrame.unionByName, names)) if names else None

    def dedup(kind):
        return staging.dedup_staged(staged[kind]) if kind in staged else None

    return Ods(product, dedup("items"), dedup("history"), dedup("listings")), kept


def ods_day(raw: Raw, ods: Ods, as_of, lenient: bool = False) -> Ods:
    """New content of every ODS table after loading ``as_of`` (DataFrames only)."""
    fresh, _ = staged_day(raw, as_of, lenient=lenient)
    if fresh.product is None:
        product = ods.product
    elif ods.product is None:
        product = fresh.product
    else:
        product = merge.insert_ignore(ods.product.select(*PRODUCT_COLUMNS), fresh.product, ["id_name"])
    book_a = ods.book_a if fresh.book_a is None else _merge_or_new(ods.book_a, fresh.book_a)
    history = ods.history if fresh.history is None else _merge_or_new(ods.history, fresh.history)
    book_b = ods.book_b if fresh.book_b is None else merge.replace(None, fresh.book_b)
    return Ods(product, book_a, history, book_b)


# ---------------------------------------------------------------- path runner

RAW_NAMES = ("items", "history", "listings", "out_of_stock")


def read_raw_zone(spark: SparkSession, raw_root: str) -> Raw:
    """Landed raw zones ``<raw_root>/<source>/ingest_date=.../``; missing sources are None."""
    found = {}
    for n in RAW_NAMES:
        p = f"{raw_root.rstrip('/')}/{n}"
        found[n] = rawsrc.read_raw(spark, p) if tables.path_exists(spark, p) else None
    return Raw(**found)


def add_to_catalog(spark: SparkSession, path: str, fresh: DataFrame) -> int | None:
    """Insert the names that the catalog lacks; without any, no new version is written."""
    table = tables.VersionedTable(spark, path)
    current = table.read()
    if current is None:
        return table.write(fresh)
    current = current.select(*PRODUCT_COLUMNS)
    if merge.new_rows(current, fresh, ["id_name"]).isEmpty():
        return table.current()
    return table.write(merge.insert_ignore(current, fresh, ["id_name"]))


def run_ods_day(
    spark: SparkSession, raw_root: str, ods_root: str, as_of: _dt.date | str, lenient: bool = False
) -> dict[str, int | None]:
    """Load day ``as_of`` from the raw zone into the ODS tables under ``ods_root``.

    The catalog is a versioned table (small; insert-ignored whole). The books
    and history are partitioned by ``day`` and only the days present in the
    load are rewritten: book A and history by upsert; of book B a load
    replaces its days, so a day holds the listings of its last load (a
    stream's batches, which bring a day bit by bit, upsert them instead).

    A ``lenient`` load files what it could not type under ``<ods_root>/rejects``
    (by day and source) and returns how much that was, by source: ``rejects.<source>``.
    """
    raw = read_raw_zone(spark, raw_root)
    fresh, kept = staged_day(raw, as_of, persist=True, lenient=lenient)
    root = ods_root.rstrip("/")
    out: dict[str, int | None] = {}
    try:
        if fresh.product is not None:
            out["product"] = add_to_catalog(spark, f"{root}/product", fresh.product)
        for name, rows in (("book_a", fresh.book_a), ("history", fresh.history)):
            if rows is None:
                out[name] = None
                continue
            tables.merge_partitions(spark, f"{root}/{name}", tables.with_day(rows), "day",
                                    lambda t, s: merge.upsert(t, s, ODS_KEYS), sort_within=ODS_KEYS)
            out[name] = 0
        if fresh.book_b is not None:
            tables.merge_partitions(spark, f"{root}/book_b", tables.with_day(fresh.book_b), "day",
                                    lambda t, s: s, sort_within=ODS_KEYS)
            out["book_b"] = 0
        if lenient:
            for kind, rows in kept.items():
                out[f"rejects.{kind}"] = write_rejects(spark, f"{root}/rejects", kind, as_of, rows)
    finally:
        for df in kept.values():
            df.unpersist()
    return out


def write_rejects(spark: SparkSession, path: str, kind: str, as_of: _dt.date | str, staged: DataFrame) -> int:
    """File the texts that a lenient load of one source and day could not type, in the place of an earlier run's; returns their number.

    ``path`` is partitioned by ``load_day`` and ``batch`` (the source). ``staged`` is
    kept by the caller, so counting and writing parse nothing again.
    """
    day = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    tables.drop_partition(spark, path, load_day=day, batch=kind)
    rows = staging.rejected_fields(staged)
    (rows.withColumns({"load_day": F.lit(day), "batch": F.lit(kind)}).write.mode("append")
        .partitionBy("load_day", "batch").parquet(path))
    return rows.count()


def read_ods(spark: SparkSession, ods_root: str) -> Ods:
    root = ods_root.rstrip("/")

    def part(name):
        p = f"{root}/{name}"
        # The declared schema: a table without a data file yet is an empty table.
        schema = T.StructType([*ODS_SCHEMAS[name].fields, T.StructField("day", T.DateType())])
        tables.recover(spark, p, reader=True)
        return spark.read.schema(schema).parquet(p) if tables.path_exists(spark, p) else None

    return Ods(
        product=tables.VersionedTable(spark, f"{root}/product").read(),
        book_a=part("book_a"),
        history=part("history"),
        book_b=part("book_b"),
    )


def raw_freshness(spark: SparkSession, raw_root: str, as_of) -> DataFrame:
    """The freshness gate over the landed raw zone: ``(table, day, rows_today,
    fresh)`` per source, counted in the file footers of the day's partition."""
    from pricelake.operators.freshness import stored_freshness

    paths = {n: f"{raw_root.rstrip('/')}/{n}" for n in RAW_NAMES}
    present = {n: p for n, p in paths.items() if tables.path_exists(spark, p)}
    for p in present.values():
        tables.recover(spark, p, reader=True)
    return stored_freshness(spark, present, as_of)
