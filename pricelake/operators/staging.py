"""Raw payload rows -> typed ODS rows.

Raw rows (``sources.raw``) have ``created_at``, ``ingest_date`` (its UTC day,
the partition column), ``load_pos`` (the element's position in its load) and
the payload, parsed (``body``, VARIANT) or as text alone. Each staging
function takes its fields from the VARIANT without a parse, or parses the text
once (``functions.json_fields.payload_struct``), derives the product key from the canonical name, and casts with
``nullif(x, '')``. It keeps ``src_ts``, ``src_pos`` and ``src_hash`` (a 64-bit
payload hash) as compact tie-breaks instead of the payload text.

The ODS step of a day is then ``dedup_staged`` (keep-latest on
(id_name, date_extracted)) followed by one merge; the staging is computed
once and shared with the catalog.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.json_fields import (
    PRICE_TYPE,
    json_decimal,
    json_int,
    json_timestamp,
    payload_struct,
    string_struct,
)
from pricelake.functions.keys import NAME_FIELDS, canon_name, usable_name, uuid5
from pricelake.operators.latest import latest_per_key

# Statistic periods of the history payload, the statistics of
# each period, and the price fields of a book-A item.
PERIODS = ("last_24_hours", "last_7_days", "last_30_days", "last_90_days")
PERIOD_STATS = ("min", "max", "avg", "median", "volume")
BOOK_A_PRICES = ("suggested_price", "min_price", "max_price", "mean_price", "median_price")

def _tie_cols(raw: DataFrame) -> list[Column]:
    """Compact tie-breaks for rows of one key and load time: the position in
    the load (a later element wins) and a 64-bit hash of the payload text.
    The payload itself never has to travel through the dedup shuffle."""
    pos = F.col("load_pos") if "load_pos" in raw.columns else F.lit(None).cast("bigint")
    return [pos.alias("src_pos"), (F.col("payload_hash") if "payload_hash" in raw.columns else F.xxhash64("payload")).alias("src_hash")]


def period_columns(periods: Sequence[str] = PERIODS, stats: Sequence[str] = PERIOD_STATS) -> list[str]:
    return [f"{p}_{s}" for p in periods for s in stats]


def for_day(raw: DataFrame, as_of: _dt.date | str, day_col: str = "ingest_date") -> DataFrame:
    """Rows loaded on the UTC day ``as_of``.

    Filtering the partition column directly (not a cast of the load time)
    lets Spark prune whole partitions of the raw zone.
    """
    day = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    return raw.filter(F.col(day_col) == F.lit(day))


def _named(parsed: Column) -> Column:
    return canon_name(*[parsed[f] for f in NAME_FIELDS])


def _parsed_with_name(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """``p`` (the parsed payload) for rows with a usable name, parsed once per row.

    A plain ``filter`` on the name would be pushed below the parse by the
    optimizer and re-parse the payload for every field it references; keeping
    the row through ``explode`` of a filtered one-element array holds the
    predicate above the single parse.
    """
    p = payload_struct(raw.columns, schema)
    keep = F.filter(F.array(p), lambda x: usable_name(_named(x)))
    return raw.select(F.explode(keep).alias("p"), "created_at", *_tie_cols(raw))


CATALOG_FIELDS = ("item_page", "market_page")


def _catalog_cols(keep: bool) -> list[Column]:
    """With ``keep``: the canonical name and page links, from the same parse."""
    if not keep:
        return []
    p = F.col("p")
    return [_named(p).alias("name"), *[p[f].alias(f) for f in CATALOG_FIELDS]]


#: Column of staged rows that lists the texts a lenient load could not type: array of (field, text).
REJECTS = "rejected_fields"


def _rejects(lenient: bool, fields: list[tuple[str, Column, Column]]) -> list[Column]:
    """The (name, text, typed value) fields whose text, not blank, gave no value; nothing on strict loads (they fail)."""
    if not lenient:
        return []
    entries = [F.when(F.nullif(text, F.lit("")).isNotNull() & typed.isNull(), F.struct(F.lit(name).alias("field"), text.alias("text")))
               for name, text, typed in fields]
    return [F.filter(F.array(*entries), lambda x: x.isNotNull()).alias(REJECTS)]


def rejected_fields(staged: DataFrame) -> DataFrame:
    """``(id_name, src_ts, src_pos, src_hash, field, text)`` of a lenient load: each text that became NULL
    because it could not be typed. From the staged rows themselves, so payloads are parsed once for both."""
    return staged.filter(F.size(REJECTS) > 0).select(
        "id_name", "src_ts", "src_pos", "src_hash", F.explode(REJECTS).alias("__r")).select(
        "id_name", "src_ts", "src_pos", "src_hash", "__r.field", "__r.text")


def stage_book_a(raw: DataFrame, lenient: bool = False, keep_catalog: bool = False) -> DataFrame:
    """Book A items: key, load time, five prices; rows without a usable name dropped.

    ``keep_catalog`` also returns ``name, item_page, market_page`` so the
    catalog can be fed from the same single parse. A ``lenient`` load gives NULL
    for unreadable numbers and lists them (``REJECTS``, see ``rejected_fields``).
    """
    fields = [*NAME_FIELDS, *BOOK_A_PRICES, *(CATALOG_FIELDS if keep_catalog else ())]
    parsed = _parsed_with_name(raw, string_struct(fields))
    name = _named(F.col("p"))
    typed = [(f, F.col("p")[f], json_decimal(F.col("p")[f], PRICE_TYPE, lenient)) for f in BOOK_A_PRICES]
    return parsed.select(
        uuid5(name).alias("id_name"),
        F.col("created_at").alias("date_extracted"),
        *[value.alias(f) for f, _, value in typed],
        F.col("created_at").alias("src_ts"),
        "src_pos", "src_hash",
        *_catalog_cols(keep_catalog),
        *_rejects(lenient, typed),
    )


def stage_history(
    raw: DataFrame,
    periods: Sequence[str] = PERIODS,
    stats: Sequence[str] = PERIOD_STATS,
    lenient: bool = False,
    keep_catalog: bool = False,
) -> DataFrame:
    """History snapshots flattened to ``<period>_<stat>`` columns (volume int, others decimal).

    A missing period, a JSON null and '' all give NULL.
    """
    fields = [*NAME_FIELDS, *[(pr, list(stats)) for pr in periods], *(CATALOG_FIELDS if keep_catalog else ())]
    parsed = _parsed_with_name(raw, string_struct(fields))
    name = _named(F.col("p"))
    typed = []
    for pr in periods:
        for s in stats:
            leaf = F.col("p")[pr][s]
            typed.append((f"{pr}_{s}", leaf, json_int(leaf, lenient) if s == "volume" else json_decimal(leaf, PRICE_TYPE, lenient)))
    return parsed.select(
        uuid5(name).alias("id_name"),
        *[value.alias(f) for f, _, value in typed],
        F.col("created_at").alias("date_extracted"),
        F.col("created_at").alias("src_ts"),
        "src_pos", "src_hash",
        *_catalog_cols(keep_catalog),
        *_rejects(lenient, typed),
    )


def stage_book_b(raw: DataFrame, lenient: bool = False, keep_catalog: bool = False) -> DataFrame:
    """Book B listings: the event time comes from the payload's ``created_at``;
    the load time is kept as ``src_ts`` (the tie-break between loads)."""
    fields = [*NAME_FIELDS, "created_at", "price", *(CATALOG_FIELDS if keep_catalog else ())]
    parsed = _parsed_with_name(raw, string_struct(fields))
    name = _named(F.col("p"))
    when, price = F.col("p")["created_at"], F.col("p")["price"]
    typed = [("created_at", when, json_timestamp(when, lenient)), ("price", price, json_decimal(price, PRICE_TYPE, lenient))]
    return parsed.select(
        uuid5(name).alias("id_name"),
        typed[0][2].alias("date_extracted"),
        typed[1][2].alias("price"),
        F.col("created_at").alias("src_ts"),
        "src_pos", "src_hash",
        *_catalog_cols(keep_catalog),
        *_rejects(lenient, typed),
    )


def dedup_staged(staged: DataFrame, keys: Sequence[str] = ("id_name", "date_extracted")) -> DataFrame:
    """Latest load per key; within one load the later element wins, then the
    payload hash decides, so the survivor does not depend on how the input
    was partitioned."""
    keyed = staged.drop(REJECTS)
    for k in keys:
        keyed = keyed.filter(F.col(k).isNotNull())
    order = [F.col("src_ts").desc(), F.col("src_pos").desc_nulls_last(), F.col("src_hash").desc()]
    out = latest_per_key(keyed, list(keys), order)
    return out.drop("src_ts", "src_pos", "src_hash", "name", REJECTS, *CATALOG_FIELDS)


def catalog_part(staged: DataFrame) -> DataFrame:
    """``(name, item_page, market_page)`` of staged rows made with ``keep_catalog``."""
    return staged.select("name", *CATALOG_FIELDS)


def product_rows(raw: DataFrame) -> DataFrame:
    """Catalog candidates of one raw source: usable canonical name and page links."""
    parsed = _parsed_with_name(raw, string_struct([*NAME_FIELDS, "item_page", "market_page"]))
    p = F.col("p")
    return parsed.select(
        _named(p).alias("name"), p["item_page"].alias("item_page"), p["market_page"].alias("market_page")
    )


def unpivot_periods(
    wide: DataFrame,
    id_cols: Sequence[str],
    periods: Sequence[str] = PERIODS,
    stats: Sequence[str] = PERIOD_STATS,
    period_col: str = "period",
) -> DataFrame:
    """Wide period statistics -> one row per (ids, period); a missing period
    still yields its row, with NULL statistics.

    An ``explode`` of a literal-length array of structs is a per-row
    generator: no shuffle, and it stays inside whole-stage codegen's
    neighbours.
    """
    entries = [
        F.struct(F.lit(pr).alias(period_col), *[F.col(f"{pr}_{s}").alias(s) for s in stats])
        for pr in periods
    ]
    return wide.select(*id_cols, F.explode(F.array(*entries)).alias("__e")).select(
        *id_cols, *[F.col("__e")[c].alias(c) for c in (period_col, *stats)]
    )
