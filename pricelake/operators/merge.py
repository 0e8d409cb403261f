"""Keyed writes as DataFrame -> DataFrame operators.

Each function returns the *new content* of the target table. Writing it is
done by ``pricelake.sources.tables`` into a new version or into the touched
partitions, never into the path being read.

Key semantics follow SQL unique constraints: keys compare with ``=``, so a
row with a NULL in any key column never conflicts with anything.

Scale: the target is the big side (all history), the source is one load.
Every operator is written so that when the source is small enough to
broadcast, the target is only *scanned* (anti/semi joins against the
broadcast source keys) and never shuffled. When the source is big too, the
same plans fall back to shuffle joins on the keys.

The source is read up to three times (its keys for the anti and semi joins,
its rows for the union). Persist it when it is costly to recompute;
``sources.tables.merge_partitions`` does so for the duration of a merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.operators.joins import fits_broadcast, maybe_broadcast
from pricelake.operators.latest import latest_per_key

_MATCHED = "__matched"


def _key_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def dedup_source(source: DataFrame, keys: Sequence[str], order: Sequence[Column] | None) -> DataFrame:
    """One row per key (the first in ``order``); rows with a NULL key are all kept.

    ``order=None`` means the caller guarantees unique keys (e.g. the source is
    the output of ``latest_per_key``) and nothing is done.
    """
    if order is None:
        return source
    keyed = source.filter(_key_not_null(keys))
    unkeyed = source.filter(~_key_not_null(keys))
    return latest_per_key(keyed, list(keys), list(order)).unionByName(unkeyed)


def _source_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns of the source (NULL keys never match), broadcast when small.

    No ``distinct``: duplicates on the right of a semi or anti join change
    nothing, so deduplicating would only add a shuffle.
    """
    return maybe_broadcast(source.select(*keys).filter(_key_not_null(keys)))


def _align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Insert, or on a key conflict update ``update_cols`` (default: all non-key columns).

    Columns not in ``update_cols`` keep the target's value on a conflict and
    take the source's value on an insert.

    Plan: ``(target ▷ source) ∪ (source ⟕ (target ⋉ source))`` — the target is
    anti- and semi-joined against the (broadcast, when small) source keys,
    so only the few matched target rows take part in a join with the source.
    """
    cols = target.columns
    src = _align(dedup_source(source, keys, order), cols)
    non_key = [c for c in cols if c not in keys]
    update = list(non_key) if update_cols is None else [c for c in update_cols if c in non_key]
    preserved = [c for c in non_key if c not in update]
    src_keys = _source_keys(src, keys)
    untouched = target.join(src_keys, on=list(keys), how="left_anti").select(*cols)
    if not preserved:
        return untouched.unionByName(src)
    matched = target.join(src_keys, on=list(keys), how="left_semi").select(
        *keys, *[F.col(c).alias(f"__t_{c}") for c in preserved], F.lit(True).alias(_MATCHED)
    )
    joined = src.join(matched, on=list(keys), how="left")
    merged = joined.select(
        *[
            F.when(F.col(_MATCHED), F.col(f"__t_{c}")).otherwise(F.col(c)).alias(c)
            if c in preserved else F.col(c)
            for c in cols
        ]
    )
    return untouched.unionByName(merged)


def insert_ignore(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Insert source rows whose key is not in the target; on conflict do nothing.

    Within the source the first row per key in ``order`` wins.
    """
    src = _align(dedup_source(source, keys, order), target.columns)
    return target.unionByName(new_rows(target, src, keys))


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with no target row on ``keys`` (``INSERT ... WHERE NOT EXISTS``).

    One anti join against the target's keys. A source that fits a broadcast
    first narrows these keys in a map-side scan, so that the target is not
    shuffled; the rows are the same either way.
    """
    present = target.select(*keys)
    if fits_broadcast(source.select(*keys)):
        present = present.join(_source_keys(source, keys), on=list(keys), how="left_semi")
    return source.join(maybe_broadcast(present), on=list(keys), how="left_anti").select(*source.columns)


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the source rows whose key it does not have (no source dedup)."""
    return target.unionByName(_align(new_rows(target, source, keys), target.columns))


def _single(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source``, failing on a key that has more than one row."""
    rest = [c for c in source.columns if c not in keys]
    one = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in rest])
    fail = F.raise_error(F.concat(F.lit("the source holds a key twice: "), F.to_json(F.struct(*keys)))).cast("boolean")
    return one.filter(F.when((F.col("__n") > 1) & _key_not_null(keys), fail).otherwise(F.lit(True))).select(*source.columns)


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Matched target rows take the source's ``cols`` (a NULL in the source
    overwrites); unmatched target rows stay; source-only rows are ignored.

    One left join, which reads the target once; a broadcast source shuffles nothing.
    A key that the source holds twice would be ambiguous: with ``order`` its first row counts,
    without, the query fails (an update never multiplies target rows)."""
    if order is None:
        source = _single(source, keys)
    src = dedup_source(source, keys, order).filter(_key_not_null(keys)).select(
        *keys, *[F.col(c).alias(f"__s_{c}") for c in cols], F.lit(True).alias(_MATCHED)
    )
    joined = target.join(maybe_broadcast(src), on=list(keys), how="left")
    return joined.select(
        *[F.when(F.col(_MATCHED), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
          for c in target.columns])


def replace(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """Truncate-and-insert: the new content is the source (in the target's column order)."""
    return source if target is None else _align(source, target.columns)


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    """Plain append (no key check)."""
    return target.unionByName(_align(source, target.columns))
