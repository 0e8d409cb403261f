"""Joins against dimension tables with a checked broadcast.

A side is broadcast only when the optimizer's size estimate for it (the same
estimate Spark's own broadcast rule reads), inflated for in-memory expansion
of compressed files, is under a byte limit; otherwise
the join is left to a shuffle join, which AQE may still turn into a
broadcast at runtime from the real shuffle size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024
# The optimizer sizes a Parquet scan by its (compressed) file bytes; rows in
# memory are commonly several times larger. The check multiplies by this.
EXPANSION_FACTOR = 4


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` in bytes, or None when unavailable."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size) if isinstance(size, int) else int(str(size.toString()))
    except Exception:  # Spark Connect or an unexpected plan: no estimate
        return None


def broadcast_limit(df: DataFrame, default: int = DEFAULT_BROADCAST_LIMIT) -> int:
    """Byte limit for a checked broadcast.

    ``spark.sql.autoBroadcastJoinThreshold`` when the session sets it (a value
    <= 0 disables broadcasting, as it does for Spark's own rule), else ``default``.
    """
    try:
        raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    except Exception:
        raw = None
    if not raw:
        return default
    txt = str(raw).strip().lower()
    mult = 1
    for suffix, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("b", 1)):
        if txt.endswith(suffix):
            txt, mult = txt[: -len(suffix)], m
            break
    try:
        return max(0, int(float(txt) * mult))
    except ValueError:
        return default


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """True when the optimizer's size estimate of ``df``, times
    ``EXPANSION_FACTOR``, is at most ``limit`` bytes. No estimate: False."""
    limit = broadcast_limit(df) if limit is None else limit
    est = estimated_bytes(df)
    return limit > 0 and est is not None and est * EXPANSION_FACTOR <= limit


def maybe_broadcast(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``broadcast(df)`` if its size estimate is at most ``limit`` bytes, else ``df``."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    limit: int | None = None,
) -> DataFrame:
    """Join a (possibly huge) fact side to a dimension, broadcasting the dimension if small."""
    return fact.join(maybe_broadcast(dim, limit), on=on, how=how)
