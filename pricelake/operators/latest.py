"""Keep-latest and top-N per key.

``row_number() <= n`` over a key partition is planned by Spark as a
``WindowGroupLimit``: a partial limit runs *before* the shuffle, so each map
task ships at most ``n`` rows per key. A key that holds a third of the data is
cut down on the map side and never lands whole in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.operators.joins import maybe_broadcast

_RN = "__rn"


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[Column | str],
    order: Sequence[Column],
    n: int = 1,
) -> DataFrame:
    """First ``n`` rows per ``keys`` in ``order`` (e.g. ``[F.col('ts').desc(), F.col('id')]``).

    ``order`` should be a total order within a key; add tie-break columns when
    the main order column can repeat, otherwise the survivor is arbitrary.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    if not order:
        raise ValueError("an order is required: without one the survivor would be arbitrary")
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) <= n).drop(_RN)


def top_n_per_key(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    n: int,
    ids: DataFrame | None = None,
    id_col: str | None = None,
) -> DataFrame:
    """Top ``n`` rows per ``key``, optionally only for keys listed in ``ids``.

    The id list is applied as a left-semi join (Spark broadcasts it when its
    size estimate is under the broadcast threshold, else shuffles both sides),
    never as a driver-side ``isin`` of a collected list.
    """
    if ids is not None:
        id_col = id_col or key
        wanted = ids.select(F.col(id_col).alias(key))
        df = df.join(maybe_broadcast(wanted), on=key, how="left_semi")
    return latest_per_key(df, [key], order, n)


def daily_latest(
    df: DataFrame,
    id_col: str,
    ts_col: str,
    tie_breaks: Sequence[Column] = (),
    day_col: str = "day",
) -> DataFrame:
    """Last row per (id, day of ``ts_col``), the day kept as a real column.

    Making the day a column lets a later join on (id, day) reuse this
    shuffle's partitioning instead of shuffling again.
    """
    with_day = df.withColumn(day_col, F.to_date(F.col(ts_col)))
    return latest_per_key(with_day, [id_col, day_col], [F.col(ts_col).desc(), *tie_breaks])
