"""Request-side filters applied as row predicates (tradable flag, name list)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.operators.joins import maybe_broadcast


def request_filter(
    df: DataFrame,
    tradable_col: str | None = None,
    names: DataFrame | None = None,
    name_col: str = "market_hash_name",
    names_col: str = "name",
) -> DataFrame:
    """Keep tradable rows (NULL counts as not tradable) and/or rows whose name
    is in ``names`` (a semi join, never a collected ``isin`` list)."""
    if tradable_col is not None:
        df = df.filter(F.coalesce(F.col(tradable_col).cast("boolean"), F.lit(False)))
    if names is not None:
        wanted = names.select(F.col(names_col).alias(name_col))
        df = df.join(maybe_broadcast(wanted), on=name_col, how="left_semi")
    return df
