"""Registry plumbing shared by the checked-query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.keys import KEY_NAMESPACE

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Fixed dates of the fixtures: the last day of the events table, and the load time used for raw loads.
AS_OF = "2024-01-30"
AS_OF_TS = "2024-01-30 00:00:00"
LOAD_TS = "2024-01-30 12:00:00"


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def _dbl(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def uuid5_sql(expr: str, namespace: str = KEY_NAMESPACE) -> str:
    """The key expression in DuckDB SQL (an independent spelling for the oracle)."""
    ns = namespace.replace("-", "")
    d = f"sha1(unhex('{ns}') || encode({expr}))"
    return (
        f"(substr({d},1,8) || '-' || substr({d},9,4) || '-5' || substr({d},14,3) || '-' || "
        f"translate(substr({d},17,1),'0123456789abcdef','89ab89ab89ab89ab') || substr({d},18,3) || '-' || "
        f"substr({d},21,12))"
    )
