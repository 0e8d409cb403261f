"""Checked queries over the driver tables, one module per operator family.

Each query runs library operators over whole driver tables (no row caps)
and has an independent DuckDB SQL oracle. Decimal outputs are cast to double
at the end on both sides, so the two engines' decimal result types do not
matter for the comparison. Import order is registration order.
"""

from pricelake.plans.queries import marts, merges, staging, sources, quality, day_loads, raw_zone, suite  # noqa: F401
from pricelake.plans.queries.base import ORACLES, QUERIES, register, uuid5_sql

__all__ = ["ORACLES", "QUERIES", "register", "uuid5_sql"]
