"""pricelake — a Spark-native price warehouse.

Raw JSON payloads land in a date-partitioned zone, get stable name-derived
keys, are flattened, deduplicated and merged into keyed Parquet tables, then
summarised into marts and guarded by data-quality checks. Every operator is a
DataFrame -> DataFrame function; nothing runs outside Spark's planner.
"""

from pricelake.session import build_session

__all__ = ["build_session"]
