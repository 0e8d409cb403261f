"""The checked-query registry (see ``pricelake.plans.queries``)."""

from pricelake.plans.queries import ORACLES, QUERIES, register, uuid5_sql

__all__ = ["ORACLES", "QUERIES", "register", "uuid5_sql"]
