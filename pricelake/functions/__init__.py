"""Column-level building blocks: keys, JSON field access, typed casts."""

from pricelake.functions.keys import canon_name, uuid5
from pricelake.functions.json_fields import json_decimal, json_int, json_text, PRICE_TYPE

__all__ = ["canon_name", "uuid5", "json_decimal", "json_int", "json_text", "PRICE_TYPE"]
