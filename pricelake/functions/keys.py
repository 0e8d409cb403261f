"""Stable product keys derived from names (pure Catalyst expressions).

A key is the RFC 4122 version-5 UUID of the product name in a fixed
namespace, so every loader, on every day, derives the same key for the same
name without a lookup table or a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The namespace the product keys are derived in (the RFC 4122
# DNS namespace), and the JSON fields that hold a product name, in priority
# order.
KEY_NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
NAME_FIELDS = ("market_hash_name", "name")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uuid5(name: Column | str, namespace: str = KEY_NAMESPACE) -> Column:
    """Version-5 UUID text of ``name`` (UTF-8) in ``namespace``; NULL stays NULL.

    sha1(namespace bytes || name bytes) gives 40 hex digits; the UUID keeps the
    first 32, forces the version nibble to 5 and the two variant bits to 10.
    The variant digit is the high nibble of byte 8: (n & 3) | 8, which maps
    0-f onto 8,9,a,b,8,9,a,b,... — done with ``translate``.
    """
    ns_hex = namespace.replace("-", "")
    digest = F.sha1(F.concat(F.unhex(F.lit(ns_hex)), F.encode(_col(name), "UTF-8")))
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-"),
        F.lit("5"), F.substring(digest, 14, 3), F.lit("-"),
        F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab"),
        F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def canon_name(*candidates: Column | str) -> Column:
    """First non-NULL of the candidate name columns (market name, then name)."""
    return F.coalesce(*[_col(c) for c in candidates])


def usable_name(name: Column | str) -> Column:
    """Predicate: the name can key a product (not NULL and not empty)."""
    c = _col(name)
    return c.isNotNull() & (c != F.lit(""))
