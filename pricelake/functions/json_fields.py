"""Typed access to JSON payloads.

The raw zone keeps a payload parsed, as VARIANT; staging takes the fields it
needs from it in one ``try_variant_get``, without parsing. Raw rows that have
the text only are parsed with one ``from_json``. Both give a struct whose
leaves are all strings, so ``12.5`` and ``"12.5"`` read the same. Typing
happens afterwards with ``nullif(x, '')`` + ``cast``, the way the raw zone has
always been typed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Prices are stored as exact decimals: sums stay exact, and averages or ratios
# are taken as double from an exact sum or difference.
PRICE_TYPE = T.DecimalType(18, 4)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_text(payload: Column | str, path: str) -> Column:
    """Text of one JSON field (``$.a.b``); JSON null and missing give NULL."""
    return F.get_json_object(_col(payload), path)


def _typed(text: Column, dtype: T.DataType, lenient: bool) -> Column:
    cleaned = F.nullif(text, F.lit(""))
    return cleaned.try_cast(dtype) if lenient else cleaned.cast(dtype)


def json_decimal(text: Column | str, dtype: T.DataType = PRICE_TYPE, lenient: bool = False) -> Column:
    """'' -> NULL, then a decimal cast. Bad text raises unless ``lenient``."""
    return _typed(_col(text), dtype, lenient)


def json_int(text: Column | str, lenient: bool = False) -> Column:
    """'' -> NULL, then an int cast ('12.5' raises unless ``lenient``)."""
    return _typed(_col(text), T.IntegerType(), lenient)


def json_timestamp(text: Column | str, lenient: bool = False) -> Column:
    """'' -> NULL, then a timestamp cast (ISO text with Z or an offset)."""
    return _typed(_col(text), T.TimestampType(), lenient)


def string_struct(fields: list[str | tuple[str, list[str]]]) -> T.StructType:
    """Schema with string leaves: names, or (name, [sub names]) for one level of nesting."""
    out = []
    for f in fields:
        if isinstance(f, tuple):
            name, subs = f
            out.append(T.StructField(name, T.StructType([T.StructField(s, T.StringType()) for s in subs])))
        else:
            out.append(T.StructField(f, T.StringType()))
    return T.StructType(out)


def parse_payload(payload: Column | str, schema: T.StructType) -> Column:
    """One JSON parse per row into a struct of string leaves."""
    return F.from_json(_col(payload), schema)


def variant_columns(payload: str, body: str) -> dict[str, Column]:
    """``unparsed``: the text of payloads that VARIANT can't hold (repeated keys, NaN), else NULL, beside their NULL ``body``.

    Staging falls back to it, so it never has to read the payload text of all rows.
    """
    return {"unparsed": F.when(F.col(body).isNull(), F.col(payload))}


def _ddl(kind: T.DataType) -> str:
    if not isinstance(kind, T.StructType):
        return kind.simpleString()
    return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{_ddl(f.dataType)}" for f in kind.fields) + ">"


def payload_struct(columns: list[str], schema: T.StructType) -> Column:
    """The payload's fields as a struct of string leaves: from ``body`` where the raw rows (``columns``) have it, else from the text."""
    if "body" not in columns:
        return parse_payload("payload", schema)
    held = F.try_variant_get("body", "$", _ddl(schema))
    return F.coalesce(held, parse_payload("unparsed", schema)) if "unparsed" in columns else held
