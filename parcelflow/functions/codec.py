"""Bytes to text and back, for message keys and values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_utf8(value: Column) -> Column:
    """Strict UTF-8; NULL where the bytes are not valid."""
    return F.try_validate_utf8(value.cast("string"))


def decode_key(key: Column) -> Column:
    """Key text. A NULL or empty key is no key."""
    return F.when(F.length(key) > 0, decode_utf8(key))


def undecodable_key(key: Column) -> Column:
    """True where a non-empty key is not valid UTF-8."""
    return F.coalesce((F.length(key) > 0) & decode_utf8(key).isNull(), F.lit(False))


def iso_text(ts: Column) -> Column:
    """Zoneless ISO text with six fraction digits."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def encode_event(*fields: Column, keep_nulls: bool = True) -> Column:
    """JSON bytes of one event; NULL fields are written unless told otherwise."""
    keep = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.encode(F.to_json(F.struct(*fields), keep), "UTF-8")
