"""Column functions: text codecs, strict JSON, typed payload fields, event keys."""

from parcelflow.functions.codec import decode_key, decode_utf8, encode_event, iso_text, undecodable_key
from parcelflow.functions.keys import event_id, key_hash, offset_block, partition_of_key, with_row_id
from parcelflow.functions.payload import (
    castable_text,
    field,
    has_lone_surrogate,
    has_nul_character,
    is_non_finite_json,
    spelled_numbers,
    typed_field,
    with_strict_json,
)

__all__ = [
    "castable_text",
    "decode_key",
    "decode_utf8",
    "encode_event",
    "event_id",
    "field",
    "has_lone_surrogate",
    "has_nul_character",
    "is_non_finite_json",
    "iso_text",
    "key_hash",
    "offset_block",
    "partition_of_key",
    "spelled_numbers",
    "typed_field",
    "undecodable_key",
    "with_row_id",
    "with_strict_json",
]
