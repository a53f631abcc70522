"""Column builders: no function in here reads data or takes a DataFrame."""

from .json import (
    array_field,
    field,
    json_object,
    json_quote,
    json_value,
    kvp_fields,
    map_fields,
    raw_field,
    scalar_fields,
    value_text,
)
from .maps import bulk, bulk_kvp, map_bytes, marker_map, merge_maps, no_map
from .text import abbreviate, extract_kv, is_blank, map_text, selector, stream_key, trim_control, utf8_len
from .wire import bytes_field, int_field, pair_fields, text_field, varint

__all__ = [
    "abbreviate",
    "array_field",
    "bulk",
    "bulk_kvp",
    "bytes_field",
    "extract_kv",
    "field",
    "int_field",
    "is_blank",
    "json_object",
    "json_quote",
    "json_value",
    "kvp_fields",
    "map_bytes",
    "map_fields",
    "map_text",
    "marker_map",
    "merge_maps",
    "no_map",
    "pair_fields",
    "raw_field",
    "scalar_fields",
    "selector",
    "stream_key",
    "text_field",
    "trim_control",
    "utf8_len",
    "value_text",
    "varint",
]
