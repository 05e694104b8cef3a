"""Column expressions (JVM side, inside whole-stage codegen)."""

from corpusprep.functions.coerce import (
    as_str,
    is_json_string,
    json_path,
    lang_bucket,
    newspaper_of,
    py_strip,
    record_length,
    sanitize_name,
    shard_key,
    to_float,
    to_int,
    raw_field,
    has_field,
)

__all__ = [
    "as_str",
    "is_json_string",
    "json_path",
    "lang_bucket",
    "newspaper_of",
    "py_strip",
    "record_length",
    "sanitize_name",
    "shard_key",
    "to_float",
    "to_int",
    "raw_field",
    "has_field",
]
