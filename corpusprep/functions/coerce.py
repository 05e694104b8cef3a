"""Coercion rules for loosely typed JSON fields.

A record is a VARIANT object.  Reading a field follows the loose rules of the
data's producers: strings are stripped of Unicode whitespace, integers and
floats parse from numbers, numeric strings and booleans, and anything that
does not convert becomes NULL instead of failing the job.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusprep.fixed import NAME_EDGE_CHARS, PY_SPACE_CLASS, UNKNOWN_LANGUAGE, UNSAFE_NAME_RE

_STRIP_RE = f"^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+$"

# A string Python's float() accepts (underscores aside).
_FLOAT_RE = (
    "^" + PY_SPACE_CLASS + "*[+-]?((\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?"
    "|(?i:nan|inf|infinity))" + PY_SPACE_CLASS + "*$"
)

_NAME_EDGE_RE = "^[" + re.escape(NAME_EDGE_CHARS) + "]+|[" + re.escape(NAME_EDGE_CHARS) + "]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_path(name: str) -> str:
    """A VARIANT path for one top-level key; works for keys with dots or spaces."""
    if "'" in name:
        return '$["' + name.replace("\\", "\\\\").replace('"', '\\"') + '"]'
    return "$['" + name.replace("\\", "\\\\") + "']"


def raw_field(v: Column | str, name: str) -> Column:
    """The field as VARIANT: SQL NULL when the key is absent, VARIANT null for JSON null."""
    return F.variant_get(_col(v), json_path(name), "variant")


def has_field(v: Column | str, name: str) -> Column:
    return raw_field(v, name).isNotNull()


def is_json_string(v: Column | str, name: str) -> Column:
    return F.schema_of_variant(raw_field(v, name)) == F.lit("STRING")


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: regex only when the first or last character is a space."""
    c = _col(c)
    edge = F.concat(F.substring(c, 1, 1), F.substring(c, -1, 1))
    return F.when(edge.rlike(PY_SPACE_CLASS), F.regexp_replace(c, _STRIP_RE, "")).otherwise(c)


def as_str(v: Column | str, name: str) -> Column:
    """Trimmed string of a field; NULL, JSON null and absent become ''.
    Booleans read ``True``/``False`` as Python's ``str()`` writes them."""
    v = _col(v)
    s = F.try_variant_get(v, json_path(name), "string")
    is_bool = F.schema_of_variant(raw_field(v, name)) == F.lit("BOOLEAN")
    s = F.when(is_bool, F.when(s == "true", F.lit("True")).otherwise(F.lit("False"))).otherwise(s)
    return F.coalesce(py_strip(s), F.lit(""))


def to_int(v: Column | str, name: str) -> Column:
    """Python ``int(value)`` or NULL: numbers truncate, numeric strings and booleans parse."""
    return F.try_variant_get(_col(v), json_path(name), "bigint")


def to_float(v: Column | str, name: str) -> Column:
    """Python ``float(value)`` or NULL."""
    v = _col(v)
    path = json_path(name)
    s = F.try_variant_get(v, path, "string")
    return F.when(
        is_json_string(v, name),
        F.when(s.rlike(_FLOAT_RE), F.try_variant_get(v, path, "double")),
    ).otherwise(F.try_variant_get(v, path, "double"))


def record_length(length: Column, text: Column) -> Column:
    """Length field when it is an integer >= 0, else code points of the stripped text."""
    return F.when(length >= 0, length).otherwise(
        F.char_length(F.coalesce(py_strip(text), F.lit(""))).cast("bigint")
    )


def sanitize_name(c: Column | str, fallback: str) -> Column:
    c = _col(c)
    cand = F.when(c == "", F.lit(fallback)).otherwise(c)
    safe = F.regexp_replace(F.regexp_replace(cand, UNSAFE_NAME_RE, "_"), _NAME_EDGE_RE, "")
    return F.when(safe == "", F.lit(fallback)).otherwise(safe)


def lang_bucket(lang: Column | str, unknown: str = UNKNOWN_LANGUAGE) -> Column:
    """Blank language -> ``unknown``, then made safe for a folder name."""
    return sanitize_name(F.coalesce(_col(lang), F.lit("")), unknown)


def shard_key(record_id: Column | str) -> Column:
    """Archive shard ``newspaper-year``: the first two '-' parts, the whole ID when fewer."""
    return F.substring_index(_col(record_id), "-", 2)


def newspaper_of(record_id: Column | str) -> Column:
    return F.substring_index(_col(record_id), "-", 1)
