"""Editing a JSON record without losing fields the job does not know.

The line is read as ``map<string,variant>``, which keeps top-level key order,
JSON nulls, nested values and big integers; the edit is a map expression and
``to_json`` writes the record back.  Only edited rows pay for this second
parse -- unchanged rows keep their original line -- and adding a key the
line does not have is plain text work (:func:`append_field`), no parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_map(line: Column) -> Column:
    return F.from_json(line, "map<string,variant>")


def set_field(m: Column, name: str, value: Column) -> Column:
    """Replace ``name`` in place when present, else append it."""
    return F.when(
        F.map_contains_key(m, F.lit(name)),
        F.transform_values(m, lambda k, x: F.when(k == F.lit(name), value).otherwise(x)),
    ).otherwise(F.map_concat(m, F.create_map(F.lit(name), value)))


def insert_before(m: Column, name: str, value: Column, before: str) -> Column:
    """Put ``name`` just before key ``before`` (appended when ``before`` is absent);
    an existing ``name`` is removed first, so the new value always wins."""
    rest = F.map_filter(m, lambda k, _: k != F.lit(name))
    new_entry = F.struct(F.lit(name).alias("key"), value.alias("value"))
    entries = F.map_entries(rest)
    spliced = F.flatten(
        F.transform(
            entries,
            lambda e: F.when(e["key"] == F.lit(before), F.array(new_entry, e)).otherwise(F.array(e)),
        )
    )
    return F.when(
        F.map_contains_key(rest, F.lit(before)), F.map_from_entries(spliced)
    ).otherwise(F.map_concat(rest, F.create_map(F.lit(name), value)))


def write_record(m: Column) -> Column:
    return F.to_json(m)


def append_field(line: Column, name: str, value: Column) -> Column:
    """Add ``name: value`` as the last key of a JSON object line without
    parsing it -- for records known not to have the key (use
    :func:`set_field` otherwise).  ``line`` must be a stripped object."""
    pair = F.to_json(F.create_map(F.lit(name), value))  # {"name":value}
    member = F.substr(pair, F.lit(2), F.length(pair) - 2)  # "name":value
    body = F.substr(line, F.lit(1), F.length(line) - 1)  # without the closing brace
    empty = F.trim(F.substr(line, F.lit(2), F.length(line) - 2)) == ""
    return F.concat(body, F.when(empty, F.lit("")).otherwise(F.lit(",")), member, F.lit("}"))
