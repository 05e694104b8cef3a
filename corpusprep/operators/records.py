"""Typed views of parsed records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.fields import DEFAULT, Fields
from corpusprep.functions.coerce import as_str, to_float, to_int
from corpusprep.sources.jsonl import VAR


def with_core_fields(records: DataFrame, fields: Fields = DEFAULT) -> DataFrame:
    """Add ``_id``, ``_lang``, ``_type``, ``_len``, ``_quality`` typed columns."""
    v = F.col(VAR)
    return records.select(
        "*",
        as_str(v, fields.id).alias("_id"),
        as_str(v, fields.lang).alias("_lang"),
        as_str(v, fields.type).alias("_type"),
        to_int(v, fields.length).alias("_len"),
        to_float(v, fields.quality).alias("_quality"),
    )
