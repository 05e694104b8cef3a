"""Record filters: strict type/quality/length conjunction, normalised type
match, missing-field and label predicates, and the filter counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.fields import DEFAULT, Fields
from corpusprep.functions.coerce import as_str, is_json_string, json_path, py_strip, to_float, to_int
from corpusprep.sources.jsonl import LINE_STATUS_OK, STATUS, VAR


def match_filters(
    v: Column,
    *,
    tp: str | None = None,
    min_quality: float | None = None,
    min_length: int | None = None,
    fields: Fields = DEFAULT,
) -> Column:
    """Conjunction of the conditions that are set.

    * type: the field must be a JSON string equal to ``tp`` (no trimming; ``1`` never equals ``"1"``)
    * quality: float(field) >= min; unparseable fails; NaN passes (as in Python)
    * length: int(field) >= min; unparseable fails
    """
    cond = F.lit(True)
    if tp is not None:
        raw = F.try_variant_get(v, json_path(fields.type), "string")
        cond = cond & is_json_string(v, fields.type) & (raw == F.lit(tp))
    if min_quality is not None:
        q = to_float(v, fields.quality)
        cond = cond & q.isNotNull() & (F.isnan(q) | (q >= F.lit(float(min_quality))))
    if min_length is not None:
        n = to_int(v, fields.length)
        cond = cond & n.isNotNull() & (n >= F.lit(int(min_length)))
    return F.coalesce(cond, F.lit(False))


def filter_records(parsed: DataFrame, **conditions) -> DataFrame:
    """Valid records that satisfy :func:`match_filters`."""
    ok = F.col(STATUS) == LINE_STATUS_OK
    return parsed.filter(ok & match_filters(F.col(VAR), **conditions))


def filter_counts(parsed: DataFrame, **conditions) -> DataFrame:
    """One row: total (non-blank lines), kept, dropped, invalid -- one pass."""
    s = F.col(STATUS)
    kept = (s == LINE_STATUS_OK) & match_filters(F.col(VAR), **conditions)
    return parsed.agg(
        F.count_if(s != "blank").alias("total_records"),
        F.count_if(kept).alias("kept_records"),
        (F.count_if(s != "blank") - F.count_if(kept)).alias("dropped_records"),
        F.count_if((s != "blank") & (s != LINE_STATUS_OK)).alias("invalid_json_lines"),
    )


def type_matches(v: Column, type_field: str, type_value: str) -> Column:
    """Normalised type match: both sides stringified and stripped; no field name -> no filter."""
    if not type_field:
        return F.lit(True)
    return as_str(v, type_field) == py_strip(F.lit(type_value))


def is_missing(v: Column, field: str) -> Column:
    return as_str(v, field) == ""


def is_label(v: Column, field: str, label: str) -> Column:
    """Case-insensitive label compare on the stripped field."""
    return F.lower(as_str(v, field)) == F.lit(label)
