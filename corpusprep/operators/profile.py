"""Text profile: per record ID, text length and word-character ratio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.fixed import NON_WORD_RE
from corpusprep.functions.coerce import has_field, json_path
from corpusprep.sources.jsonl import VAR

__all__ = ["NON_WORD_RE", "profile_id", "text_profile", "word_char_ratio", "profile_lines"]


def profile_id(v: Column, primary: str = "id", fallback: str = "c_id") -> Column:
    """Key-presence fallback: ``id`` if the key exists (even when null), else ``c_id``, else ''."""
    return (
        F.when(has_field(v, primary), F.try_variant_get(v, json_path(primary), "string"))
        .when(has_field(v, fallback), F.try_variant_get(v, json_path(fallback), "string"))
        .otherwise(F.lit(""))
    )


def word_char_ratio(text: Column) -> Column:
    """Share of word characters, rounded to 3 places; 0 for empty text."""
    n = F.char_length(text)
    words = F.char_length(F.regexp_replace(text, NON_WORD_RE, ""))
    return F.when(n > 0, F.round(words / n, 3)).otherwise(F.lit(0.0))


def text_profile(records: DataFrame, run_ts: str, text_field: str = "ft") -> DataFrame:
    """``id, length, alphabetic_ratio, ts`` for every record (the text is not stripped)."""
    v = F.col(VAR)
    text = F.coalesce(F.try_variant_get(v, json_path(text_field), "string"), F.lit(""))
    return records.select(
        profile_id(v).alias("id"),
        F.char_length(text).cast("bigint").alias("length"),
        word_char_ratio(text).alias("alphabetic_ratio"),
        F.lit(run_ts).alias("ts"),
    )


def profile_lines(profiles: DataFrame) -> DataFrame:
    """The profile as JSON lines, ready for :func:`write_jsonl`."""
    return profiles.select(F.to_json(F.struct(*profiles.columns)).alias("value"))
