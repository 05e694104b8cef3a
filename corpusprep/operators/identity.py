"""Record identity: stable IDs, keep-first / last-wins dedup, anti join
against processed IDs, store union and store counters.

Dedup is an aggregation (``min_by``/``max_by`` on the line order), not a
window: partial aggregation collapses a hot ID map-side, so a key holding a
large share of the rows never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.fixed import ID_FALLBACK_FIELDS
from corpusprep.functions.coerce import as_str
from corpusprep.sources.jsonl import SEQ, VAR

RID = "_rid"


def stable_id(v: Column, id_field: str = "id", class_field: str = "ad_class") -> Column:
    """First non-blank of ``id_field``, ``id``, ``c_id``; else SHA-1 of the record
    without the class field (VARIANT keys are sorted, so key order does not matter)."""
    candidates = [as_str(v, k) for k in dict.fromkeys((id_field, *ID_FALLBACK_FIELDS))]
    as_map = F.try_variant_get(v, "$", "map<string,variant>")
    canonical = F.to_json(F.map_filter(as_map, lambda k, _: k != F.lit(class_field)))
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.sha1(canonical))


def stable_id_kind(v: Column, id_field: str = "id") -> Column:
    """Which rule produced :func:`stable_id`: the field name or ``hash``."""
    out = F.lit("hash")
    for k in reversed(list(dict.fromkeys((id_field, *ID_FALLBACK_FIELDS)))):
        out = F.when(as_str(v, k) != "", F.lit(k)).otherwise(out)
    return out


def with_rid(records: DataFrame, id_field: str = "id", class_field: str = "ad_class") -> DataFrame:
    return records.withColumn(RID, stable_id(F.col(VAR), id_field, class_field))


def _pick(df: DataFrame, key: str, order: str, fn) -> DataFrame:
    others = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(fn(F.struct(*others), F.col(order)).alias("_row"))
    return picked.select(key, *[F.col("_row")[c].alias(c) for c in others])


def keep_first(df: DataFrame, key: str = RID, order: str = SEQ) -> DataFrame:
    """One row per key: the earliest in line order."""
    return _pick(df, key, order, F.min_by)


def keep_first_sparse(df: DataFrame, key: str = RID, order: str = SEQ) -> DataFrame:
    """:func:`keep_first` that aggregates only rows of duplicated IDs.

    IDs occurring more than once are found on the narrow key column and
    staged, so the planner knows their size and picks the join.  Rows with
    unique IDs pass an anti join; only the others are aggregated.  ``df`` is
    read three times: pass a staged table.
    """
    from corpusprep.sources.staging import stage

    dups = stage(df.groupBy(key).count().filter(F.col("count") > 1).select(key), "dup_ids")
    unique = df.join(dups, key, "left_anti")
    firsts = keep_first(df.join(dups, key, "left_semi"), key, order)
    return unique.unionByName(firsts.select(*unique.columns))


def keep_last(df: DataFrame, key: str = RID, order: str = SEQ) -> DataFrame:
    """One row per key: the latest in line order (lookup maps)."""
    return _pick(df, key, order, F.max_by)


def unprocessed(records: DataFrame, processed_ids: DataFrame | list[DataFrame], key: str = RID) -> DataFrame:
    """Records whose ID is not in ``processed_ids``: a frame with the column ``key`` (or one column of IDs), or
    several (``store.processed_ids``), each with an anti join of its own.

    Spark broadcasts an ID side when its bytes allow (no shuffle of the
    records); otherwise it is a shuffle anti join and AQE splits skewed keys.  A side bucketed
    by ID stays where it is: only the records are exchanged.
    """
    for part in processed_ids if isinstance(processed_ids, list) else [processed_ids]:
        ids = part.select(F.col(key if key in part.columns else part.columns[0]).alias(key))
        records = records.join(ids.filter(F.col(key).isNotNull()), key, "left_anti")
    return records


def store_union(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing store rows then new rows; columns may differ."""
    return existing.unionByName(new, allowMissingColumns=True)


def store_state(existing: DataFrame, new: DataFrame, key: str = RID) -> DataFrame:
    """Counters: distinct processed IDs, existing rows, new rows (one pass over the union)."""
    both = existing.select(key, F.lit(True).alias("_old")).unionByName(new.select(key, F.lit(False).alias("_old")))
    return both.agg(
        F.count_distinct(key).alias("processed_ids"),
        F.count_if(F.col("_old")).alias("existing_rows"),
        F.count_if(~F.col("_old")).alias("new_rows"),
    )
