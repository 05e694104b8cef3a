"""Fill missing text and titles from the archive.

Text (per stable ID), only for records whose own text is blank:
  text  <- archive text when that is not blank
  len   <- archive length when the record's own length is not an integer
  title <- archive title when the record's own title is blank
then records still without text are dropped and counted.

Titles (per ``id`` field): fill a blank title from the last non-blank archive
title; records without a match are kept as they are.

Only rows that change are re-serialised; all others keep their original line.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.fields import DEFAULT, Fields
from corpusprep.fixed import SHARDS_PER_BATCH
from corpusprep.functions.coerce import as_str, py_strip, shard_key, to_int
from corpusprep.functions.records import append_field, as_map, set_field, write_record
from corpusprep.operators.filtering import is_missing
from corpusprep.sources import archive as A
from corpusprep.sources.jsonl import LINE_STATUS_OK, STATUS, VAR
from corpusprep.sources.staging import stage


def enrich_text(records: DataFrame, archive: A.Archive | DataFrame, *, key: str = "_rid", fields: Fields = DEFAULT,
                stage_input: bool = True) -> DataFrame:
    """Records (with ``key``) after text enrichment, unresolved ones removed.

    Adds ``e_text``, ``e_len``, ``e_title`` (the final values) and rewrites
    ``value`` for changed rows.  The parsed VARIANT is not carried: the
    output is the line plus those columns.  Use :func:`enrich_text_counts` on the output of
    :func:`enrich_text_all` for the unresolved count.
    """
    return enrich_text_all(records, archive, key=key, fields=fields, stage_input=stage_input).filter(
        F.col("e_text") != ""
    )


NEEDS, OWN_LEN, OWN_TITLE = "_needs_text", "_own_len", "_own_title_e"


def with_own_fields(records: DataFrame, fields: Fields = DEFAULT) -> DataFrame:
    """Whether the record's text is missing, its length and title as columns; the parsed VARIANT
    is dropped, so that a staged table holds each text once, in its line."""
    if NEEDS in records.columns:
        return records
    v = F.col(VAR)
    out = records.select(
        "*", (as_str(v, fields.text) == "").alias(NEEDS), to_int(v, fields.length).alias(OWN_LEN),
        as_str(v, fields.title).alias(OWN_TITLE),
    )
    return out.drop(VAR)


def enrich_text_all(records: DataFrame, archive: A.Archive | DataFrame, *, key: str = "_rid", fields: Fields = DEFAULT,
                    stage_input: bool = True) -> DataFrame:
    """See :func:`enrich_text`; keeps unresolved records (``e_text`` blank)."""
    # the record side feeds both the key lookup and the join: materialise it
    # once instead of parsing the input twice; ``stage_input=False`` when
    # ``records`` already reads a staged table
    tagged = with_own_fields(records, fields)
    if stage_input:
        tagged = stage(tagged, "enrich_input")
    own_len, own_title = F.col(OWN_LEN), F.col(OWN_TITLE)
    wanted = tagged.filter(NEEDS).select(F.col(key).alias("_id"))
    found = A.lookup(archive, wanted, "_id", stage_keys=False).withColumnRenamed("a_id", key)
    joined = _join_needed(tagged, F.col(NEEDS), found, key)
    own_text = F.when(F.col(NEEDS), F.lit("")).otherwise(as_str(F.try_parse_json(py_strip(F.col("value"))), fields.text))
    hit = F.col(NEEDS) & F.col("a_text").isNotNull()
    new_text = F.when(hit, F.col("a_text")).otherwise(own_text)
    new_len = F.when(hit & own_len.isNull(), F.col("a_len")).otherwise(own_len)
    new_title = F.when(hit & (own_title == "") & (F.col("a_title") != ""), F.col("a_title")).otherwise(own_title)
    m = as_map(F.col("value"))
    m = set_field(m, fields.text, F.col("a_text").cast("variant"))
    m = F.when(new_len.isNotNull() & own_len.isNull(), set_field(m, fields.length, new_len.cast("variant"))).otherwise(m)
    m = F.when(new_title != own_title, set_field(m, fields.title, new_title.cast("variant"))).otherwise(m)
    changed = hit & (F.col("a_text") != "")
    out = joined.select(
        "*",
        new_text.alias("e_text"),
        new_len.alias("e_len"),
        new_title.alias("e_title"),
    )
    return out.withColumn("value", F.when(changed, write_record(m)).otherwise(F.col("value"))).drop(
        NEEDS, "a_text", "a_len", "a_title", "a_title_nb", OWN_LEN, OWN_TITLE
    )


def _join_needed(rows: DataFrame, needs, found: DataFrame, key: str) -> DataFrame:
    """Left-join ``found`` only to the rows that need it; the others pass
    through with NULL lookup columns, so they never cross a shuffle."""
    extra = [f for f in found.schema.fields if f.name != key]
    needs = F.coalesce(needs, F.lit(False))
    joined = rows.filter(needs).join(found, key, "left")
    passed = rows.filter(~needs).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])
    return passed.unionByName(joined.select(*passed.columns))


def enrich_text_counts(enriched_all: DataFrame) -> DataFrame:
    return enriched_all.agg(
        F.count("*").alias("records"),
        F.count_if(F.col("e_text") == "").alias("unresolved_records"),
    )


# ------------------------------------------------------------------ titles
def missing_title_ids(parsed: DataFrame, fields: Fields = DEFAULT) -> DataFrame:
    """Distinct IDs of valid records with a blank title, sorted."""
    v = F.col(VAR)
    ok = parsed.filter(F.col(STATUS) == LINE_STATUS_OK)
    ids = ok.filter(is_missing(v, fields.title)).select(as_str(v, fields.id).alias("id"))
    return ids.filter(F.col("id") != "").distinct().orderBy("id")


def missing_title_counts(parsed: DataFrame, fields: Fields = DEFAULT) -> DataFrame:
    v = F.col(VAR)
    ok = F.col(STATUS) == LINE_STATUS_OK
    no_title = ok & is_missing(v, fields.title)
    return parsed.agg(
        F.count_if(ok).alias("valid_records"),
        F.count_if(no_title & (as_str(v, fields.id) == "")).alias("missing_id_records"),
        F.count_if((F.col(STATUS) != LINE_STATUS_OK) & (F.col(STATUS) != "blank")).alias("invalid_json_lines"),
    )


def _with_own_title(parsed: DataFrame, fields: Fields) -> DataFrame:
    """Non-blank lines with ID and own title; the parsed VARIANT is dropped."""
    v = F.col(VAR)
    cols = [c for c in parsed.columns if c != VAR]
    return parsed.filter(F.col(STATUS) != "blank").select(
        *cols, as_str(v, fields.id).alias("_tid"), as_str(v, fields.title).alias("_own_title"))


def title_states(parsed: DataFrame, archive: A.Archive | DataFrame, fields: Fields = DEFAULT) -> DataFrame:
    """Every non-blank line; of valid records the blank titles are filled and ``t_state`` is
    ``had`` / ``enriched`` / ``missing``, of other lines it is NULL.

    One scan stages the IDs that need a title, nothing else; the second one writes: only its records
    without a title meet the titles found, all other lines stay in their task.
    """
    tagged = _with_own_title(parsed, fields)
    ok, blank = F.col(STATUS) == LINE_STATUS_OK, F.col("_own_title") == ""
    titles = A.lookup(archive, tagged.filter(ok & blank).select(F.col("_tid").alias("_id")), "_id").select(
        F.col("a_id").alias("_tid"), "a_title_nb")
    joined = _join_needed(tagged, ok & blank, titles, "_tid")
    fetched = F.coalesce(F.col("a_title_nb"), F.lit(""))
    state = F.when(ok, F.when(~blank, F.lit("had")).when(fetched != "", F.lit("enriched")).otherwise(F.lit("missing")))
    return _with_title(joined, state, fetched, fields)


def enrich_titles(parsed: DataFrame, archive: A.Archive | DataFrame, fields: Fields = DEFAULT) -> DataFrame:
    """Valid records with blank titles filled; ``t_state`` is
    ``had`` / ``enriched`` / ``missing`` per record.  The parsed VARIANT is not
    carried (the output is the rewritten ``value`` line)."""
    return title_states(parsed, archive, fields).filter(F.col("t_state").isNotNull())


def _with_title(joined: DataFrame, state, fetched, fields: Fields) -> DataFrame:
    out = joined.select(
        *[F.col(c) for c in joined.columns if c != "a_title_nb"],
        state.alias("t_state"),
        F.when(state == "enriched", fetched).otherwise(F.col("_own_title")).alias("t_title"),
        fetched.alias("_fetched"),
    )
    line = py_strip(F.col("value"))
    m = set_field(as_map(line), fields.title, F.col("_fetched").cast("variant"))
    # a line that may carry the key takes the exact map route; others get the
    # title appended as text (no second parse)
    maybe_has = line.contains(json.dumps(fields.title))
    rewritten = F.when(maybe_has, write_record(m)).otherwise(append_field(line, fields.title, F.col("_fetched")))
    return out.withColumn(
        "value", F.when(F.col("t_state") == "enriched", rewritten).otherwise(F.col("value"))
    ).drop("_fetched")


def title_stats(parsed: DataFrame, archive: A.Archive | DataFrame, fields: Fields = DEFAULT) -> DataFrame:
    """Counters of the title job: written, enriched, already had, still missing, invalid.

    One aggregation over all non-blank lines: invalid ones carry a NULL state.
    """
    states = title_states(parsed, archive, fields)
    t = F.col("t_state")
    return states.agg(
        F.count_if(t.isNotNull()).alias("total_records_written"),
        F.count_if(t == "enriched").alias("records_enriched_with_title"),
        F.count_if(t == "had").alias("records_already_had_title"),
        F.count_if(t == "missing").alias("records_still_missing_title"),
        F.count_if(t.isNull()).alias("invalid_json_lines_skipped"),
    )


# ------------------------------------------------------------------ shard plan
def shard_plan(ids: DataFrame, shards_per_batch: int = SHARDS_PER_BATCH, id_col: str = "id") -> DataFrame:
    """IDs per archive shard and the batch each shard falls in (sorted shards
    packed ``shards_per_batch`` at a time) -- a report; Spark does its own batching."""
    per_shard = ids.groupBy(shard_key(F.col(id_col)).alias("shard")).agg(F.count("*").alias("n_ids"))
    ranked = dense_index(per_shard, "shard")
    return ranked.select("shard", "n_ids", F.floor(F.col("_index") / shards_per_batch).cast("bigint").alias("batch"))


def dense_index(df: DataFrame, order_col: str) -> DataFrame:
    """0-based position of each row in ``order_col`` order, without a one-task window.

    Rows are range-partitioned and numbered within each partition; partition
    offsets come from a per-partition count (one row per partition).
    """
    parted = df.repartitionByRange(order_col).withColumn("_pid", F.spark_partition_id())
    local = parted.withColumn("_local", F.row_number().over(Window.partitionBy("_pid").orderBy(order_col)) - 1)
    # both branches below must see the same partition ids: materialise once
    local = local.checkpoint()
    sizes = local.groupBy("_pid").agg(F.count("*").alias("_n"))
    offsets = sizes.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off")
    )
    return local.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_local") + F.coalesce(F.col("_off"), F.lit(0))).alias("_index")
    )
