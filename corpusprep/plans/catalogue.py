"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their
DuckDB oracle SQL over the same driver tables.

Each query builds its input with :mod:`corpusprep.plans.views` (record
JSONL derived by Spark from ``documents``/``nation``, written once per
session and read with the engine's scan), runs one operator or job of the
library over the whole input, and returns flat, aliased columns.  The SQL
next to it states the same result directly over the parquet tables, using
the view rules of :mod:`corpusprep.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.fields import DEFAULT, Fields
from corpusprep.functions import coerce
from corpusprep.functions.coerce import as_str, to_float, to_int
from corpusprep.operators import classify as C
from corpusprep.operators import enrich, filtering, identity, keywords, profile, sampling, split
from corpusprep.plans import doubles, jobs
from corpusprep.plans import oracle as O
from corpusprep.plans import views as V
from corpusprep.session import scratch_path
from corpusprep.sources import archive, folder, providers
from corpusprep.sources import store as store_store
from corpusprep.sources.jsonl import SEQ, VAR, read_jsonl, valid_records, write_jsonl
from corpusprep.sources.staging import stage

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _typed(records: DataFrame) -> DataFrame:
    """The core record fields, typed, under their field names."""
    from corpusprep.operators.records import with_core_fields

    t = with_core_fields(records, DEFAULT)
    return t.select(
        F.col("_id").alias("id"), F.col("_lang").alias("lg"), F.col("_type").alias("tp"),
        F.col("_quality").alias("ocrqa"), F.col("_len").alias("len"),
    )


# ---------------------------------------------------------------- filter job
FILTER_EXAMPLE = dict(tp="article", min_quality=0.7, min_length=550)


def _filter_sql(where: str) -> str:
    return O.with_ctes(O.RECORDS, body=f"SELECT id, lg, tp, ocrqa, len FROM records WHERE {where}")


@register("filter_records", _filter_sql("tp = 'article' AND ocrqa >= 0.7 AND len >= 550"))
def q_filter_records(spark, sf_dir):
    return _typed(filtering.filter_records(V.records(spark, sf_dir), **FILTER_EXAMPLE))


@register("filter_tp", _filter_sql("tp = 'article'"))
def q_filter_tp(spark, sf_dir):
    return _typed(filtering.filter_records(V.records(spark, sf_dir), tp="article"))


@register("filter_ocrqa", _filter_sql("ocrqa >= 0.8"))
def q_filter_ocrqa(spark, sf_dir):
    return _typed(filtering.filter_records(V.records(spark, sf_dir), min_quality=0.8))


@register("filter_len", _filter_sql("len >= 550"))
def q_filter_len(spark, sf_dir):
    return _typed(filtering.filter_records(V.records(spark, sf_dir), min_length=550))


@register("filter_type_norm", _filter_sql("tp = 'page'"))
def q_filter_type_norm(spark, sf_dir):
    recs = V.records(spark, sf_dir)
    return _typed(recs.filter(filtering.type_matches(F.col(VAR), "tp", "  page ")))


@register(
    "filter_counts",
    O.with_ctes(
        O.RECORDS,
        body="""SELECT count(*) AS total_records,
  count(*) FILTER (WHERE doc_id % 17 <> 0 AND tp = 'article' AND ocrqa >= 0.7 AND len >= 550) AS kept_records,
  count(*) - count(*) FILTER (WHERE doc_id % 17 <> 0 AND tp = 'article' AND ocrqa >= 0.7 AND len >= 550) AS dropped_records,
  count(*) FILTER (WHERE doc_id % 17 = 0) AS invalid_json_lines
FROM records""",
    ),
)
def q_filter_counts(spark, sf_dir):
    return filtering.filter_counts(V.records_dirty(spark, sf_dir), **FILTER_EXAMPLE)


# ---------------------------------------------------------------- text profile
@register(
    "text_profile",
    O.with_ctes(
        O.RECORDS,
        body=f"""SELECT id, length(ft) AS length,
  CASE WHEN length(ft) > 0 THEN round(length(regexp_replace(ft, '[^\\p{{L}}\\p{{N}}_]+', '', 'g')) / length(ft), 3)
       ELSE 0.0 END AS alphabetic_ratio,
  '{V.RUN_TS}' AS ts
FROM records""",
    ),
)
def q_text_profile(spark, sf_dir):
    return profile.text_profile(V.records(spark, sf_dir), run_ts=V.RUN_TS)


# ---------------------------------------------------------------- scalar rules
@register(
    "record_length",
    O.with_ctes(
        O.RECORDS,
        body="""SELECT id, CASE WHEN doc_id % 4 IN (0, 1) THEN length(trim(ft)) ELSE len END AS record_len
FROM records""",
    ),
)
def q_record_length(spark, sf_dir):
    d = F.col("doc_id")
    rows = V.record_rows(spark, sf_dir).withColumn(
        "len", F.when(d % 4 == 0, F.lit(None)).when(d % 4 == 1, F.lit(-1)).otherwise(F.col("len"))
    )
    v = F.col(VAR)
    recs = V.parse_lines(V.as_lines(rows))
    text = F.try_variant_get(v, "$['ft']", "string")
    return recs.select(
        as_str(v, "id").alias("id"), coerce.record_length(to_int(v, "len"), text).alias("record_len")
    )


@register(
    "language_bucket",
    O.with_ctes(
        O.RECORDS,
        O.LANG_VARIANTS,
        body=f"SELECT id, {O.BUCKET_EXPR.format(x='lg')} AS lang_bucket FROM langs",
    ),
)
def q_language_bucket(spark, sf_dir):
    v = F.col(VAR)
    recs = V.records_langs(spark, sf_dir, dirty=False)
    return recs.select(as_str(v, "id").alias("id"), coerce.lang_bucket(as_str(v, "lg")).alias("lang_bucket"))


@register(
    "stable_id",
    O.with_ctes(
        O.RECORDS,
        body="""SELECT newspaper, CAST(yr AS BIGINT) AS yr, len,
  CASE WHEN doc_id % 5 = 1 THEN 'c_id' WHEN doc_id % 5 = 2 THEN 'hash' ELSE 'id' END AS rid_kind,
  CASE WHEN doc_id % 5 = 1 THEN 'c-' || CAST(doc_id AS VARCHAR) WHEN doc_id % 5 = 2 THEN NULL ELSE id END AS rid,
  CASE WHEN doc_id % 5 = 1 THEN length('c-' || CAST(doc_id AS VARCHAR)) WHEN doc_id % 5 = 2 THEN 40
       ELSE length(id) END AS rid_len
FROM records""",
    ),
)
def q_stable_id(spark, sf_dir):
    d = F.col("doc_id")
    rows = (
        V.record_rows(spark, sf_dir)
        .withColumn("c_id", F.when(d % 5 == 1, F.concat(F.lit("c-"), d.cast("string"))))
        .withColumn("id", F.when(d % 5 == 1, F.lit("")).when(d % 5 == 2, F.lit(None)).otherwise(F.col("id")))
        .withColumn("ad_class", F.when(d % 2 == 0, F.lit("ad")))
    )
    v = F.col(VAR)
    recs = V.parse_lines(V.as_lines(rows))
    rid = identity.stable_id(v, "id", "ad_class")
    kind = identity.stable_id_kind(v, "id")
    return recs.select(
        as_str(v, "newspaper").alias("newspaper"),
        to_int(v, "yr").alias("yr"),
        to_int(v, "len").alias("len"),
        kind.alias("rid_kind"),
        F.when(kind != "hash", rid).alias("rid"),
        F.char_length(rid).cast("bigint").alias("rid_len"),
    )


# ---------------------------------------------------------------- split job
@register(
    "discover_languages",
    O.with_ctes(
        O.RECORDS,
        O.LANG_VARIANTS,
        body="SELECT DISTINCT trim(lg) AS lg FROM langs WHERE tp = 'article' AND trim(lg) <> '' ORDER BY 1",
    ),
)
def q_discover_languages(spark, sf_dir):
    recs = V.records_langs(spark, sf_dir, dirty=False)
    return sampling.discover_languages(recs, lang_field="lg", type_field="tp", type_value="article")


def _split(spark, sf_dir):
    out = scratch_path(spark, "per_language")
    return split.split_by_language(
        V.records_langs(spark, sf_dir), out, input_path="records.jsonl", display_prefix="per_language"
    )


_SPLIT_STATS = f"""stats AS (
  SELECT {O.BUCKET_EXPR.format(x='lg')} AS language, count(*) AS records, CAST(sum(len) AS BIGINT) AS total_len
  FROM langs WHERE NOT broken GROUP BY 1)"""


@register(
    "split_summary",
    O.with_ctes(
        O.RECORDS,
        O.LANG_VARIANTS,
        _SPLIT_STATS,
        body="""SELECT 'records.jsonl' AS input_path, 'per_language' AS output_prefix, 'lg' AS language_field,
  'len' AS length_field,
  (SELECT CAST(sum(records) AS BIGINT) FROM stats) AS total_records,
  (SELECT CAST(sum(total_len) AS BIGINT) FROM stats) AS total_len,
  (SELECT count(*) FROM langs WHERE broken) AS invalid_json_lines,
  (SELECT string_agg(language, ',' ORDER BY language) FROM stats) AS languages,
  (SELECT CAST(to_json(list(struct_pack(language := language, records := records, total_len := total_len,
      output_path := 'per_language/lang_bucket=' || language) ORDER BY language)) AS VARCHAR) FROM stats)
    AS languages_summary""",
    ),
)
def q_split_summary(spark, sf_dir):
    s = _split(spark, sf_dir).summary
    return s.select(
        *[c for c in s.columns if c not in ("languages", "languages_summary")],
        F.array_join("languages", ",").alias("languages"),
        F.to_json("languages_summary").alias("languages_summary"),
    )


@register(
    "split_by_language",
    O.with_ctes(
        O.RECORDS,
        O.LANG_VARIANTS,
        body=f"SELECT {O.BUCKET_EXPR.format(x='lg')} AS lang_bucket, id, len FROM langs WHERE NOT broken",
    ),
)
def q_split_by_language(spark, sf_dir):
    res = _split(spark, sf_dir)
    back = V.parse_lines(split.read_split(spark, res.output_prefix))
    v = F.col(VAR)
    return back.select("lang_bucket", as_str(v, "id").alias("id"), to_int(v, "len").alias("len"))


# ---------------------------------------------------------------- enrichment
def _archive(spark, sf_dir):
    return archive.Archive(spark, V.archive_path(spark, sf_dir))


@register(
    "enrich_text",
    O.with_ctes(
        O.RECORDS,
        O.NO_TEXT,
        O.ARCHIVE,
        body=f"""SELECT r.id,
  CASE WHEN r.ft IS NULL AND r.len IS NULL THEN a.len ELSE r.len END AS len,
  CASE WHEN r.ft IS NULL THEN coalesce({O.py_strip('a.title')}, '') ELSE '' END AS title,
  md5(coalesce(r.ft, {O.py_strip('a.ft')})) AS ft_md5
FROM no_text r LEFT JOIN archive a ON a.id = r.id
WHERE r.ft IS NOT NULL OR a.ft IS NOT NULL""",
    ),
)
def q_enrich_text(spark, sf_dir):
    recs = identity.with_rid(valid_records(V.records_no_text(spark, sf_dir)))
    out = enrich.enrich_text(recs, _archive(spark, sf_dir))
    return out.select(
        F.col(identity.RID).alias("id"),
        F.col("e_len").alias("len"),
        F.col("e_title").alias("title"),
        F.md5("e_text").alias("ft_md5"),
    )


_MISSING = """missing AS (
  SELECT DISTINCT id FROM titled WHERE NOT broken AND trim(coalesce(title, '')) = '' AND id <> '')"""


@register(
    "missing_title_ids",
    O.with_ctes(O.RECORDS, O.TITLES, _MISSING, body="SELECT id FROM missing ORDER BY id"),
)
def q_missing_title_ids(spark, sf_dir):
    return enrich.missing_title_ids(V.records_titles(spark, sf_dir))


_TITLE_JOIN = f"""joined AS (
  SELECT t.id,
    CASE WHEN trim(coalesce(t.title, '')) <> '' THEN 'had'
         WHEN a.id IS NOT NULL AND {O.py_strip('a.title')} <> '' THEN 'enriched'
         ELSE 'missing' END AS t_state,
    CASE WHEN trim(coalesce(t.title, '')) <> '' THEN trim(t.title)
         WHEN a.id IS NOT NULL AND {O.py_strip('a.title')} <> '' THEN {O.py_strip('a.title')}
         ELSE '' END AS title
  FROM titled t LEFT JOIN archive a ON a.id = t.id AND t.id <> ''
  WHERE NOT t.broken)"""


@register(
    "enrich_title",
    O.with_ctes(O.RECORDS, O.TITLES, O.ARCHIVE, _TITLE_JOIN, body="SELECT id, title, t_state FROM joined"),
)
def q_enrich_title(spark, sf_dir):
    out = enrich.enrich_titles(V.records_titles(spark, sf_dir), _archive(spark, sf_dir))
    return out.select(F.col("_tid").alias("id"), F.col("t_title").alias("title"), "t_state")


@register(
    "title_stats",
    O.with_ctes(
        O.RECORDS,
        O.TITLES,
        O.ARCHIVE,
        _TITLE_JOIN,
        body="""SELECT count(*) AS total_records_written,
  count(*) FILTER (WHERE t_state = 'enriched') AS records_enriched_with_title,
  count(*) FILTER (WHERE t_state = 'had') AS records_already_had_title,
  count(*) FILTER (WHERE t_state = 'missing') AS records_still_missing_title,
  (SELECT count(*) FROM titled WHERE broken) AS invalid_json_lines_skipped
FROM joined""",
    ),
)
def q_title_stats(spark, sf_dir):
    return enrich.title_stats(V.records_titles(spark, sf_dir), _archive(spark, sf_dir))


@register(
    "title_job",
    O.with_ctes(
        O.RECORDS,
        O.TITLES,
        O.ARCHIVE,
        _TITLE_JOIN,
        body="""SELECT id, title, n.* FROM joined, (SELECT count(*) AS total_records_written,
  count(*) FILTER (WHERE t_state = 'enriched') AS records_enriched_with_title,
  count(*) FILTER (WHERE t_state = 'had') AS records_already_had_title,
  count(*) FILTER (WHERE t_state = 'missing') AS records_still_missing_title,
  (SELECT count(*) FROM titled WHERE broken) AS invalid_json_lines_skipped FROM joined) n""",
    ),
)
def q_title_job(spark, sf_dir):
    """The file that the title job wrote, with the counters it returned beside every row."""
    out = scratch_path(spark, "titles")
    counters = jobs.title_job(V.records_titles(spark, sf_dir), _archive(spark, sf_dir), out).first()
    v = F.col(VAR)
    return valid_records(read_jsonl(spark, out)).select(
        as_str(v, "id").alias("id"), as_str(v, "title").alias("title"),
        *[F.lit(counters[c]).cast("bigint").alias(c) for c in jobs.TITLE_COUNTERS])


@register(
    "archive_lookup",
    O.with_ctes(
        O.RECORDS,
        O.TITLES,
        O.ARCHIVE,
        _MISSING,
        body=f"""SELECT a.id, md5({O.py_strip('a.ft')}) AS ft_md5, a.len, {O.py_strip('a.title')} AS title
FROM archive a WHERE a.id IN (SELECT id FROM missing)""",
    ),
)
def q_archive_lookup(spark, sf_dir):
    ids = enrich.missing_title_ids(V.records_titles(spark, sf_dir))
    found = archive.lookup(_archive(spark, sf_dir), ids, "id")
    return found.select(
        F.col("a_id").alias("id"), F.md5("a_text").alias("ft_md5"), F.col("a_len").alias("len"),
        F.col("a_title").alias("title"),
    )


@register(
    "shard_plan",
    O.with_ctes(
        O.RECORDS,
        O.TITLES,
        _MISSING,
        body="""SELECT shard, n_ids, CAST((dense_rank() OVER (ORDER BY shard) - 1) // 120 AS BIGINT) AS batch
FROM (SELECT CASE WHEN contains(id, '-') THEN split_part(id, '-', 1) || '-' || split_part(id, '-', 2) ELSE id END AS shard, count(*) AS n_ids
      FROM missing GROUP BY 1)""",
    ),
)
def q_shard_plan(spark, sf_dir):
    ids = enrich.missing_title_ids(V.records_titles(spark, sf_dir))
    return enrich.shard_plan(ids, 120, "id")


# ---------------------------------------------------------------- identity, store, sampling
@register("unprocessed_anti", O.with_ctes(O.RECORDS, body="SELECT id FROM records WHERE doc_id % 7 <> 0"))
def q_unprocessed_anti(spark, sf_dir):
    recs = identity.with_rid(valid_records(V.records(spark, sf_dir)))
    store = identity.with_rid(V.store_lines(spark, sf_dir))
    return identity.unprocessed(recs, store.select(identity.RID)).select(F.col(identity.RID).alias("id"))


SAMPLE_N = 100


@register(
    "sample_per_language",
    O.with_ctes(
        O.RECORDS,
        body=f"""SELECT lg, id FROM (
  SELECT lg, id, row_number() OVER (PARTITION BY lg ORDER BY md5('42:' || id), id) AS rn
  FROM records WHERE tp = 'article' AND doc_id % 7 <> 0) WHERE rn <= {SAMPLE_N}""",
    ),
)
def q_sample_per_language(spark, sf_dir):
    p = jobs.ClassifyParams(doubles.rule_model)
    store = identity.with_rid(V.store_lines(spark, sf_dir))
    tagged = jobs.tag_records(V.records(spark, sf_dir), p)
    cands = identity.unprocessed(tagged, store.select(identity.RID))
    picked = sampling.sample_per_language(cands, SAMPLE_N, seed=42, fetch_from=tagged)
    return picked.select(F.col(sampling.LANG).alias("lg"), F.col(identity.RID).alias("id"))


@register(
    "non_ad_counts",
    O.with_ctes(O.RECORDS, O.PROCESSED,
                body="SELECT lg, count(*) AS non_ads FROM processed WHERE ad_class = 'non-ad' AND lg <> '' GROUP BY lg"),
)
def q_non_ad_counts(spark, sf_dir):
    return jobs.non_ad_counts(V.store_lines(spark, sf_dir))


EXPORT_N = 20


@register(
    "non_ad_export",
    O.with_ctes(
        O.RECORDS,
        O.PROCESSED,
        body=f"""SELECT language, id FROM (
  SELECT coalesce(nullif(lg, ''), 'unknown') AS language, id,
    row_number() OVER (PARTITION BY coalesce(nullif(lg, ''), 'unknown') ORDER BY doc_id) AS rn
  FROM processed WHERE ad_class = 'non-ad') WHERE rn <= {EXPORT_N}""",
    ),
)
def q_non_ad_export(spark, sf_dir):
    out = jobs.non_ad_export(V.store_lines(spark, sf_dir), EXPORT_N)
    return out.select("language", as_str(F.col(VAR), "id").alias("id"))


_DUPS = """dups AS (
  SELECT id, tp, len, doc_id AS seq FROM records
  UNION ALL SELECT id, 'dup' AS tp, len, doc_id + 1000000000 AS seq FROM records WHERE doc_id % 8 = 0)"""


@register(
    "dedup_first",
    O.with_ctes(O.RECORDS, _DUPS, body="SELECT id, arg_min(tp, seq) AS tp FROM dups GROUP BY id"),
)
def q_dedup_first(spark, sf_dir):
    recs = identity.with_rid(V.duplicated_lines(spark, sf_dir))
    first = identity.keep_first(recs.select(identity.RID, SEQ, VAR))
    return first.select(F.col(identity.RID).alias("id"), as_str(F.col(VAR), "tp").alias("tp"))


@register(
    "dedup_last",
    O.with_ctes(O.RECORDS, _DUPS, body="SELECT id, arg_max(tp, seq) AS tp FROM dups GROUP BY id"),
)
def q_dedup_last(spark, sf_dir):
    recs = identity.with_rid(V.duplicated_lines(spark, sf_dir))
    last = identity.keep_last(recs.select(identity.RID, SEQ, VAR))
    return last.select(F.col(identity.RID).alias("id"), as_str(F.col(VAR), "tp").alias("tp"))


def _new_rows(spark, sf_dir, store):
    """New labelled rows of a run over the records that are not in ``store`` (native rule label)."""
    recs = identity.with_rid(valid_records(V.records(spark, sf_dir)))
    new = identity.unprocessed(recs, store.select(identity.RID))
    return new.withColumn("ad_class", doubles.rule_label(as_str(F.col(VAR), "ft"))).withColumn("run_id", F.lit("r1"))


@register(
    "store_union",
    O.with_ctes(
        O.RECORDS,
        O.PROCESSED,
        body=f"""SELECT id, ad_class, CAST(NULL AS VARCHAR) AS run_id FROM processed
UNION ALL SELECT id, {O.AD_RULE.format(t='ft')} AS ad_class, 'r1' AS run_id FROM records WHERE doc_id % 7 <> 0""",
    ),
)
def q_store_union(spark, sf_dir):
    store = identity.with_rid(V.store_lines(spark, sf_dir))
    old = store.select(identity.RID, as_str(F.col(VAR), "ad_class").alias("ad_class"))
    new = _new_rows(spark, sf_dir, store).select(identity.RID, "ad_class", "run_id")
    both = identity.store_union(old, new)
    return both.select(F.col(identity.RID).alias("id"), "ad_class", "run_id")


@register(
    "store_state",
    O.with_ctes(
        O.RECORDS,
        O.PROCESSED,
        body="""SELECT (SELECT count(DISTINCT id) FROM records) AS processed_ids,
  (SELECT count(*) FROM processed) + (SELECT count(*) FROM processed WHERE doc_id % 14 = 0) AS existing_rows,
  (SELECT count(*) FROM records WHERE doc_id % 7 <> 0) AS new_rows""",
    ),
)
def q_store_state(spark, sf_dir):
    # read three times: the IDs are staged, so that the store's lines are parsed once
    number = V.id_number(as_str(F.col(VAR), "id")).alias("number")
    store = stage(identity.with_rid(V.store_lines(spark, sf_dir)).select(identity.RID, number), "store_ids")
    # existing stores are copied without dedup: rows of doc_id%14=0 appear twice
    existing = store.unionByName(store.filter(F.col("number") % 14 == 0))
    return identity.store_state(existing, _new_rows(spark, sf_dir, store))


# ---------------------------------------------------------------- classification
@register(
    "classify_labels",
    O.with_ctes(O.RECORDS, body=f"SELECT id, {O.AD_RULE.format(t='ft')} AS ad_class FROM records"),
)
def q_classify_labels(spark, sf_dir):
    v = F.col(VAR)
    recs = valid_records(V.records(spark, sf_dir))
    label = C.classify(as_str(v, "ft"), as_str(v, "id"), doubles.rule_model)
    return recs.select(as_str(v, "id").alias("id"), label.alias("ad_class"))


_ENRICHED_REST = f"""rest AS (
  SELECT r.id, r.lg, r.doc_id,
    coalesce(r.ft, {O.py_strip('a.ft')}) AS text,
    CASE WHEN r.ft IS NULL AND r.len IS NULL THEN a.len ELSE r.len END AS len
  FROM no_text r LEFT JOIN archive a ON a.id = r.id
  WHERE r.tp = 'article' AND r.doc_id % 7 <> 0 AND (r.ft IS NOT NULL OR a.ft IS NOT NULL))"""


@register(
    "retention_estimate",
    O.with_ctes(
        O.RECORDS,
        O.NO_TEXT,
        O.ARCHIVE,
        _ENRICHED_REST,
        body=f"""SELECT count(*) AS newly_classified_records,
  count(*) FILTER (WHERE {O.AD_RULE.format(t='text')} = 'non-ad') AS remaining_non_ad_count,
  CAST(coalesce(sum(CASE WHEN {O.AD_RULE.format(t='text')} = 'non-ad'
      THEN CASE WHEN len >= 0 THEN len ELSE length(text) END END), 0) AS BIGINT) AS remaining_non_ad_chars
FROM rest""",
    ),
)
def q_retention_estimate(spark, sf_dir):
    store = identity.with_rid(V.store_lines(spark, sf_dir))
    labelled = jobs.classify_rest(V.records_no_text(spark, sf_dir), store, _archive(spark, sf_dir),
                                  jobs.ClassifyParams(doubles.rule_model))
    return jobs.retention_estimate(labelled)


RUN_POOL = 60


@register(
    "incremental_new_only",
    O.with_ctes(
        O.RECORDS,
        O.NO_TEXT,
        O.ARCHIVE,
        body=f"""SELECT id, lg, {O.AD_RULE.format(t='text')} AS ad_class FROM (
  SELECT s.id, s.lg, coalesce(s.ft, {O.py_strip('a.ft')}) AS text
  FROM (SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY lg ORDER BY md5('42:' || id), id) AS rn
          FROM no_text WHERE tp = 'article' AND doc_id % 7 <> 0) WHERE rn <= {RUN_POOL}) s
  LEFT JOIN archive a ON a.id = s.id
  WHERE s.ft IS NOT NULL OR a.ft IS NOT NULL)""",
    ),
)
def q_incremental_new_only(spark, sf_dir):
    """Seed the store with the processed rows, run one sampling run, read back
    what that run appended."""
    store_path = scratch_path(spark, "store")
    store_store.append_run(V.store_lines(spark, sf_dir), store_path, "r0")
    p = jobs.ClassifyParams(doubles.rule_model, target_per_language=RUN_POOL // 2)
    jobs.run_sampling(spark, V.records_no_text(spark, sf_dir), store_path, _archive(spark, sf_dir), p, "r1")
    back = store_store.read_store(spark, store_path).filter(F.col("run_id") == "r1")
    v = F.col(VAR)
    return back.select(as_str(v, "id").alias("id"), as_str(v, "lg").alias("lg"), as_str(v, "ad_class").alias("ad_class"))


@register("ad_model_fit")
def q_ad_model_fit(spark, sf_dir):
    """Fit the text model on the labelled store; predict every record (rows only)."""
    from corpusprep.operators import admodel

    store = V.store_lines(spark, sf_dir)
    train = store.select(as_str(F.col(VAR), "ft").alias("text"), as_str(F.col(VAR), "ad_class").alias("label"))
    recs = valid_records(V.records(spark, sf_dir)).select(
        as_str(F.col(VAR), "id").alias("id"), as_str(F.col(VAR), "ft").alias("text")
    )
    return admodel.predict(admodel.fit(train), recs).select("id", "ad_class")


# ---------------------------------------------------------------- providers
def _listings(spark, sf_dir):
    return providers.read_providers(spark, V.providers_path(spark, sf_dir))


@register("provider_map", O.with_ctes(O.PROVIDERS, body="SELECT newspaper, country FROM pmap"))
def q_provider_map(spark, sf_dir):
    return providers.newspaper_country(_listings(spark, sf_dir))


@register(
    "provider_conflicts",
    O.with_ctes(
        O.PROVIDERS,
        body="""SELECT newspaper, count(DISTINCT country) AS n_countries FROM listing
GROUP BY newspaper HAVING count(DISTINCT country) > 1""",
    ),
)
def q_provider_conflicts(spark, sf_dir):
    return providers.conflicts(_listings(spark, sf_dir))


# ---------------------------------------------------------------- keyword job
KW_FIELDS = Fields(year="yr")


def _kw_input(spark, sf_dir):
    return folder.scan_language_folder(spark, V.keyword_folder(spark, sf_dir))


@register(
    "folder_scan",
    O.with_ctes(
        O.RECORDS,
        body=f"""SELECT {O.BUCKET_EXPR.format(x='lg')} AS language, count(*) AS records,
  CAST(sum(len) AS BIGINT) AS total_len FROM records GROUP BY 1""",
    ),
)
def q_folder_scan(spark, sf_dir):
    lines = valid_records(_kw_input(spark, sf_dir))
    return lines.groupBy(F.col(folder.LANG_FILE).alias("language")).agg(
        F.count("*").alias("records"), F.sum(to_int(F.col(VAR), "len")).cast("bigint").alias("total_len")
    )


FIRST_N = 30


@register(
    "first_n_per_file",
    O.with_ctes(
        O.RECORDS,
        body=f"""SELECT language, id FROM (
  SELECT {O.BUCKET_EXPR.format(x='lg')} AS language, id,
    row_number() OVER (PARTITION BY {O.BUCKET_EXPR.format(x='lg')} ORDER BY doc_id) AS rn FROM records)
WHERE rn <= {FIRST_N}""",
    ),
)
def q_first_n_per_file(spark, sf_dir):
    lines = valid_records(_kw_input(spark, sf_dir))
    first = sampling.first_n_per_group(lines, folder.SOURCE, FIRST_N, SEQ)
    return first.select(F.col(folder.LANG_FILE).alias("language"), as_str(F.col(VAR), "id").alias("id"))


@register(
    "newspaper_country",
    O.with_ctes(
        O.RECORDS,
        O.PROVIDERS,
        body="""SELECT r.id, r.newspaper, coalesce(p.country, '') AS country
FROM records r LEFT JOIN pmap p ON p.newspaper = r.newspaper""",
    ),
)
def q_newspaper_country(spark, sf_dir):
    recs = valid_records(V.records(spark, sf_dir))
    rid = as_str(F.col(VAR), "id")
    rows = recs.select(rid.alias("id"), coerce.newspaper_of(rid).alias("newspaper"))
    m = providers.newspaper_country(_listings(spark, sf_dir))
    out = rows.join(m, "newspaper", "left")
    return out.select("id", "newspaper", F.coalesce("country", F.lit("")).alias("country"))


@register(
    "prompt_build",
    O.with_ctes(
        O.RECORDS,
        O.PROVIDERS,
        O.KEYWORD_INPUT,
        body=f"""SELECT id, 'system' AS role_1, 'user' AS role_2,
  title || chr(10) || chr(10) || article || chr(10) || chr(10) || '[' || newspaper || ', ' || country || ', ' || year || ', ' || lg || ']'
    AS user_prompt,
  length(article) AS article_chars
FROM kreq""",
    ),
)
def q_prompt_build(spark, sf_dir):
    req = keywords.prompt_columns(valid_records(_kw_input(spark, sf_dir)), KW_FIELDS)
    m = providers.newspaper_country(_listings(spark, sf_dir)).withColumnRenamed("newspaper", "k_newspaper")
    req = req.join(m, "k_newspaper", "left").withColumn("k_country", F.coalesce("country", F.lit("")))
    msgs = keywords.messages(req)
    return req.select(
        F.col("k_id").alias("id"),
        msgs[0]["role"].alias("role_1"),
        msgs[1]["role"].alias("role_2"),
        msgs[1]["content"].alias("user_prompt"),
        F.char_length("k_article").cast("bigint").alias("article_chars"),
    )


def _kw_results(spark, sf_dir):
    recs = valid_records(_kw_input(spark, sf_dir))
    m = providers.newspaper_country(_listings(spark, sf_dir))
    replies = keywords.generate(recs, m, doubles.recorded_completer, fields=KW_FIELDS)
    return keywords.with_results(replies)


@register(
    "keyword_generate",
    O.with_ctes(
        O.RECORDS,
        O.PROVIDERS,
        O.KEYWORD_INPUT,
        body="""SELECT id, NOT parsed AS failed,
  CASE WHEN parsed THEN newspaper || '|' || lg || ' press|year ' || year ELSE '' END AS keywords,
  prompt_tokens, completion_tokens, total_tokens FROM kres""",
    ),
)
def q_keyword_generate(spark, sf_dir):
    res = _kw_results(spark, sf_dir)
    u = F.col("k_usage")
    return res.select(
        F.col("k_id").alias("id"),
        F.col("k_failed").alias("failed"),
        F.array_join("k_keywords", "|").alias("keywords"),
        F.coalesce(u["prompt_tokens"], F.lit(0)).alias("prompt_tokens"),
        F.coalesce(u["completion_tokens"], F.lit(0)).alias("completion_tokens"),
        F.coalesce(u["total_tokens"], F.lit(0)).alias("total_tokens"),
    )


@register(
    "keyword_summary",
    O.with_ctes(
        O.RECORDS,
        O.PROVIDERS,
        O.KEYWORD_INPUT,
        body=f"""SELECT coalesce(bucket, 'TOTAL') AS language, count(*) AS records,
  count(*) FILTER (WHERE NOT parsed) AS failed_records,
  count(*) FILTER (WHERE parsed) AS records_with_keywords,
  CAST(sum(length(article)) AS BIGINT) AS article_chars,
  CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
  CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
  count(*) FILTER (WHERE usage_missing) AS usage_missing_records
FROM (SELECT *, {O.BUCKET_EXPR.format(x='lg')} AS bucket FROM kres) GROUP BY ROLLUP (bucket)""",
    ),
)
def q_keyword_summary(spark, sf_dir):
    stats = keywords.keyword_stats(_kw_results(spark, sf_dir), folder.LANG_FILE)
    return stats.select(
        F.coalesce(F.col(folder.LANG_FILE), F.lit("TOTAL")).alias("language"),
        *[c for c in stats.columns if c not in (folder.LANG_FILE, "_is_total")],
    )


@register(
    "keywords_output",
    O.with_ctes(
        O.RECORDS,
        O.PROVIDERS,
        O.KEYWORD_INPUT,
        body="""SELECT id,
  CASE WHEN doc_id % 2 = 0 THEN 'id,lg,yr,tp,len,title,keywords,ft' ELSE 'id,lg,yr,tp,len,keywords,ft' END AS key_order,
  CASE WHEN parsed THEN newspaper || '|' || lg || ' press|year ' || year ELSE '' END AS keywords
FROM kres""",
    ),
)
def q_keywords_output(spark, sf_dir):
    res = keywords.output_lines(_kw_results(spark, sf_dir), KW_FIELDS)
    out = scratch_path(spark, "keywords_out")
    write_jsonl(res.select("value", SEQ, F.col(folder.LANG_FILE).alias("lang_file")), out,
                      partition_by=["lang_file"])
    back = V.parse_lines(spark.read.schema("value string, lang_file string").text(out))
    v = F.col(VAR)
    return back.select(
        as_str(v, "id").alias("id"),
        F.array_join(F.json_object_keys("value"), ",").alias("key_order"),
        F.array_join(F.try_variant_get(v, "$.keywords", "array<string>"), "|").alias("keywords"),
    )


# ---------------------------------------------------------------- reply parsing
_REPLY_KW = """CASE WHEN doc_id % 10 = 0 OR doc_id % 11 = 0 OR doc_id % 17 = 0 OR doc_id % 19 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN ''
  ELSE newspaper || '|' || lg || ' press|3' END"""


@register(
    "keyword_reply_parse",
    O.with_ctes(
        O.RECORDS,
        body=f"""SELECT id, NOT (doc_id % 10 = 0 OR doc_id % 11 = 0 OR doc_id % 17 = 0 OR doc_id % 19 = 0) AS parsed, {_REPLY_KW} AS keywords FROM records""",
    ),
)
def q_keyword_reply_parse(spark, sf_dir):
    r = V.reply_rows(spark, sf_dir).withColumn("_doc", keywords.parse_reply(F.col("reply")))
    r = r.withColumn("_kw", keywords.parse_keywords(F.col("_doc")))
    kws = F.col("_kw")
    return r.select("id", kws.isNotNull().alias("parsed"), F.array_join(kws, "|").alias("keywords"))


@register(
    "token_usage",
    O.with_ctes(
        O.RECORDS,
        body="""SELECT id,
  CASE WHEN doc_id % 9 <> 0 THEN len // 4 + 20 ELSE 0 END AS prompt_tokens,
  CAST(CASE WHEN doc_id % 9 <> 0 THEN 12 ELSE 0 END AS BIGINT) AS completion_tokens,
  CASE WHEN doc_id % 9 <> 0 THEN len // 4 + 32 ELSE 0 END AS total_tokens,
  doc_id % 9 <> 0 AS usage_present
FROM records""",
    ),
)
def q_token_usage(spark, sf_dir):
    r = V.reply_rows(spark, sf_dir)
    u = keywords.token_usage(F.col("prompt_tokens"), F.col("completion_tokens"), F.col("total_tokens"))
    return r.select("id", u["prompt_tokens"].alias("prompt_tokens"), u["completion_tokens"].alias("completion_tokens"),
                    u["total_tokens"].alias("total_tokens"), u["usage_present"].alias("usage_present"))


# ---------------------------------------------------------------- JSONL source and sink
@register("jsonl_scan", _filter_sql("true"))
def q_jsonl_scan(spark, sf_dir):
    path = scratch_path(spark, "records_gz")
    write_jsonl(V.as_lines(V.record_rows(spark, sf_dir)), path, compression="gzip")
    return _typed(valid_records(read_jsonl(spark, path, min_partitions=8)))


@register(
    "jsonl_roundtrip",
    O.with_ctes(O.RECORDS, body="SELECT id, md5(ft) AS ft_md5, len, CAST(doc_id AS BIGINT) AS pos FROM records"),
)
def q_jsonl_roundtrip(spark, sf_dir):
    """Write bzip2 JSONL in line order, read it back: every line, whole text, same order."""
    path = scratch_path(spark, "records_bz2")
    write_jsonl(V.as_lines(V.record_rows(spark, sf_dir)), path, compression="bzip2", order_by=SEQ)
    back = valid_records(read_jsonl(spark, path))
    v = F.col(VAR)
    rows = back.select(
        SEQ,
        as_str(v, "id").alias("id"),
        F.md5(F.try_variant_get(v, "$.ft", "string")).alias("ft_md5"),
        to_int(v, "len").alias("len"),
    )
    return enrich.dense_index(rows, SEQ).select("id", "ft_md5", "len", F.col("_index").alias("pos"))


@register(
    "jsonl_bad_lines",
    O.with_ctes(
        O.RECORDS,
        body="""SELECT CASE k WHEN 2 THEN 'ok' WHEN 3 THEN 'invalid' WHEN 4 THEN 'invalid' WHEN 5 THEN 'invalid'
    WHEN 6 THEN 'not_object' WHEN 7 THEN 'not_object' WHEN 8 THEN 'ok' WHEN 9 THEN 'invalid'
    WHEN 10 THEN 'invalid' ELSE 'ok' END AS status,
  CASE WHEN k IN (2, 8, 11, 12) THEN id END AS id
FROM (SELECT doc_id % 13 AS k, id FROM records) WHERE k NOT IN (0, 1)""",
    ),
)
def q_jsonl_bad_lines(spark, sf_dir):
    parsed = V.parse_lines(V.bad_lines(spark, sf_dir))
    return parsed.filter(F.col("_status") != "blank").select(
        F.col("_status").alias("status"), F.when(F.col("_status") == "ok", as_str(F.col(VAR), "id")).alias("id")
    )


@register(
    "coerce_numeric",
    O.with_ctes(
        O.RECORDS,
        body="""SELECT id, doc_id % 11 AS kind,
  CASE doc_id % 11 WHEN 0 THEN len WHEN 1 THEN len WHEN 2 THEN len WHEN 4 THEN 1 WHEN 6 THEN len
    WHEN 7 THEN len WHEN 9 THEN -1 END AS as_int,
  CASE doc_id % 11 WHEN 0 THEN len WHEN 1 THEN len WHEN 2 THEN CAST(CAST(len AS VARCHAR) || '.7' AS DOUBLE)
    WHEN 3 THEN CAST(CAST(len AS VARCHAR) || '.7' AS DOUBLE) WHEN 4 THEN 1.0
    WHEN 6 THEN len WHEN 7 THEN len WHEN 9 THEN -1.0 END::DOUBLE AS as_float
FROM records""",
    ),
)
def q_coerce_numeric(spark, sf_dir):
    parsed = V.parse_lines(V.coerce_lines(spark, sf_dir))
    v = F.col(VAR)
    return parsed.select(
        as_str(v, "id").alias("id"), (F.col(SEQ) % 11).alias("kind"),
        to_int(v, "len").alias("as_int"), to_float(v, "len").alias("as_float"),
    )


@register(
    "coerce_string",
    O.with_ctes(
        O.RECORDS,
        body="""SELECT id, doc_id % 7 AS kind,
  CASE doc_id % 7 WHEN 0 THEN newspaper WHEN 1 THEN newspaper WHEN 4 THEN CAST(doc_id AS VARCHAR)
    WHEN 5 THEN 'True' WHEN 6 THEN 'tab' || chr(9) || newspaper ELSE '' END AS s
FROM records""",
    ),
)
def q_coerce_string(spark, sf_dir):
    parsed = V.parse_lines(V.coerce_lines(spark, sf_dir))
    v = F.col(VAR)
    return parsed.select(as_str(v, "id").alias("id"), (F.col(SEQ) % 7).alias("kind"), as_str(v, "title").alias("s"))


# ---------------------------------------------------------------- incremental shard build
RUN_TS_2 = "2024-02-01T00:00:00+00:00"


@register(
    "shard_incremental",
    O.with_ctes(
        O.RECORDS,
        body=f"""SELECT id, length(ft) AS length,
  round(length(regexp_replace(ft, '[^\\p{{L}}\\p{{N}}_]+', '', 'g')) / length(ft), 3) AS alphabetic_ratio,
  CASE WHEN yr % 2 = 0 THEN '{V.RUN_TS}' ELSE '{RUN_TS_2}' END AS ts, newspaper, CAST(yr AS VARCHAR) AS yr
FROM records""",
    ),
)
def q_shard_incremental(spark, sf_dir):
    """Run 1 profiles the even years (an earlier delivery); run 2 sees every
    record and adds only the shards run 1 did not write."""
    out = scratch_path(spark, "profiles")
    recs = valid_records(V.records(spark, sf_dir))
    earlier = recs.filter(to_int(F.col(VAR), "yr") % 2 == 0)
    jobs.profile_new_shards(earlier, out, V.RUN_TS)
    jobs.profile_new_shards(recs, out, RUN_TS_2)
    back = spark.read.schema("value string, newspaper string, yr string").text(out)
    rec = F.from_json("value", "id string, length bigint, alphabetic_ratio double, ts string")
    return back.select(rec["id"].alias("id"), rec["length"].alias("length"),
                       rec["alphabetic_ratio"].alias("alphabetic_ratio"), rec["ts"].alias("ts"), "newspaper", "yr")


@register(
    "tfidf_keywords",
    O.with_ctes(
        O.RECORDS,
        body="""SELECT id, coalesce(string_agg(term, '|' ORDER BY rn), '') AS keywords FROM (
  SELECT r.id, s.term, s.rn FROM records r LEFT JOIN (
    SELECT id, term, row_number() OVER (PARTITION BY id ORDER BY round(tf * ln((SELECT count(*) + 1 FROM records)::DOUBLE / (df + 1)), 9) DESC, term) AS rn
    FROM (SELECT *, count(*) OVER (PARTITION BY term) AS df FROM (
      SELECT id, term, count(*) AS tf FROM (
        SELECT id, unnest(regexp_extract_all(lower(ft), '[\\p{L}\\p{N}]+')) AS term FROM records) GROUP BY id, term))
  ) s ON s.id = r.id AND s.rn <= 5) GROUP BY id""",
    ),
)
def q_tfidf_keywords(spark, sf_dir):
    """Top-5 TF-IDF terms per article over whole texts."""
    from corpusprep.operators import tfidf

    recs = valid_records(V.records(spark, sf_dir))
    docs = recs.select(as_str(F.col(VAR), "id").alias("id"), as_str(F.col(VAR), "ft").alias("text"))
    return tfidf.tfidf_keywords(docs, "id", "text", 5).select("id", F.array_join("keywords", "|").alias("keywords"))


_CHAIN = f"""filtered AS (SELECT * FROM no_text WHERE tp = 'article' AND ocrqa >= 0.7 AND len >= 550),
picked AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lg ORDER BY md5('42:' || id), id) AS rn
                 FROM filtered WHERE lg <> '') WHERE rn <= 2000),
enriched AS (
  SELECT p.doc_id, p.id, p.lg, coalesce(p.ft, {O.py_strip('a.ft')}) AS text
  FROM picked p LEFT JOIN archive a ON a.id = p.id WHERE p.ft IS NOT NULL OR a.ft IS NOT NULL),
exported AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lg ORDER BY doc_id) AS rn FROM enriched
                 WHERE {O.AD_RULE.format(t='text')} = 'non-ad') WHERE rn <= 1000),
chain_kres AS (
  SELECT {O.BUCKET_EXPR.format(x='lg')} AS language, length(text) AS chars, doc_id % 10 <> 0 AS parsed,
    doc_id % 9 = 0 AS usage_missing,
    CASE WHEN doc_id % 9 <> 0 THEN length(text) // 4 + 20 ELSE 0 END AS prompt_tokens,
    CAST(CASE WHEN doc_id % 9 <> 0 THEN 12 ELSE 0 END AS BIGINT) AS completion_tokens,
    CASE WHEN doc_id % 9 <> 0 THEN length(text) // 4 + 32 ELSE 0 END AS total_tokens
  FROM exported)"""


@register(
    "chain_end_to_end",
    O.with_ctes(
        O.RECORDS,
        O.NO_TEXT,
        O.ARCHIVE,
        _CHAIN,
        body="""SELECT coalesce(language, 'TOTAL') AS language, count(*) AS records,
  count(*) FILTER (WHERE NOT parsed) AS failed_records,
  count(*) FILTER (WHERE parsed) AS records_with_keywords,
  CAST(sum(chars) AS BIGINT) AS article_chars,
  CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
  CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
  count(*) FILTER (WHERE usage_missing) AS usage_missing_records
FROM chain_kres GROUP BY ROLLUP (language)""",
    ),
)
def q_chain_end_to_end(spark, sf_dir):
    """filter -> sample and classify -> titles -> split -> keywords; returns the
    keyword summary of the chain's output."""
    return jobs.chain(spark, V.records_no_text(spark, sf_dir), _archive(spark, sf_dir), V.providers_path(spark, sf_dir),
                      scratch_path(spark, "chain"), jobs.ClassifyParams(doubles.rule_model), doubles.recorded_completer,
                      keyword_fields=KW_FIELDS)


@register(
    "missing_title_counts",
    O.with_ctes(
        O.RECORDS,
        O.TITLES,
        body="""SELECT count(*) FILTER (WHERE NOT broken) AS valid_records,
  count(*) FILTER (WHERE NOT broken AND trim(coalesce(title, '')) = '' AND id = '') AS missing_id_records,
  count(*) FILTER (WHERE broken) AS invalid_json_lines
FROM titled""",
    ),
)
def q_missing_title_counts(spark, sf_dir):
    return enrich.missing_title_counts(V.records_titles(spark, sf_dir))


@register(
    "enrich_text_counts",
    O.with_ctes(
        O.RECORDS,
        O.NO_TEXT,
        O.ARCHIVE,
        body="""SELECT count(*) AS records,
  count(*) FILTER (WHERE r.ft IS NULL AND a.id IS NULL) AS unresolved_records
FROM no_text r LEFT JOIN archive a ON a.id = r.id""",
    ),
)
def q_enrich_text_counts(spark, sf_dir):
    recs = identity.with_rid(valid_records(V.records_no_text(spark, sf_dir)))
    return enrich.enrich_text_counts(enrich.enrich_text_all(recs, _archive(spark, sf_dir)))


@register(
    "keyword_run_summary",
    O.with_ctes(
        O.RECORDS,
        O.PROVIDERS,
        O.KEYWORD_INPUT,
        body=f"""SELECT 'keyword_input' AS input_prefix, 'keywords' AS output_prefix,
  'providers.json' AS providers_title_path, 'offline-fixture' AS model, '' AS base_url,
  'keywords' AS keywords_field,
  count(*) AS total_records,
  count(*) FILTER (WHERE NOT parsed) AS total_failed_records,
  count(*) FILTER (WHERE parsed) AS total_records_with_keywords,
  CAST(sum(length(article)) AS BIGINT) AS total_article_chars,
  CAST(sum(prompt_tokens) AS BIGINT) AS total_prompt_tokens,
  CAST(sum(completion_tokens) AS BIGINT) AS total_completion_tokens,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
  count(*) FILTER (WHERE usage_missing) AS total_usage_missing_records,
  (SELECT string_agg(DISTINCT {O.BUCKET_EXPR.format(x='lg')}, ',' ORDER BY {O.BUCKET_EXPR.format(x='lg')}) FROM records)
    AS languages
FROM kres""",
    ),
)
def q_keyword_run_summary(spark, sf_dir):
    stats = keywords.keyword_stats(_kw_results(spark, sf_dir), folder.LANG_FILE)
    row = keywords.keyword_summary_row(
        stats, folder.LANG_FILE, input_prefix="keyword_input", output_prefix="keywords",
        providers_path="providers.json", model="offline-fixture", base_url="",
    )
    return row.select(*[c for c in row.columns if c not in ("languages", "languages_summary")],
                      F.array_join("languages", ",").alias("languages"))


@register(
    "keyword_job",
    O.with_ctes(
        O.RECORDS,
        O.PROVIDERS,
        O.KEYWORD_INPUT,
        body="""SELECT id, CASE WHEN parsed THEN newspaper || '|' || lg || ' press|year ' || year ELSE '' END AS keywords,
  (SELECT count(*) FROM kres) AS total_records, (SELECT count(*) FROM kres WHERE NOT parsed) AS total_failed_records,
  (SELECT CAST(sum(total_tokens) AS BIGINT) FROM kres) AS total_tokens FROM kres""",
    ),
)
def q_keyword_job(spark, sf_dir):
    """The files that the keyword job wrote, with totals of its published summary beside every row."""
    out = scratch_path(spark, "keyword_job")
    jobs.keyword_job(spark, V.keyword_folder(spark, sf_dir), V.providers_path(spark, sf_dir), out, doubles.recorded_completer,
                     fields=KW_FIELDS)
    summary = spark.read.option("multiline", "true").json(f"{out}/keywords_summary.json").first()
    back = V.parse_lines(spark.read.text(f"{out}/lang_file=*"))
    v = F.col(VAR)
    return back.select(
        as_str(v, "id").alias("id"), F.array_join(F.try_variant_get(v, "$.keywords", "array<string>"), "|").alias("keywords"),
        *[F.lit(summary[c]).cast("bigint").alias(c) for c in ("total_records", "total_failed_records", "total_tokens")])
