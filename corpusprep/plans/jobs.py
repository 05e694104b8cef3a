"""Jobs a user calls: compositions of the operators, one Catalyst plan each
(plus a staged table where one input feeds two outputs)."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any, Callable  # noqa: UP035

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.fields import DEFAULT, Fields
from corpusprep.fixed import (
    DEFAULT_SEED,
    DEFAULT_TARGET_PER_LANGUAGE,
    NON_AD,
    POOL_FACTOR,
    SPLIT_SUMMARY_NAME,
    UNKNOWN_LANGUAGE,
)
from corpusprep.functions.coerce import as_str, json_path, py_strip, record_length
from corpusprep.functions.records import append_field, as_map, set_field, write_record
from corpusprep.operators import classify as C
from corpusprep.operators import enrich, filtering, identity, sampling
from corpusprep.sources import store as S
from corpusprep.sources.archive import Archive
from corpusprep.sources.jsonl import SEQ, VAR, valid_records, write_jsonl


# ------------------------------------------------------------------ JOB1
def filter_job(parsed: DataFrame, output: str | None = None, *, compression: str | None = None, **conditions) -> DataFrame:
    """Keep matching records (original lines) and return the counters.

    With an output the counters are observed while the output is written
    (``Observation``): one pass over the corpus, not two.
    """
    if not output:
        return filtering.filter_counts(parsed, **conditions)
    from pyspark.sql import Observation

    from corpusprep.sources.jsonl import LINE_STATUS_OK, STATUS

    s = F.col(STATUS)
    kept = (s == LINE_STATUS_OK) & filtering.match_filters(F.col(VAR), **conditions)
    obs = Observation("filter_counts")
    observed = parsed.observe(
        obs,
        F.count_if(s != "blank").alias("total_records"),
        F.count_if(kept).alias("kept_records"),
        F.count_if((s != "blank") & (s != LINE_STATUS_OK)).alias("invalid_json_lines"),
    )
    write_jsonl(observed.filter(kept), output, compression=compression)
    got = obs.get
    row = (got["total_records"], got["kept_records"], got["total_records"] - got["kept_records"],
           got["invalid_json_lines"])
    return parsed.sparkSession.createDataFrame(
        [row], "total_records bigint, kept_records bigint, dropped_records bigint, invalid_json_lines bigint"
    )


# ------------------------------------------------------------------ JOB2 / JOB3
@dataclass
class ClassifyParams:
    """``model`` is a zero-argument factory of an object with ``predict(texts) -> labels``."""

    model: Callable[[], Any]
    fields: Fields = DEFAULT
    type_field: str = "tp"
    type_value: str = "article"
    languages: list[str] | None = None  # None: every non-blank language
    target_per_language: int = DEFAULT_TARGET_PER_LANGUAGE
    pool_per_language: int | None = None  # default POOL_FACTOR x target
    seed: int = DEFAULT_SEED


def tag_records(parsed: DataFrame, p: ClassifyParams) -> DataFrame:
    """Valid, type-matching records with ``_rid`` and ``_lang``."""
    v = F.col(VAR)
    recs = valid_records(parsed).filter(filtering.type_matches(v, p.type_field, p.type_value))
    return identity.with_rid(recs, p.fields.id, p.fields.label).withColumn(sampling.LANG, as_str(v, p.fields.lang))


def candidates(parsed: DataFrame, store: DataFrame | list[DataFrame], p: ClassifyParams) -> DataFrame:
    """Tagged records that the store has not seen (``store``: stored rows or
    their IDs, e.g. :func:`corpusprep.sources.store.processed_ids`)."""
    return identity.unprocessed(tag_records(parsed, p), store)


def label_records(enriched: DataFrame, p: ClassifyParams) -> DataFrame:
    """Classify enriched records; rewrite each line with the label field set.

    A record without the label key gets it appended to its line as text (no
    second parse); one that has it is rewritten through the map route.
    """
    label = C.classify(F.col("e_text"), F.col(identity.RID), p.model)
    out = enriched.withColumn("_label", label)
    line = py_strip(F.col("value"))
    m = set_field(as_map(line), p.fields.label, F.col("_label").cast("variant"))
    # a line that may carry the key takes the exact map route; a false hit
    # (the quoted name inside a value) only costs that row a parse
    maybe_has = line.contains(json.dumps(p.fields.label))
    rewritten = F.when(maybe_has, write_record(m)).otherwise(append_field(line, p.fields.label, F.col("_label")))
    return out.withColumn("value", rewritten)


def sample_and_classify(parsed: DataFrame | None, store: DataFrame | list[DataFrame], archive: Archive | DataFrame, p: ClassifyParams,
                        *, cands: DataFrame | None = None, lost=None) -> DataFrame:
    """One sampling run: new labelled rows (not yet written).

    type filter -> language set -> minus store -> seeded sample per language
    -> fill text from the archive -> drop unresolved -> classify.
    ``cands`` (from :func:`candidates`) skips the first three steps; ``lost``
    (an ``Observation``) counts the unresolved records.
    """
    pool = p.pool_per_language or POOL_FACTOR * p.target_per_language
    if cands is None:
        # rank narrow tuples of the unprocessed records, fetch the picked rows
        # from the records themselves (no full-row shuffle)
        tagged = tag_records(parsed, p)
        cands = identity.unprocessed(tagged, store)
        picked = sampling.sample_per_language(cands, pool, seed=p.seed, languages=p.languages, fetch_from=tagged)
    else:
        picked = sampling.sample_per_language(cands, pool, seed=p.seed, languages=p.languages)
    return label_records(_resolved(picked, archive, p, lost), p)


def _resolved(rows: DataFrame, archive: Archive | DataFrame, p: ClassifyParams, lost=None, *, stage_input: bool = True) -> DataFrame:
    """Records with their text; those without one are left out, counted by ``lost`` if given."""
    rows = enrich.enrich_text_all(rows, archive, fields=p.fields, stage_input=stage_input)
    if lost is not None:
        rows = rows.observe(lost, F.count_if(F.col("e_text") == "").alias("unresolved"))
    return rows.filter(F.col("e_text") != "")


def classify_rest(parsed: DataFrame, store: DataFrame | list[DataFrame], archive: Archive | DataFrame, p: ClassifyParams) -> DataFrame:
    """Every unprocessed record of every language, enriched and labelled.

    The candidates are staged once; dedup shuffles only duplicated IDs.
    """
    from corpusprep.sources.staging import stage

    cands = identity.keep_first_sparse(stage(enrich.with_own_fields(candidates(parsed, store, p), p.fields),
                                             "rest_candidates"))
    return label_records(enrich.enrich_text(cands, archive, fields=p.fields, stage_input=False), p)


def retention_estimate(labelled: DataFrame, fields: Fields = DEFAULT) -> DataFrame:
    """Newly classified records, non-ads among them and their characters."""
    non_ad = F.col("_label") == NON_AD
    n = record_length(F.col("e_len"), F.col("e_text"))
    return labelled.agg(
        F.count("*").alias("newly_classified_records"),
        F.count_if(non_ad).alias("remaining_non_ad_count"),
        F.coalesce(F.sum(F.when(non_ad, n)), F.lit(0)).cast("bigint").alias("remaining_non_ad_chars"),
    )


def run_sampling(spark: SparkSession, parsed: DataFrame, store_path: str, archive: Archive | DataFrame,
                 p: ClassifyParams, run_id: str | None = None) -> str:
    """JOB2 end to end: sample, classify, append to the store as one run."""
    seen = S.store_version(spark, store_path)
    new_rows = sample_and_classify(parsed, S.processed_ids(spark, store_path), archive, p)
    # append_run stages the labelled rows (line, position, ID), so the model runs once per record
    return S.append_run(new_rows, store_path, run_id, id_field=p.fields.id, class_field=p.fields.label,
                        expect_version=seen)


def non_ad_counts(store: DataFrame, fields: Fields = DEFAULT) -> DataFrame:
    """Non-ads per (non-blank) language in the store."""
    v = F.col(VAR)
    lang = as_str(v, fields.lang)
    rows = store.filter(filtering.is_label(v, fields.label, NON_AD) & (lang != ""))
    return rows.groupBy(lang.alias("lg")).agg(F.count("*").alias("non_ads"))


def non_ad_export(store: DataFrame, n: int, fields: Fields = DEFAULT) -> DataFrame:
    """First ``n`` non-ads per language (blank -> ``unknown``) in store order."""
    v = F.col(VAR)
    rows = store.filter(filtering.is_label(v, fields.label, NON_AD)).withColumn(
        "language", F.coalesce(F.nullif(as_str(v, fields.lang), F.lit("")), F.lit(UNKNOWN_LANGUAGE))
    )
    return sampling.first_n_per_group(rows, "language", n, SEQ)


# ------------------------------------------------------------------ JOB7 / JOB9
def profile_job(parsed: DataFrame, output: str, run_ts: str, *, mode: str = "permissive",
                fields: Fields = DEFAULT, compression: str | None = None) -> None:
    """Write the text profile of every record as JSONL.

    ``mode="failfast"`` fails the job on the first line that is not a JSON
    object (as the reference does); ``"permissive"`` skips such lines.
    """
    from corpusprep.operators.profile import profile_lines, text_profile
    from corpusprep.sources.jsonl import LINE_STATUS_OK, STATUS

    s = F.col(STATUS)
    if mode == "failfast":
        bad = (s != LINE_STATUS_OK) & (s != "blank")
        checked = parsed.withColumn(
            STATUS, F.when(bad, F.raise_error(F.concat(F.lit("invalid JSON line: "), F.substr(F.col("value"), F.lit(1), F.lit(200)))))
            .otherwise(s)
        )
    elif mode == "permissive":
        checked = parsed
    else:
        raise ValueError(f"mode must be 'permissive' or 'failfast', not {mode!r}")
    recs = checked.filter(F.col(STATUS) == LINE_STATUS_OK)
    write_jsonl(profile_lines(text_profile(recs, run_ts, fields.text)), output, compression=compression)



#: Marks of finished shards, beside a job's output: shard, input fingerprint, written after the shard is.
SHARD_MARKS = "_shards"


def profile_new_shards(records: DataFrame, output: str, run_ts: str, fields: Fields = DEFAULT) -> None:
    """Profile only the ``(newspaper, yr)`` shards of ``records`` that are not finished
    under ``output`` (the incremental build: skip what is done, never overwrite it).

    The shard of a record comes from its profile ID (``id``, else ``c_id``).  A shard is finished when its mark
    is there; what an interrupted run left of others is replaced.
    Records without an ID have a blank shard, which Spark writes as its default
    partition; it is marked like any other.  For an archive, whose files name their shards, see ``profile_shards``.
    """
    from corpusprep.operators.profile import profile_id
    from corpusprep.sources.archive import shard_of

    news, year = shard_of(F.coalesce(profile_id(F.col(VAR)), F.lit("")))
    tagged = records.withColumn("newspaper", news).withColumn("yr", year)
    tagged = tagged.join(finished_shards(records.sparkSession, output).select("newspaper", "yr"), ["newspaper", "yr"], "left_anti")
    _write_shards(tagged, output, run_ts, fields)


def profile_shards(archive: Archive, output: str, run_ts: str, fields: Fields = DEFAULT) -> None:
    """Profile the archive's shards that are new or whose files changed since they were profiled.

    Names, sizes and times of the files are compared with the marks before anything is read: no file of a finished
    shard is opened.  A changed or half-written shard is replaced as a whole.
    """
    from corpusprep.sources.staging import stage

    done = finished_shards(archive.spark, output)
    todo = stage(archive.fingerprints().join(done, ["newspaper", "yr", "fingerprint"], "left_anti"), "shards_todo")
    _write_shards(archive.records(todo.select("newspaper", "yr")), output, run_ts, fields, todo)


def _write_shards(tagged: DataFrame, output: str, run_ts: str, fields: Fields, todo: DataFrame | None = None) -> None:
    """Profiles of ``tagged`` records in a folder for each shard, then the marks of the shards (``todo``: with their fingerprints)."""
    from corpusprep.sources.staging import stage

    prof = tagged.select(
        "newspaper", "yr", *[c.alias(n) for c, n in zip(_profile_cols(run_ts, fields), ["id", "length", "alphabetic_ratio", "ts"])]
    )
    lines = prof.select(F.to_json(F.struct("id", "length", "alphabetic_ratio", "ts")).alias("value"), "newspaper", "yr")
    if todo is None:  # the shards are known from the records alone: keep the profiles
        lines = stage(lines, "shard_profiles")
        todo = lines.select("newspaper", "yr").distinct().withColumn("fingerprint", F.lit(""))
    (lines.sortWithinPartitions("newspaper", "yr").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("newspaper", "yr").text(output))
    todo.select("newspaper", "yr", "fingerprint").write.mode("append").parquet(f"{output.rstrip('/')}/{SHARD_MARKS}")


def finished_shards(spark: SparkSession, output: str) -> DataFrame:
    """The marks under ``output``: (newspaper, yr, fingerprint of the input)."""
    from corpusprep.sources.staging import no_rows

    marks, schema = f"{output.rstrip('/')}/{SHARD_MARKS}", "newspaper string, yr string, fingerprint string"
    return spark.read.schema(schema).parquet(marks) if S.path_exists(spark, marks) else no_rows(spark, schema)


def _profile_cols(run_ts: str, fields: Fields):
    from corpusprep.operators.profile import profile_id, word_char_ratio

    v = F.col(VAR)
    text = F.coalesce(F.try_variant_get(v, json_path(fields.text), "string"), F.lit(""))
    return [profile_id(v), F.char_length(text).cast("bigint"), word_char_ratio(text), F.lit(run_ts)]


# ------------------------------------------------------------------ JOB5
TITLE_COUNTERS = ("total_records_written", "records_enriched_with_title", "records_already_had_title",
                  "records_still_missing_title", "invalid_json_lines_skipped")


def title_job(parsed: DataFrame, archive: Archive | DataFrame, output: str, fields: Fields = DEFAULT, *,
              compression: str | None = None) -> DataFrame:
    """Write the records with blank titles filled and return the counters, from one lookup.

    The counters, invalid lines included, are observed while the output is written.
    """
    from pyspark.sql import Observation

    t = F.col("t_state")
    obs = Observation("title_job")
    titled = enrich.title_states(parsed, archive, fields).observe(
        obs, F.count(t).alias("written"), F.count_if(t == "enriched").alias("enriched"),
        F.count_if(t == "had").alias("had"), F.count_if(t == "missing").alias("missing"), F.count_if(t.isNull()).alias("bad"))
    write_jsonl(titled.filter(t.isNotNull()), output, compression=compression)
    got = obs.get
    row = tuple(got[k] for k in ("written", "enriched", "had", "missing", "bad"))
    return parsed.sparkSession.createDataFrame([row], ", ".join(f"{c} bigint" for c in TITLE_COUNTERS))


# ------------------------------------------------------------------ JOB6
def keyword_job(spark: SparkSession, folder: str, providers_path: str, output: str, completer, *, fields: Fields = DEFAULT,
                model: str = "", base_url: str = "", max_per_file: int | None = None, max_concurrency: int | None = None,
                summary_name: str = "keywords_summary.json", recursive: bool = True, ledger: str | None = None, **sending) -> DataFrame:
    """A folder of language files in; records with keywords and the published summary out.

    Every reply is staged once; the output files (one folder per language file)
    and the statistics read the staged replies.  Returns the statistics by
    language file with the total (NULL).  With a ``ledger`` the job may be killed and called again: a request that has
    its reply there is not sent again (``sending``: options of ``replies.send_missing``).
    """
    from corpusprep.operators import keywords as K
    from corpusprep.operators.split import write_summary
    from corpusprep.sources.folder import LANG_FILE, scan_language_folder
    from corpusprep.sources.providers import newspaper_country, read_providers

    records = valid_records(scan_language_folder(spark, folder, recursive=recursive))
    replies = K.generate(records, newspaper_country(read_providers(spark, providers_path)), completer, fields=fields,
                         max_per_file=max_per_file, max_concurrency=max_concurrency, ledger=ledger, model=model, **sending)
    results = K.with_results(replies)
    write_jsonl(K.output_lines(results, fields).withColumnRenamed(LANG_FILE, "lang_file"), output, partition_by=["lang_file"])
    stats = K.keyword_stats(results, LANG_FILE)
    write_summary(K.keyword_summary_row(stats, LANG_FILE, input_prefix=folder, output_prefix=output, providers_path=providers_path,
                                        model=model, base_url=base_url, keywords_field=fields.keywords),
                  f"{output.rstrip('/')}/{summary_name}")
    return stats


# ------------------------------------------------------------------ JOB8
def chain(spark: SparkSession, parsed: DataFrame, archive: Archive | DataFrame, providers_path: str, output: str,
          p: ClassifyParams, completer, *, tp: str | None = "article", min_quality: float | None = 0.7,
          min_length: int | None = 550, keyword_fields: Fields | None = None, run_id: str = "r1", restart: bool = False) -> DataFrame:
    """The documented order end to end under ``output``, each step reading what the previous wrote.

    Called again on the same output it goes on where it stopped: a step whose output is complete is
    not done again, a labelling run ``run_id`` that is committed is not added to, and requests that have replies are not sent
    again.  A new ``run_id`` adds a run to the store and redoes the steps behind it.  ``restart=True`` writes all steps anew
    (other input or parameters), but for committed runs and replies, which stay.
    Returns the keyword statistics by language, the total as ``TOTAL``.
    """
    from corpusprep.operators.split import split_by_language
    from corpusprep.sources.folder import LANG_FILE
    from corpusprep.sources.jsonl import read_jsonl

    base = output.rstrip("/")
    # what a step leaves when it is complete; a step is redone when one before it was
    redo = restart
    if redo or not S.path_exists(spark, f"{base}/filtered/_SUCCESS"):
        filter_job(parsed, f"{base}/filtered", tp=tp, min_quality=min_quality, min_length=min_length)
        redo = True
    if run_id not in S.store_runs(spark, f"{base}/store"):
        run_sampling(spark, read_jsonl(spark, f"{base}/filtered"), f"{base}/store", archive, p, run_id)
        redo = True
    if redo or not S.path_exists(spark, f"{base}/non_ads/_SUCCESS"):
        store = S.read_store(spark, f"{base}/store")
        write_jsonl(non_ad_export(store, p.target_per_language, p.fields), f"{base}/non_ads", order_by=SEQ)
        redo = True
    if redo or not S.path_exists(spark, f"{base}/titled/_SUCCESS"):
        title_job(read_jsonl(spark, f"{base}/non_ads"), archive, f"{base}/titled", p.fields)
        redo = True
    if redo or not S.path_exists(spark, f"{base}/per_language/{SPLIT_SUMMARY_NAME}/_SUCCESS"):
        split_by_language(read_jsonl(spark, f"{base}/titled"), f"{base}/per_language", summary_name=SPLIT_SUMMARY_NAME)
    stats = keyword_job(spark, f"{base}/per_language", providers_path, f"{base}/keywords", completer,
                        fields=keyword_fields or p.fields, ledger=f"{base}/replies")
    return stats.select(F.coalesce(F.col(LANG_FILE), F.lit("TOTAL")).alias("language"),
                        *[c for c in stats.columns if c not in (LANG_FILE, "_is_total")])


# ------------------------------------------------------------------ JOB2 + JOB3 as one run
@dataclass
class RunResult:
    run_id: str
    counters: DataFrame  # existing_rows, sampled_new, remaining_new, processed_ids, unresolved_records
    estimate: DataFrame | None  # retention estimate of the remaining phase
    non_ads: DataFrame  # non-ads per language in the store after the run
    exported: DataFrame | None  # rows per language in the export


def labelling_run(
    spark: SparkSession,
    parsed: DataFrame,
    store_path: str,
    archive: Archive | DataFrame,
    p: ClassifyParams,
    *,
    classify_remaining: bool = False,
    export_path: str | None = None,
    run_id: str | None = None,
) -> RunResult:
    """The full labelling run: sample per language, optionally classify every
    remaining record, publish both as one store run (all or nothing), then
    optionally export the first ``target`` non-ads per language.

    Labelled rows are staged before anything reads them twice, so the model
    runs once per record.
    """
    from corpusprep.sources.staging import stage

    seen = S.store_version(spark, store_path)
    store, existing = S.processed_ids(spark, store_path), S.store_ids(spark, store_path)
    keep = ["value", SEQ, identity.RID, sampling.LANG, "e_text", "e_len", "_label"]
    # parse the input and remove stored IDs once; both phases draw from it
    cands = (stage(enrich.with_own_fields(candidates(parsed, store, p), p.fields), "candidates")
             if classify_remaining else None)
    from pyspark.sql import Observation

    # records still without text leave before the model; they are counted on the way
    lost = [Observation("unresolved_sampled"), Observation("unresolved_rest")]
    sampled = stage(
        sample_and_classify(parsed, store, archive, p, cands=cands, lost=lost[0]).select(*keep).withColumn("_phase", F.lit(1)),
        "sampled",
    )
    new = sampled
    estimate = None
    if classify_remaining:
        rest_cands = identity.keep_first_sparse(identity.unprocessed(cands, sampled.select(identity.RID)))
        rest = label_records(_resolved(rest_cands, archive, p, lost[1], stage_input=False), p)
        rest = stage(rest.select(*keep).withColumn("_phase", F.lit(2)), "rest")
        estimate = retention_estimate(rest, p.fields)
        new = sampled.unionByName(rest)
    # sampled records first, then the remaining ones, each in input order
    rid = S.append_run(new, store_path, run_id, id_field=p.fields.id, class_field=p.fields.label,
                       order_by=["_phase", SEQ], ids=new.select(identity.RID), expect_version=seen)
    counters = (
        existing.select(identity.RID, F.lit(0).alias("_phase"))
        .unionByName(new.select(identity.RID, "_phase"))
        .agg(
            F.count_if(F.col("_phase") == 0).alias("existing_rows"),
            F.count_if(F.col("_phase") == 1).alias("sampled_new"),
            F.count_if(F.col("_phase") == 2).alias("remaining_new"),
            F.count_distinct(identity.RID).alias("processed_ids"),
            F.lit(sum(o.get["unresolved"] for o in lost[:1 + classify_remaining])).cast("bigint").alias("unresolved_records"),
        )
    )
    full = S.read_store(spark, store_path, id_field=p.fields.id, class_field=p.fields.label)
    exported = None
    if export_path:
        chosen = stage(non_ad_export(full, p.target_per_language, p.fields).select("value", SEQ, "language"), "export")
        write_jsonl(chosen, export_path, order_by=SEQ)
        exported = chosen.groupBy("language").agg(F.count("*").alias("rows"))
    return RunResult(rid, counters, estimate, non_ad_counts(full, p.fields), exported)
