"""Properties of the sampling, store and enrichment jobs (sf0.001 / sf0.01)."""

import pytest
from pyspark.sql import functions as F

from conftest import MID, SMALL
from corpusprep.functions.coerce import as_str
from corpusprep.operators import classify as C
from corpusprep.operators import filtering, identity, sampling
from corpusprep.plans import doubles, jobs
from corpusprep.plans import views as V
from corpusprep.session import scratch_path
from corpusprep.sources import archive as A
from corpusprep.sources import store as S
from corpusprep.sources.jsonl import VAR


def _cands(spark, sf, parts=None):
    recs = V.records(spark, sf)
    if parts:
        recs = recs.repartition(parts)
    store = identity.with_rid(V.store_lines(spark, sf))
    return jobs.candidates(recs, store, jobs.ClassifyParams(doubles.rule_model)), store


def test_sample_bounds_and_disjoint(spark):
    cands, store = _cands(spark, MID)
    n = 40
    picked = sampling.sample_per_language(cands, n, seed=7)
    per_lang = {r[0]: r[1] for r in picked.groupBy(sampling.LANG).count().collect()}
    avail = {r[0]: r[1] for r in cands.groupBy(sampling.LANG).agg(F.count_distinct(identity.RID)).collect()}
    for lang, have in avail.items():
        assert per_lang.get(lang, 0) == min(n, have)
    assert picked.select(identity.RID).distinct().count() == picked.count()
    assert picked.join(store.select(identity.RID), identity.RID, "left_semi").count() == 0


def test_sample_independent_of_partitioning(spark):
    results = []
    for parts in (1, 2, 8):
        cands, _ = _cands(spark, MID, parts)
        rows = sampling.sample_per_language(cands, 25, seed=42).select(identity.RID).collect()
        results.append(sorted(r[0] for r in rows))
    assert results[0] == results[1] == results[2]


def test_sample_changes_with_seed(spark):
    cands, _ = _cands(spark, MID)
    a = {r[0] for r in sampling.sample_per_language(cands, 25, seed=1).select(identity.RID).collect()}
    b = {r[0] for r in sampling.sample_per_language(cands, 25, seed=2).select(identity.RID).collect()}
    assert a != b


def test_two_runs_are_disjoint(spark):
    store_path = scratch_path(spark, "store-test")
    arch = A.Archive(spark, V.archive_path(spark, SMALL))
    p = jobs.ClassifyParams(doubles.rule_model, target_per_language=5)
    parsed = V.records_no_text(spark, SMALL)
    jobs.run_sampling(spark, parsed, store_path, arch, p, "r1")
    jobs.run_sampling(spark, parsed, store_path, arch, p, "r2")
    st = S.read_store(spark, store_path)
    ids = st.groupBy(identity.RID).agg(F.count_distinct("run_id").alias("runs"))
    assert ids.filter("runs > 1").count() == 0
    assert st.filter("run_id = 'r2'").count() > 0
    labels = {r[0] for r in st.select(as_str(F.col(VAR), "ad_class")).distinct().collect()}
    assert labels <= {"ad", "non-ad"}


class BadModel:
    def predict(self, texts):
        return ["maybe" for _ in texts]


def bad_model():
    return BadModel()


def test_bad_label_fails_and_store_unchanged(spark):
    store_path = scratch_path(spark, "store-bad")
    arch = A.Archive(spark, V.archive_path(spark, SMALL))
    parsed = V.records_no_text(spark, SMALL)
    jobs.run_sampling(spark, parsed, store_path, arch, jobs.ClassifyParams(doubles.rule_model, target_per_language=3), "r1")
    before = S.read_store(spark, store_path).count()
    with pytest.raises(Exception):
        jobs.run_sampling(spark, parsed, store_path, arch,
                          jobs.ClassifyParams(bad_model, target_per_language=3), "r2")
    assert S.read_store(spark, store_path).count() == before


def test_classifier_udf_equals_native_rule(spark):
    recs = V.records(spark, MID)
    text = as_str(F.col(VAR), "ft")
    diff = recs.filter(C.classify(text, F.lit("x"), doubles.rule_model) != doubles.rule_label(text)).count()
    assert diff == 0


def test_split_keeps_original_lines(spark):
    from corpusprep.operators.split import read_split, split_by_language

    parsed = V.records(spark, SMALL)
    out = scratch_path(spark, "split-test")
    split_by_language(parsed, out)
    written = {r[0] for r in read_split(spark, out).select("value").collect()}
    original = {r[0] for r in parsed.select("value").collect()}
    assert written == original


def test_dense_index_is_a_permutation(spark):
    from corpusprep.operators.enrich import dense_index

    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    idx = dense_index(df, "k").collect()
    got = sorted((r.k, r._index) for r in idx)
    assert [i for _, i in got] == list(range(len(got)))


def test_full_run_with_remaining_labels_everything_once(spark):
    store_path = scratch_path(spark, "store-full")
    arch = A.Archive(spark, V.archive_path(spark, SMALL))
    parsed = V.records_no_text(spark, SMALL)
    p = jobs.ClassifyParams(doubles.rule_model, target_per_language=4)
    res = jobs.labelling_run(spark, parsed, store_path, arch, p, classify_remaining=True,
                                   export_path=scratch_path(spark, "export"))
    c = res.counters.first()
    assert c.existing_rows == 0 and c.sampled_new > 0 and c.remaining_new > 0
    st = S.read_store(spark, store_path)
    assert st.count() == st.select(identity.RID).distinct().count() == c.processed_ids
    # every article with text (own or from the archive) is now labelled
    n = F.regexp_extract(as_str(F.col(VAR), "id"), "([0-9]+)$", 1).cast("int")
    eligible = (parsed.filter("_status = 'ok'").filter(as_str(F.col(VAR), "tp") == "article")
                .filter(~((n % 3 == 0) & (n % 11 == 0))).count())
    assert c.processed_ids == eligible
    again = jobs.labelling_run(spark, parsed, store_path, arch, p, classify_remaining=True)
    c2 = again.counters.first()
    assert c2.sampled_new == 0 and c2.remaining_new == 0


def test_attempts_that_did_not_commit_are_not_seen(spark, monkeypatch):
    store_path = scratch_path(spark, "store-index")
    lines = V.store_lines(spark, SMALL)
    S.append_run(lines, store_path, "r0")
    extra = V.parse_lines(V.as_lines(V.record_rows(spark, SMALL).filter(F.col("doc_id") % 7 == 1)))

    def crash(*args, **kwargs):
        raise OSError("the driver is gone")

    for step in ("_commit", "_check"):  # after both writes; before them (the first check passes nothing)
        with monkeypatch.context() as m:
            m.setattr(S, step, crash)
            with pytest.raises(OSError):
                S.append_run(extra, store_path, "r1")
    # records without their IDs: a crash between the two writes
    extra.select("value").write.text(f"{store_path}/attempt=r1.dead")
    ids = {r[0] for r in S.store_ids(spark, store_path).collect()}
    stored = {r[0] for r in S.read_store(spark, store_path).select(identity.RID).collect()}
    assert ids == stored and len(ids) == lines.count() and S.store_runs(spark, store_path) == ["r0"]
    S.append_run(extra, store_path, "r1")  # the run can be done again
    assert S.read_store(spark, store_path).count() == lines.count() + extra.count() == S.store_ids(spark, store_path).count()


def test_filter_job_counts_in_one_pass(spark):
    from corpusprep.sources.jsonl import read_jsonl

    out = scratch_path(spark, "filtered")
    counts = jobs.filter_job(V.records_dirty(spark, SMALL), out, tp="article", min_quality=0.7, min_length=550)
    expect = filtering.filter_counts(V.records_dirty(spark, SMALL), tp="article", min_quality=0.7,
                                     min_length=550).first()
    got = counts.first()
    assert got == expect
    assert read_jsonl(spark, out).count() == got.kept_records


def test_profile_job_modes(spark):
    from corpusprep.sources.jsonl import read_jsonl

    out = scratch_path(spark, "profile")
    jobs.profile_job(V.records_dirty(spark, SMALL), out, V.RUN_TS)
    assert read_jsonl(spark, out).count() == V.records_dirty(spark, SMALL).filter("_status = 'ok'").count()
    with pytest.raises(Exception):
        jobs.profile_job(V.records_dirty(spark, SMALL), scratch_path(spark, "profile-ff"), V.RUN_TS, mode="failfast")


def test_import_existing_store_file(spark):
    from corpusprep.sources.jsonl import write_jsonl

    legacy = scratch_path(spark, "legacy-store")
    write_jsonl(V.store_lines(spark, SMALL), legacy, compression="gzip", order_by="_seq")
    store_path = scratch_path(spark, "imported")
    S.import_store(spark, legacy, store_path)
    st = S.read_store(spark, store_path)
    assert st.count() == V.store_lines(spark, SMALL).count()
    assert S.store_ids(spark, store_path).count() == st.count()
    # a sampling run on top never re-labels an imported ID
    arch = A.Archive(spark, V.archive_path(spark, SMALL))
    jobs.run_sampling(spark, V.records_no_text(spark, SMALL), store_path, arch,
                      jobs.ClassifyParams(doubles.rule_model, target_per_language=5), "r1")
    st = S.read_store(spark, store_path)
    assert st.count() == st.select(identity.RID).distinct().count()


def test_ad_model_agrees_with_labels(spark):
    import __spark_entry__ as E

    pred = E.queries()["ad_model_fit"](spark, MID)
    truth = V.record_rows(spark, MID).select("id", doubles.rule_label(F.col("ft")).alias("rule"))
    joined = pred.join(truth, "id")
    assert joined.count() == 1000
    assert joined.filter("ad_class = rule").count() >= 850


def test_sparse_keep_first_equals_keep_first(spark):
    from corpusprep.sources.staging import stage

    recs = stage(identity.with_rid(V.duplicated_lines(spark, MID)).select(identity.RID, "_seq", "value"), "dups")
    a = sorted(identity.keep_first(recs).select(identity.RID, "value").collect())
    b = sorted(identity.keep_first_sparse(recs).select(identity.RID, "value").collect())
    assert a == b and len(a) == recs.select(identity.RID).distinct().count()


def test_sample_is_spread_over_the_input(spark):
    """Uniform, not first-N: picks fall on both halves of each language's lines."""
    cands, _ = _cands(spark, MID)
    picked = sampling.sample_per_language(cands, 60, seed=3)
    num = V.id_number(F.col(identity.RID))
    rows = picked.select(sampling.LANG, num.alias("n")).collect()
    everything = cands.select(sampling.LANG, num.alias("n")).collect()
    for lang in {r[0] for r in rows}:
        pool = sorted(r.n for r in everything if r[0] == lang)
        if len(pool) < 120:
            continue
        median = pool[len(pool) // 2]
        low = sum(1 for r in rows if r[0] == lang and r.n < median)
        assert 0.3 * 60 <= low <= 0.7 * 60, (lang, low)


def test_export_does_not_depend_on_partitioning(spark):
    from corpusprep.sources.jsonl import read_jsonl

    arch = A.Archive(spark, V.archive_path(spark, SMALL))
    exported = []
    for parts in (1, 8):
        parsed = V.records_no_text(spark, SMALL).repartition(parts)
        store_path, out = scratch_path(spark, f"store-p{parts}"), scratch_path(spark, f"export-p{parts}")
        jobs.labelling_run(spark, parsed, store_path, arch, jobs.ClassifyParams(doubles.rule_model, target_per_language=4),
                           classify_remaining=True, export_path=out)
        lines = read_jsonl(spark, out).select(as_str(F.col(VAR), "id")).collect()
        exported.append(sorted(r[0] for r in lines))
    assert exported[0] == exported[1] and exported[0]


def test_append_refuses_after_a_concurrent_run(spark):
    store_path = scratch_path(spark, "store-race")
    S.append_run(V.store_lines(spark, SMALL), store_path, "r0")
    seen = S.store_version(spark, store_path)
    S.append_run(V.store_lines(spark, SMALL).limit(1), store_path, "r1")  # another writer
    with pytest.raises(S.ConcurrentRunError):
        S.append_run(V.store_lines(spark, SMALL), store_path, "r2", expect_version=seen)
    with pytest.raises(S.RunExistsError):
        S.append_run(V.store_lines(spark, SMALL), store_path, "r1")
    assert S.store_runs(spark, store_path) == ["r0", "r1"]
