"""Faults of the last review: each test fails on the code before it."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from corpusprep import session
from corpusprep.functions.coerce import as_str
from corpusprep.operators import classify as C
from corpusprep.operators import identity, keywords, sampling, tfidf
from corpusprep.plans import doubles, jobs
from corpusprep.plans import views as V
from corpusprep.session import scratch_path
from corpusprep.sources import archive as A
from corpusprep.sources import folder, providers
from corpusprep.sources import store as S
from corpusprep.sources.jsonl import VAR, parse_lines, read_jsonl, valid_records, write_jsonl

P = jobs.ClassifyParams(doubles.rule_model, target_per_language=5)


def test_sample_survives_a_new_scan_layout(spark):
    path = scratch_path(spark, "layout")
    write_jsonl(V.as_lines(V.record_rows(spark, SMALL)), path)
    tagged = jobs.tag_records(read_jsonl(spark, path), P)
    picked = sampling.sample_per_language(tagged, 10, seed=42, fetch_from=tagged)
    expected = sorted(r[0] for r in picked.select(identity.RID).collect())
    old = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.minPartitionNum", "37")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        again = sorted(r[0] for r in picked.select(identity.RID, F.rand().alias("x")).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum") if old is None else spark.conf.set("spark.sql.files.minPartitionNum", old)
    assert again == expected and len(expected) > 20


def _counting(counter):
    """A model that adds the number of its texts to a Spark accumulator."""

    class Counting:
        def predict(self, texts):
            counter.add(len(texts))
            return doubles.RuleAdModel().predict(texts)

    return Counting


def test_model_sees_each_record_once(spark):
    arch = A.Archive(spark, V.archive_path(spark, SMALL))
    store, seen = scratch_path(spark, "once"), spark.sparkContext.accumulator(0)
    jobs.run_sampling(spark, V.records_no_text(spark, SMALL), store, arch, jobs.ClassifyParams(_counting(seen), target_per_language=5), "r1")
    assert seen.value == S.read_store(spark, store).count() > 0

    from corpusprep.streaming.incremental import classify_batch

    landing, store, seen = scratch_path(spark, "once-in"), scratch_path(spark, "once-stream"), spark.sparkContext.accumulator(0)
    write_jsonl(V.as_lines(V.no_text_rows(spark, SMALL)), landing)
    batch = spark.read.text(landing).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    classify_batch(batch, 0, store, arch, jobs.ClassifyParams(_counting(seen)))
    assert seen.value == S.read_store(spark, store).count() > 0


def test_new_shards_once_with_blank_and_fallback_ids(spark):
    lines = [{"ft": "no id"}, {"id": "", "ft": "blank"}, {"id": None, "ft": "null"}, {"c_id": "gaz-1901-7", "ft": "fallback"}, {"id": "gaz-1902-1", "ft": "x"}]
    recs = valid_records(parse_lines(spark.createDataFrame([(json.dumps(x), i) for i, x in enumerate(lines)], "value string, _seq long")))
    out = scratch_path(spark, "shards")
    for run in range(3):
        jobs.profile_new_shards(recs, out, f"t{run}")
    back = spark.read.schema("value string, newspaper string, yr string").text(out)
    assert back.count() == len(lines)
    assert back.filter("newspaper = 'gaz' and yr = '1901'").count() == 1


@pytest.mark.parametrize("reply,words", [
    ('{"english_keywords":["a", " b "]}', ["a", "b"]), ('{"english_keywords":["a"]} trailing', None),
    ('{"english_keywords":["a"]},{"english_keywords":["b"]}', None), ("[1]", None), ('{"english_keywords":"a"}', []), ("", None), (None, None)])
def test_reply_is_exactly_one_object(spark, reply, words):
    row = spark.createDataFrame([(reply,)], "r string").select(keywords.parse_reply(F.col("r")).alias("d")).select(keywords.parse_keywords(F.col("d")).alias("k"))
    assert row.first()["k"] == words


def test_labels_are_stripped_like_python(spark):
    rows = spark.createDataFrame([("non-ad\n",), ("\tAD ",), (" non-ad",)], "l string")
    assert [r[0] for r in rows.select(C.checked_label(F.col("l"), F.lit("1"))).collect()] == ["non-ad", "ad", "non-ad"]


@pytest.mark.parametrize("text", ['{"P": {"country": "X", "titles": ["a"]}', '["x"]', '{"P": {}} {"Q": {}}', "5"])
def test_provider_file_must_be_one_object(spark, text):
    with pytest.raises(Exception, match="not one JSON object"):
        providers.parse_providers(spark.createDataFrame([(text,)], "value string")).collect()


def _fragile():
    """Made in a function so that it travels to the workers by value."""

    def completer():
        def complete(request):
            if request["k_id"].endswith("3"):
                raise RuntimeError("bad article")
            return {"reply": '{"english_keywords": ["x"]}', "prompt_tokens": 1, "completion_tokens": 1, "total_tokens": 2}

        return complete

    return completer


def test_one_bad_article_fails_alone(spark):
    recs = valid_records(folder.scan_language_folder(spark, V.keyword_folder(spark, SMALL)))
    countries = providers.newspaper_country(providers.read_providers(spark, V.providers_path(spark, SMALL)))
    out = keywords.with_results(keywords.generate(recs, countries, _fragile())).select("k_id", "k_failed", "k_article_chars").collect()
    assert any(not r["k_failed"] for r in out)
    assert all(r["k_failed"] == (r["k_article_chars"] == 0 or r["k_id"].endswith("3")) for r in out)


def test_cap_counts_each_file(spark, tmp_path):
    for name in ("de.jsonl", "de2.jsonl"):
        (tmp_path / name).write_text("\n".join(json.dumps({"id": f"{name}-{i}", "ft": "t"}) for i in range(9)) + "\n")
    recs = valid_records(folder.scan_language_folder(spark, str(tmp_path)).withColumn(folder.LANG_FILE, F.lit("de")))
    first = sampling.first_n_per_group(recs, folder.SOURCE, 4)
    assert {r[0]: r[1] for r in first.groupBy(folder.SOURCE).count().collect()}.values() and first.count() == 8
    assert sorted(r[0] for r in first.select(as_str(F.col(VAR), "id")).collect()) == sorted(f"{n}-{i}" for n in ("de.jsonl", "de2.jsonl") for i in range(4))


def test_folder_scan_can_stay_at_the_top(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("de.jsonl", "sub/fr.jsonl"):
        (tmp_path / name).write_text('{"id": "x"}\n')
    assert folder.scan_language_folder(spark, str(tmp_path)).count() == 2
    assert folder.scan_language_folder(spark, str(tmp_path), recursive=False).count() == 1


def test_settings_of_the_caller_stay(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    session.apply_defaults(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "64"
    assert spark.conf.get("spark.sql.mapKeyDedupPolicy") == "LAST_WIN"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_tfidf_rows_stay_apart_and_short_terms_count(spark):
    docs = spark.createDataFrame([("", "ab ab 12"), ("", "xy"), (None, None), ("d", "日本")], "id string, text string")
    got = tfidf.tfidf_keywords(docs, "id", "text").collect()
    assert sorted((r["id"] or "", r["keywords"]) for r in got) == [("", []), ("", ["ab", "12"]), ("", ["xy"]), ("d", ["日本"])]


def test_too_large_line_has_its_own_status(spark):
    line = F.concat(F.lit('{"id":"x","ft":"'), F.repeat(F.lit("a"), 21_000_000), F.lit('"}'))
    assert parse_lines(spark.range(1).select(line.alias("value"))).select("_status").first()[0] == "too_large"


def test_run_result_counters(spark):
    arch = A.Archive(spark, V.archive_path(spark, SMALL))
    store, out = scratch_path(spark, "counters"), scratch_path(spark, "counters-out")
    res = jobs.labelling_run(spark, V.records_no_text(spark, SMALL), store, arch, P, classify_remaining=True, export_path=out)
    n = res.counters.first()
    articles = V.no_text_rows(spark, SMALL).filter("doc_id % 5 <> 0")
    lost = articles.filter("ft is null and doc_id % 11 = 0").count()
    assert n["unresolved_records"] == lost and n["sampled_new"] + n["remaining_new"] + lost == articles.count()
    assert {r["language"]: r["rows"] for r in res.exported.collect()} == {r["lg"]: min(5, r["non_ads"]) for r in res.non_ads.collect()}
