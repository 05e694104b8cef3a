"""What a job moves and counts: whole calibration, terms counted in their rows, inputs derived once, narrow dedup."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusprep.llm import language  # noqa: E402
from corpusprep.operators import replies, split, tfidf  # noqa: E402
from corpusprep.plans import jobs  # noqa: E402
from corpusprep.plans import views as V  # noqa: E402
from corpusprep.session import scratch_path  # noqa: E402
from corpusprep.sources import staging  # noqa: E402
from corpusprep.sources.jsonl import parse_lines, valid_records  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("q", [0.0, 0.37, 0.995, 1.0])
def test_limits_are_exact_quantiles_of_all_rows(spark, q):
    rows = [("ab"[k % 2], [(k * 7919 % 5003) / 5003, k % 4 / 4][k % 3 == 0]) for k in range(5200)] + [("one", 2.5)]
    df = spark.createDataFrame(rows, "lang string, cross_entropy double").repartition(5)
    want = {r["lang"]: r["p"] for r in df.groupBy("lang").agg(F.percentile("cross_entropy", q).alias("p")).collect()}
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = language._quantiles(df, q)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == pytest.approx(want, abs=1e-12)


def test_calibration_reads_every_learning_row(spark):
    """Rows without an id included, which the former sample of 4,000 left out."""
    texts = [(k, "abab baba abba", "xx") for k in range(4500)] + [(None, "cdcd dcdc", "yy"), (9000, None, "yy"), (9001, "eeee", None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    models = language.learn(docs)
    found = language.identify(docs, models, {})
    seen = {r["lang"]: r["v"] for r in found.filter("lang <> 'und'").groupBy("lang").agg(F.percentile("cross_entropy", 1 - language.REJECT).alias("v")).collect()}
    got = language.calibrate(docs, models)
    assert set(got) == {"xx", "yy"}  # the row without an id counts
    assert got["xx"] == pytest.approx(seen["xx"])
    row = lambda r: (r["id"] is None, r["id"], r["lang"], r["score"], r["cross_entropy"], r["rejected"])
    once = language.identify_calibrated(docs, models, F.lit(True))
    assert sorted(map(row, once.collect()), key=str) == sorted(map(row, language.identify(docs, models, got).collect()), key=str)


def test_terms_are_counted_without_a_shuffle_and_rare_ones_joined(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "FREQUENT", 2)  # both ways: broadcast and joined by term
    docs = [("a", "x x y. Z é"), ("b", None), ("b", ""), ("c", "x q q q 1 2 3 4 5"), ("a", "y x"), ("d", "x Y y")]
    staged = {}
    monkeypatch.setattr(tfidf, "stage", lambda df, name: staged.setdefault(name, (_plan(df), staging.stage(df, name)))[1])
    got = sorted((r.id, r.keywords) for r in tfidf.tfidf_keywords(spark.createDataFrame(docs, "id string, text string"), "id", "text").collect())
    assert "Exchange" not in staged["term_counts"][0]
    assert got == [("a", ["x", "y"][::-1]), ("a", ["z", "é", "x", "y"]), ("b", []), ("b", []), ("c", ["q", "1", "2", "3", "4"]), ("d", ["y", "x"])]


def test_views_derive_their_fields_after_the_range_partition(spark):
    plan = _plan(V.as_lines(V.record_rows(spark, SMALL, ordered=True)))
    above, below = plan.split("rangepartitioning", 1)
    assert "regexp_replace" in above and "regexp_replace" not in below
    ids = [r["id"] for r in valid_records(V.records(spark, SMALL)).orderBy("_seq").select(V.id_number(F.expr("try_variant_get(_v, '$.id', 'string')")).alias("id")).collect()]
    assert ids == sorted(ids) and len(ids) == V.documents(spark, SMALL).count()


def test_first_run_without_marks_or_ledger_joins_nothing(spark):
    recs = valid_records(V.records(spark, SMALL)).withColumn("newspaper", F.lit("n")).withColumn("yr", F.lit("1"))
    done = jobs.finished_shards(spark, scratch_path(spark, "none"))
    assert done.dtypes == [("newspaper", "string"), ("yr", "string"), ("fingerprint", "string")]
    assert "Join" not in _plan(recs.join(done, ["newspaper", "yr"], "left_anti"))
    empty = replies.read_ledger(spark, scratch_path(spark, "none"))
    assert "Exchange" not in _plan(recs.withColumn(replies.HASH, F.lit("h")).join(empty, replies.HASH, "left"))


def test_ordered_split_samples_a_staged_table(spark, monkeypatch):
    names = []
    monkeypatch.setattr(split, "stage", lambda df, name: names.append(name) or staging.stage(df, name))
    split.split_by_language(parse_lines(V.as_lines(V.record_rows(spark, SMALL))), scratch_path(spark, "t_split"), preserve_order=True)
    assert names == ["split_lines"]


def test_equal_requests_are_sent_once_and_found_on_their_hashes(spark, monkeypatch):
    rows = [(str(k % 7) if k < 50 else str(k), f"r{k % 7}" if k < 50 else f"r{k}") for k in range(80)]
    req = spark.createDataFrame(rows, "k_hash string, k_id string").repartition(4)
    echo = lambda: lambda request: {"reply": request["k_id"]}  # noqa: E731 -- local, so that it travels by value
    staged = []
    monkeypatch.setattr(replies, "stage", lambda df, name: staged.append(name) or staging.stage(df, name))
    ledger = scratch_path(spark, "t_ledger")
    replies.send_missing(req, ledger, echo, per_task=10)
    sent = [r["k_hash"] for r in spark.read.parquet(ledger).collect()]
    assert sorted(sent) == sorted({r[0] for r in rows})
    assert "repeated_requests" in staged
    replies.send_missing(req, ledger, echo, per_task=10)
    assert spark.read.parquet(ledger).count() == len(sent)
