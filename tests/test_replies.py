"""The reply ledger and the chain that goes on where it stopped."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from corpusprep.operators import replies
from corpusprep.plans import doubles, jobs
from corpusprep.plans import views as V
from corpusprep.session import scratch_path
from corpusprep.sources import store as S
from corpusprep.sources.archive import Archive


def _counting(log, fail=None):
    """A completer that writes each call to a file of its own in ``log``; ``fail(request, calls so far)`` may raise."""

    def completer():
        def complete(request):
            import uuid

            calls = sum(open(os.path.join(log, f)).read() == request["k_id"] for f in os.listdir(log))
            with open(os.path.join(log, uuid.uuid4().hex), "w") as f:
                f.write(request["k_id"])
            if fail:
                fail(request, calls)
            return {"reply": json.dumps({"english_keywords": [request["k_id"]]}), "prompt_tokens": 1, "completion_tokens": 1, "total_tokens": 2}

        return complete

    return completer


def _calls(log):
    return Counter((log / f.name).read_text() for f in log.iterdir())


def _requests(spark, n):
    rows = spark.range(n).select(F.col("id").cast("string").alias("k_id"), F.lit("text").alias("k_article"))
    return rows.select(replies.request_hash(F.lit("m"), F.col("k_id"), F.col("k_article")).alias(replies.HASH), "k_id", "k_article")


def test_a_killed_job_sends_nothing_twice(spark, tmp_path):
    """The job dies at one request: the answers of all tasks that ended are kept, the next run sends the others."""
    log, ledger = tmp_path / "calls", scratch_path(spark, "ledger")
    log.mkdir()
    flag = tmp_path / "dying"
    flag.write_text("x")

    def fail(request, calls):
        if request["k_id"] == "37" and os.path.exists(str(flag)):
            import time

            time.sleep(1)  # the others are done by then
            raise KeyboardInterrupt("the worker is killed")

    reqs = _requests(spark, 60)
    with pytest.raises(Exception):
        replies.send_missing(reqs, ledger, _counting(str(log), fail), per_task=1)
    before = _calls(log)
    kept = {r[0] for r in replies.read_ledger(spark, ledger).collect()}
    assert 3 < len(kept) < 60
    flag.unlink()
    replies.send_missing(reqs, ledger, _counting(str(log), fail), per_task=1)
    after = _calls(log)
    answered = {r["k_id"] for r in reqs.filter(F.col(replies.HASH).isin(kept)).collect()}
    assert set(after) == {str(i) for i in range(60)} and all(after[i] == before[i] == 1 for i in answered)
    assert replies.read_ledger(spark, ledger).count() == 60
    replies.send_missing(reqs, ledger, _counting(str(log), fail))
    assert _calls(log) == after  # nothing is missing now


def test_errors_by_kind(spark, tmp_path):
    log, ledger = tmp_path / "calls", scratch_path(spark, "ledger-kinds")
    log.mkdir()

    def fail(request, calls):
        n = int(request["k_id"])
        if n == 1 and calls < 2:
            raise TimeoutError("later")
        if n == 2:
            raise ConnectionError("always")
        if n == 3:
            raise ValueError("bad request")

    reqs = _requests(spark, 6).union(_requests(spark, 6))  # equal requests are one
    replies.send_missing(reqs, ledger, _counting(str(log), fail), tries=3, pause=0.01)
    assert _calls(log) == {"0": 1, "1": 3, "2": 3, "3": 1, "4": 1, "5": 1}
    got = {r["k_id"]: r["_reply"] for r in replies.with_replies(reqs.distinct(), ledger).collect()}
    assert got["2"] is None and "bad request" in got["3"]["error"] and got["1"]["reply"] and got["1"]["error"] is None
    replies.send_missing(reqs, ledger, _counting(str(log)), tries=1)  # the connection is back
    assert _calls(log)["2"] == 4 and _calls(log)["3"] == 1
    assert replies.read_ledger(spark, ledger).count() == 6


def test_requests_under_way_are_bounded(spark, tmp_path, monkeypatch):
    log, ledger = tmp_path / "calls", scratch_path(spark, "ledger-rounds")
    log.mkdir()
    widths = []
    real = type(spark.range(1)).mapInPandas
    monkeypatch.setattr(type(spark.range(1)), "mapInPandas", lambda self, *a, **k: widths.append(self.rdd.getNumPartitions()) or real(self, *a, **k))
    replies.send_missing(_requests(spark, 50), ledger, _counting(str(log)), max_concurrency=3, per_task=4)
    assert set(_calls(log).values()) == {1} and len(_calls(log)) == 50
    assert len(widths) == 5 and max(widths) <= 3


def test_chain_again_changes_nothing(spark, tmp_path):
    log, out = tmp_path / "calls", scratch_path(spark, "chain-twice")
    log.mkdir()
    archive, p = Archive(spark, V.archive_path(spark, SMALL)), jobs.ClassifyParams(doubles.rule_model, target_per_language=6)
    run = lambda **how: sorted((tuple(r) for r in jobs.chain(
        spark, V.records_no_text(spark, SMALL), archive, V.providers_path(spark, SMALL), out, p, _counting(str(log)), **how).collect()), key=repr)
    first = run()
    calls, records = _calls(log), S.read_store(spark, f"{out}/store").count()
    lines = sorted(r["value"] for r in spark.read.text(f"{out}/keywords/lang_file=*").select("value").collect())
    assert calls and set(calls.values()) == {1}
    assert run() == first and run(restart=True) == first
    assert _calls(log) == calls and S.store_runs(spark, f"{out}/store") == ["r1"] and S.read_store(spark, f"{out}/store").count() == records
    assert sorted(r["value"] for r in spark.read.text(f"{out}/keywords/lang_file=*").select("value").collect()) == lines
    run(run_id="r2")  # another run: new records only
    st = S.read_store(spark, f"{out}/store")
    assert S.store_runs(spark, f"{out}/store") == ["r1", "r2"] and st.count() == st.select("_rid").distinct().count() > records
    assert set(_calls(log).values()) == {1}
