"""The store's commit log: exclusive commits, order of runs, the merged ID index."""

import threading

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from corpusprep.operators import identity
from corpusprep.plans import doubles, jobs
from corpusprep.plans import views as V
from corpusprep.session import scratch_path
from corpusprep.sources import store as S
from corpusprep.sources.archive import Archive
from corpusprep.sources.jsonl import SEQ


def _lines(spark, ids):
    return spark.createDataFrame([(f'{{"id": "{i}", "ad_class": "ad"}}', n) for n, i in enumerate(ids)], f"value string, {SEQ} long")


def test_create_if_absent_is_exclusive(spark, tmp_path):
    path = f"file://{tmp_path}/log/1.json"
    wins = []
    gate = threading.Barrier(8)

    def race(k):
        gate.wait()
        if S.create_if_absent(spark, path, f'{{"k": {k}}}'):
            wins.append(k)

    threads = [threading.Thread(target=race, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(wins) == 1 and (tmp_path / "log" / "1.json").read_text() == f'{{"k": {wins[0]}}}'
    assert [p.name for p in (tmp_path / "log").iterdir()] == ["1.json"]


def test_create_by_rename_refuses_an_existing_target(spark, tmp_path):
    """The way of HDFS-like file systems, on a local folder."""
    path = f"file://{tmp_path}/log/1.json"
    assert S._exclusive_rename(spark, path, "{}") and not S._exclusive_rename(spark, path, '{"other": 1}')
    assert (tmp_path / "log" / "1.json").read_text() == "{}"
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")] == ["1.json"]


def test_two_runs_at_once_commit_one(spark):
    """Both start from the same version and pick the same IDs: one commits, no ID is there twice."""
    store, archive = scratch_path(spark, "store-two"), Archive(spark, V.archive_path(spark, SMALL))
    parsed = V.records_no_text(spark, SMALL)
    S.append_run(_lines(spark, ["x"]), store, "r0")
    gate, results = threading.Barrier(2), []
    real = S.append_run

    def together(*args, **kwargs):
        gate.wait()
        return real(*args, **kwargs)

    def run(k):
        try:
            jobs.S = _Patched(S, together)
            jobs.run_sampling(spark, parsed, store, archive, jobs.ClassifyParams(doubles.rule_model, target_per_language=5), f"run{k}")
            results.append("committed")
        except S.ConcurrentRunError:
            results.append("refused")

    try:
        threads = [threading.Thread(target=run, args=(k,)) for k in range(2)]
        [t.start() for t in threads]
        [t.join() for t in threads]
    finally:
        jobs.S = S
    assert sorted(results) == ["committed", "refused"]
    st = S.read_store(spark, store)
    assert len(S.store_runs(spark, store)) == 2 and st.count() > 1
    assert st.count() == st.select(identity.RID).distinct().count() == S.store_ids(spark, store).count()


class _Patched:
    def __init__(self, module, append):
        self._module, self.append_run = module, append

    def __getattr__(self, name):
        return getattr(self._module, name)


def test_runs_are_read_in_commit_order(spark):
    store = scratch_path(spark, "store-order")
    for run in ("r2", "r10", "a"):
        S.append_run(_lines(spark, [f"{run}-{i}" for i in range(20)]).repartition(3), store, run)
    got = [r[0] for r in S.read_store(spark, store).orderBy(SEQ).select(identity.RID).collect()]
    assert got == [f"{run}-{i}" for run in ("r2", "r10", "a") for i in range(20)]
    some = S.read_store(spark, store, runs=["r10"])
    assert some.count() == 20 and {r[0] for r in some.select("run_id").distinct().collect()} == {"r10"}
    with pytest.raises(ValueError):
        S.append_run(_lines(spark, ["y"]), store, "no/slash")


def test_merged_ids_need_no_exchange(spark):
    store = scratch_path(spark, "store-merged")
    for run in range(3):
        S.append_run(_lines(spark, [f"{run}-{i}" for i in range(400)]), store, f"r{run}", compact_after=0)
    assert len(S.processed_ids(spark, store)) == 1
    S.compact_ids(spark, store, ids_per_bucket=100)
    S.append_run(_lines(spark, [f"new-{i}" for i in range(10)]), store, "later", compact_after=0)
    base, later = S.processed_ids(spark, store)
    assert base.count() == 1200 and later.count() == 10 and S.store_ids(spark, store).count() == 1210
    name = F.when(F.col("id") == 0, "new-3").otherwise(F.concat(F.lit("1-"), F.col("id").cast("string")))
    records = spark.range(2000).select(name.alias(identity.RID))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = identity.unprocessed(records, [base])
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert identity.unprocessed(records, [base, later]).count() == 2000 - 399 - 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("processed_ids_")]


def test_index_is_merged_after_some_runs(spark):
    store = scratch_path(spark, "store-auto")
    for run in range(5):
        S.append_run(_lines(spark, [f"{run}-{i}" for i in range(5)]), store, f"r{run}", compact_after=2)
    log = S.commits(spark, store)
    assert [c.version for c in log] == list(range(1, 8)) and sum(bool(c.base) for c in log) == 2
    assert S.store_ids(spark, store).count() == 25 == S.read_store(spark, store).count()


def test_an_empty_store_reads_as_empty(spark):
    store = scratch_path(spark, "store-none")
    assert S.read_store(spark, store).count() == 0 == S.store_ids(spark, store).count() and S.store_version(spark, store) == 0
    S.append_run(_lines(spark, []), store, "nothing")
    assert S.read_store(spark, store).count() == 0 == S.store_ids(spark, store).count() and S.store_runs(spark, store) == ["nothing"]
