"""The streaming driver: files landing in two waves, each ID labelled once."""

from pyspark.sql import functions as F

from conftest import SMALL
from corpusprep.operators.identity import RID
from corpusprep.plans import doubles, jobs
from corpusprep.plans import views as V
from corpusprep.session import scratch_path
from corpusprep.sources import store as S
from corpusprep.sources.archive import Archive
from corpusprep.sources.jsonl import write_jsonl
from corpusprep.streaming import classify_new_files


def test_stream_labels_each_id_once(spark):
    landing, store, ckpt = (scratch_path(spark, n) for n in ("landing", "stream-store", "stream-ckpt"))
    arch = Archive(spark, V.archive_path(spark, SMALL))
    lines = V.as_lines(V.no_text_rows(spark, SMALL))
    write_jsonl(lines.filter(F.col("_seq") % 2 == 0), landing + "/wave1")
    classify_new_files(spark, landing + "/*", store, arch, ckpt, jobs.ClassifyParams(doubles.rule_model)).awaitTermination()
    # second wave repeats every record: only the new ones may be added
    write_jsonl(lines, landing + "/wave2")
    classify_new_files(spark, landing + "/*", store, arch, ckpt, jobs.ClassifyParams(doubles.rule_model)).awaitTermination()
    st = S.read_store(spark, store)
    assert st.count() == st.select(RID).distinct().count()
    assert st.select("run_id").distinct().count() == 2
    expected = V.no_text_rows(spark, SMALL).filter(F.col("doc_id") % 5 != 0)
    # every article with text (own or archived) ends up in the store
    assert st.count() > 0.5 * expected.count()


def test_replayed_epoch_leaves_one_copy(spark):
    from corpusprep.streaming.incremental import classify_batch

    landing, store = scratch_path(spark, "landing-replay"), scratch_path(spark, "store-replay")
    arch = Archive(spark, V.archive_path(spark, SMALL))
    write_jsonl(V.as_lines(V.no_text_rows(spark, SMALL)), landing)
    batch = spark.read.text(landing).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    p = jobs.ClassifyParams(doubles.rule_model)
    classify_batch(batch, 0, store, arch, p)
    first = sorted(r[0] for r in S.read_store(spark, store).select(RID).collect())
    classify_batch(batch, 0, store, arch, p)  # the same epoch again, as after a failure
    again = sorted(r[0] for r in S.read_store(spark, store).select(RID).collect())
    assert first == again and len(first) == len(set(first)) > 0
    assert sorted(r[0] for r in S.store_ids(spark, store).collect()) == first
