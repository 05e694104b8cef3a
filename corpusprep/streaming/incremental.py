"""Classify files as they land, never reprocessing an ID.

The batch job already runs incrementally against the labelled store; this
drives it from a file stream.  Each micro-batch is one run: its new lines are
parsed, minus the store, enriched, classified and committed as run
``epoch-<n>``.  A batch replayed after a failure finds its run committed and does nothing, or finds no trace
of an attempt that did not commit; the stream checkpoint records which files were
consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusprep.plans import jobs
from corpusprep.sources import store as S
from corpusprep.sources.archive import Archive
from corpusprep.sources.jsonl import FILE, SEQ, line_seq, parse_lines


def classify_new_files(
    spark: SparkSession,
    landing: str,
    store_path: str,
    archive: Archive | DataFrame,
    checkpoint: str,
    params: jobs.ClassifyParams,
    *,
    files_per_batch: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops after the files present."""
    p = params
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.load(landing)
    lines = raw.select(
        "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("_block"),
    )

    def run(batch: DataFrame, epoch_id: int) -> None:
        classify_batch(batch, epoch_id, store_path, archive, p)

    writer = lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def classify_batch(batch: DataFrame, epoch_id: int, store_path: str, archive: Archive | DataFrame,
                   p: jobs.ClassifyParams) -> None:
    """One micro-batch: parse, drop stored IDs, enrich, classify, append the run ``epoch-<n>`` unless it is committed."""
    spark, run = batch.sparkSession, f"epoch-{epoch_id:08d}"
    seen = S.store_version(spark, store_path)
    if run in S.store_runs(spark, store_path):
        return
    # line order within the batch (row ids are a batch-side expression)
    parsed = parse_lines(batch.select("value", line_seq(None, F.col(FILE), F.col("_block")).alias(SEQ), FILE))
    new_rows = jobs.classify_rest(parsed, S.processed_ids(spark, store_path), archive, p).select("value", SEQ, S.RID)
    S.append_run(new_rows, store_path, run, expect_version=seen)
