"""A ledger of paid model calls: a request that has its reply there is never sent again.

``<ledger>/`` holds Parquet rows (request hash, reply, token counts, error, kind).  Missing
requests are sent in small tasks; a task's replies become visible when it ends, whatever happens to the
job later, so a job that is killed loses the requests that are under way and nothing else.  At
most ``max_concurrency`` requests are under way at a time: they are sent in rounds of that many tasks.

Errors are told apart by kind: ``transient`` ones (time-outs, lost connections, or an exception with a
true attribute ``transient``) are tried again after a pause, and in the next run if they persist;
others are final and kept as the answer.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator
from functools import cache, partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.sources.staging import no_rows, stage
from corpusprep.sources.store import path_exists

HASH = "k_hash"
REPLY = "reply string, prompt_tokens bigint, completion_tokens bigint, total_tokens bigint, error string"
_ROW = f"{HASH} string, {REPLY}, kind string"
OK, FINAL, TRANSIENT = "ok", "final", "transient"
#: Requests of one task: what a killed job may have to send again for each task that was running.
PER_TASK = 128

Completer = Callable[[], Callable[[dict], dict]]


def request_hash(*parts: Column) -> Column:
    """SHA-256 of the request's texts, each with its length, so that no two requests read alike."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat(*[F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]), 256)


def is_transient(exc: Exception) -> bool:
    return bool(getattr(exc, "transient", isinstance(exc, (TimeoutError, ConnectionError))))


@cache
def _client(factory: Completer) -> Callable[[dict], dict]:
    return factory()


def _answer(client: Callable[[dict], dict], request: dict, tries: int, pause: float) -> dict:
    """The reply, or the error of the last try."""
    for k in range(tries):
        try:
            return dict(client(request)) | {"kind": OK}
        except Exception as exc:  # noqa: BLE001 -- a failed call fails its row
            failed = {"error": repr(exc), "kind": TRANSIENT if is_transient(exc) else FINAL}
        if failed["kind"] == FINAL:
            break
        if k + 1 < tries:
            time.sleep(pause * 2 ** k)
    return failed


def _send(factory: Completer, tries: int, pause: float, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    client = _client(factory)
    names = [c.split()[0] for c in _ROW.split(", ")]
    for batch in batches:
        answers = [_answer(client, {k: v for k, v in r.items() if k != HASH}, tries, pause) | {HASH: r[HASH]} for r in batch.to_dict("records")]
        column = lambda c: pd.Series([a.get(c) for a in answers], dtype="Int64" if c.endswith("_tokens") else "object")  # noqa: B023, E731
        yield pd.DataFrame({c: column(c) for c in names})


def read_ledger(spark, ledger: str) -> DataFrame:
    """(request hash, reply struct): one answer for each request, replies before final errors; transient ones are left out."""
    rows = spark.read.schema(_ROW).parquet(ledger) if path_exists(spark, ledger) else no_rows(spark, _ROW)
    fields = [c.split()[0] for c in REPLY.split(", ")]
    best = F.max(F.struct((F.col("kind") == OK).alias("ok"), F.struct(*fields).alias("r")))
    return rows.filter(F.col("kind") != TRANSIENT).groupBy(HASH).agg(best.alias("best")).select(HASH, F.col("best.r").alias("_reply"))


def send_missing(requests: DataFrame, ledger: str, completer: Completer, *, max_concurrency: int | None = None, per_task: int = PER_TASK,
                 tries: int = 3, pause: float = 1.0) -> None:
    """Send every request (``k_hash`` and its fields) that has no answer in the ledger, equal ones once, and append the answers."""
    spark = requests.sparkSession
    known = read_ledger(spark, ledger).select(HASH)
    # what occurs more than once is found on the hashes alone: only these requests are exchanged to be made one
    missing = stage(requests.join(known, HASH, "left_anti"), "missing_requests")
    again = stage(missing.groupBy(HASH).count().filter(F.col("count") > 1).select(HASH), "repeated_requests")
    todo = missing.join(again, HASH, "left_anti").unionByName(missing.join(again, HASH, "left_semi").dropDuplicates([HASH]))
    n = todo.select(HASH).count()
    tasks = math.ceil(n / per_task)
    rounds = math.ceil(tasks / max_concurrency) if max_concurrency else min(tasks, 1)
    for k in range(rounds):
        part = todo if rounds == 1 else todo.filter(F.pmod(F.xxhash64(HASH), F.lit(rounds)) == k)
        dealt = part.repartition(max_concurrency or tasks)
        # version 2: a task's file is final when the task ends, not when the job does
        (dealt.mapInPandas(partial(_send, completer, tries, pause), _ROW).write.mode("append")
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(ledger))


def with_replies(rows: DataFrame, ledger: str) -> DataFrame:
    """``rows`` with ``_reply``: the ledger's answer, NULL where the request was not sent or failed for the time being."""
    return rows.join(read_ledger(rows.sparkSession, ledger), HASH, "left")
