"""The labelled store: every classified record, append-only, with a commit log.

Layout under the store's folder::

    attempt=<run>.<token>/part-*   JSONL lines (record + label field) of one attempt at a run
    _ids/<run>.<token>/            that attempt's IDs, narrow Parquet
    _ids/base-<token>/             IDs of many runs, bucketed by ID
    _commits/<version>.json        version 1, 2, 3 ...: what became visible with it

A run writes its records, then its IDs, then creates the next version's manifest, which fails
if that version exists.  Readers follow the manifests only: what a failed or refused attempt wrote is
never seen, and of two runs that started from the same version one commits.  ``compact_ids``
merges the IDs of all runs into one bucketed base; later runs add to it until the next compaction.

The exclusive create is a hard link on local folders, a rename that refuses an existing target
on HDFS-like ones, and a conditional put where the file system offers it (``s3a``, ``gs``).
"""

from __future__ import annotations

import json
import math
import os
import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.operators.identity import RID, stable_id
from corpusprep.sources.jsonl import FILE, SEQ, VAR, line_seq, parse_lines, valid_records
from corpusprep.sources.staging import stage

RUN = "run_id"
ATTEMPT = "attempt"
IDS = "_ids"
COMMITS = "_commits"
#: Runs whose IDs lie in folders of their own before they are merged.
COMPACT_AFTER = 16
#: IDs in one bucket of the merged index (about 20 MB).
IDS_PER_BUCKET = 500_000
_CONDITIONAL_PUT = ("s3a", "gs")


class ConcurrentRunError(RuntimeError):
    """Another run was committed to the store after this run read its IDs."""


class RunExistsError(ValueError):
    """The store has a committed run of that name."""


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


# ------------------------------------------------------------------ commit log
@dataclass(frozen=True)
class Commit:
    version: int
    run: str | None = None  # a run's records and IDs ...
    attempt: str | None = None
    base: str | None = None  # ... or a merged index of all IDs up to ``upto``
    buckets: int = 0
    upto: int = 0


def _child(path: str, *names: str) -> str:
    return "/".join([path.rstrip("/"), *names])


#: Manifests that this process has read; a manifest never changes.
_READ: dict[str, Commit] = {}


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """The store's log in order: one small manifest for each run, no data file is listed."""
    fs, folder = _fs(spark, _child(path, COMMITS))
    if not fs.exists(folder):
        return []
    to_text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString
    log = []
    for status in fs.listStatus(folder):
        name = status.getPath().toString()
        if not name.endswith(".json"):
            continue
        if name not in _READ:
            stream = fs.open(status.getPath())
            _READ[name] = Commit(**json.loads(to_text(stream, "UTF-8")))
            stream.close()
        log.append(_READ[name])
    return sorted(log, key=lambda c: c.version)


def store_version(spark: SparkSession, path: str) -> int:
    """The newest version (0: nothing committed), for ``append_run``'s ``expect_version``."""
    return max((c.version for c in commits(spark, path)), default=0)


def store_runs(spark: SparkSession, path: str) -> list[str]:
    """The committed runs in order."""
    return [c.run for c in commits(spark, path) if c.run is not None]


def _commit(spark: SparkSession, path: str, commit: Commit) -> bool:
    """Publish a version; False if it exists."""
    doc = json.dumps({k: v for k, v in vars(commit).items() if v})
    return create_if_absent(spark, _child(path, COMMITS, f"{commit.version:020d}.json"), doc)


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file in one step, whole or not at all; False if the path exists."""
    scheme = _fs(spark, path)[0].getUri().getScheme()
    put = _conditional_put if scheme in _CONDITIONAL_PUT else _hard_link if scheme == "file" else _exclusive_rename
    return put(spark, path, text)


def _conditional_put(spark: SparkSession, path: str, text: str) -> bool:
    fs, target = _fs(spark, path)
    try:
        out = fs.createFile(target).overwrite(False).recursive().opt("fs.option.create.conditional.overwrite", "true").build()
        out.write(bytearray(text.encode()))
        out.close()
    except Exception as exc:
        return _refused(exc)
    return True


def _hard_link(spark: SparkSession, path: str, text: str) -> bool:
    """For a local folder, which lies on the driver's machine as this process does."""
    target = _fs(spark, path)[1].toUri().getPath()
    os.makedirs(os.path.dirname(target), exist_ok=True)
    draft = os.path.join(os.path.dirname(target), f".{uuid.uuid4().hex}")
    with open(draft, "w", encoding="utf-8") as f:
        f.write(text)
    try:
        os.link(draft, target)
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True


def _exclusive_rename(spark: SparkSession, path: str, text: str) -> bool:
    jvm = spark.sparkContext._jvm
    fs, target = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, target, how)
    except Exception as exc:
        fs.delete(draft, False)
        return _refused(exc)
    return True


def _refused(exc: Exception) -> bool:
    """False if the file exists; any other failure is raised."""
    if "FileAlreadyExists" in str(exc):
        return False
    raise exc


# ------------------------------------------------------------------ reading
def read_store(spark: SparkSession, path: str, *, id_field: str = "id", class_field: str = "ad_class",
               runs: list[str] | None = None) -> DataFrame:
    """Committed records with ``_rid``, ``_seq`` (runs in the order of their commits) and ``run_id``; empty without any.
    ``runs`` limits the scan to those runs (pruned before parsing)."""
    log = [c for c in commits(spark, path) if c.run is not None and (runs is None or c.run in runs)]
    if not log:
        empty = spark.createDataFrame([], f"value string, {RUN} string")
        lines = empty.select("value", line_seq(F.lit(""), F.lit(""), F.lit(0).cast("bigint")).alias(SEQ), F.lit(None).cast("string").alias(FILE), RUN)
    else:
        # one row for each run: the scan reads the folders named, the join adds version and name
        named = F.broadcast(spark.createDataFrame([(c.attempt, c.run, f"{c.version:020d}") for c in log], f"{ATTEMPT} string, {RUN} string, _version string"))
        raw = spark.read.schema(f"value string, {ATTEMPT} string").text(path).filter(F.col(ATTEMPT).isin([c.attempt for c in log]))
        raw = raw.select("value", ATTEMPT, F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("_block")).join(named, ATTEMPT)
        lines = raw.select("value", line_seq(F.col("_version"), F.col(FILE), F.col("_block")).alias(SEQ), FILE, RUN)
    recs = valid_records(parse_lines(lines))
    return recs.withColumn(RID, stable_id(F.col(VAR), id_field, class_field))


def processed_ids(spark: SparkSession, path: str) -> list[DataFrame]:
    """The IDs of all committed runs in parts (one ``_rid`` column each): the merged base, bucketed by ID, and what came later.

    ``identity.unprocessed`` takes the parts one by one: an anti join with the bucketed part exchanges the
    records only, and the later runs are few.
    """
    log = commits(spark, path)
    base = max((c for c in log if c.base), key=lambda c: c.upto, default=None)
    later = [_child(path, IDS, c.attempt) for c in log if c.run is not None and (base is None or c.version > base.upto)]
    parts = [_bucketed(spark, _child(path, IDS, base.base), base.buckets)] if base else []
    if later or not parts:
        parts.append(spark.read.schema(f"{RID} string").parquet(*later) if later else spark.createDataFrame([], f"{RID} string"))
    return parts


def store_ids(spark: SparkSession, path: str) -> DataFrame:
    """Processed IDs (one ``_rid`` column) of all committed runs."""
    first, *rest = processed_ids(spark, path)
    for part in rest:
        first = first.unionByName(part)
    return first


def _bucketed(spark: SparkSession, path: str, buckets: int, rows: DataFrame | None = None) -> DataFrame:
    """The Parquet folder ``path`` as a table bucketed by ID; ``rows`` are written to it first.

    Only the session's catalog holds the definition, under a name of its own and no longer than this call: the plan keeps it.
    """
    name = f"processed_ids_{uuid.uuid4().hex}"
    escaped = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({RID} STRING) USING parquet CLUSTERED BY ({RID}) SORTED BY ({RID}) INTO {buckets} BUCKETS "
              f"LOCATION '{escaped}'")
    try:
        if rows is not None:
            rows.select(RID).repartition(buckets, RID).write.insertInto(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the definition: the location is not the table's own


# ------------------------------------------------------------------ writing
def new_run_id() -> str:
    return time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + f"-{time.time_ns() % 1_000_000:06d}"


def append_run(rows: DataFrame, path: str, run_id: str | None = None, *,
               id_field: str = "id", class_field: str = "ad_class", order_by: list[str] | None = None,
               ids: DataFrame | None = None, expect_version: int | None = None, compact_after: int = COMPACT_AFTER) -> str:
    """Append labelled lines (``value``) and their IDs as one new run; returns the run id.

    The run is written in ``order_by`` order (default: input line order when
    ``_seq`` is present), range partitioned so its part files read back in
    that order: "the first N in store order" is then reproducible.
    A range partitioned write evaluates its input twice, so ``rows`` is staged
    first: whatever made them (a model) runs once per row.
    ``ids`` (one column, e.g. from a staged table) are the run's IDs; rows that carry ``_rid`` need none,
    otherwise they are taken from the lines.  ``expect_version`` (the version at which the processed
    IDs were read) makes the commit fail with ``ConcurrentRunError`` when another run was committed in between: one
    manifest per version, created only if absent.  A name that a committed run has is refused.
    """
    run_id = run_id or new_run_id()
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"run id {run_id!r}: letters, digits, '_', '.' and '-' only")
    spark = rows.sparkSession
    _check(spark, path, run_id, expect_version)
    attempt = f"{run_id}.{uuid.uuid4().hex[:12]}"
    order = order_by if order_by is not None else ([SEQ] if SEQ in rows.columns else [])
    carried = [RID] if ids is None and RID in rows.columns else []
    rows = stage(rows.select("value", *[c for c in order if c != "value"], *carried), "store_run")
    if carried:
        ids = rows.select(RID)
    elif ids is None:
        ids = valid_records(parse_lines(rows)).select(stable_id(F.col(VAR), id_field, class_field))
    out = rows.select("value", *order)
    if order:
        out = out.repartitionByRange(*order).sortWithinPartitions(*order).drop(*[c for c in order if c != "value"])
    out.write.text(_child(path, f"{ATTEMPT}={attempt}"))
    ids.select(F.col(ids.columns[0]).alias(RID)).write.parquet(_child(path, IDS, attempt))
    while not _commit(spark, path, Commit(_check(spark, path, run_id, expect_version) + 1, run=run_id, attempt=attempt)):
        pass  # another commit took the version: look again
    if compact_after and _uncompacted(commits(spark, path)) >= compact_after:
        compact_ids(spark, path)
    return run_id


def _check(spark: SparkSession, path: str, run_id: str, expect_version: int | None) -> int:
    """The current version; raises if ``run_id`` may not be appended to it."""
    log = commits(spark, path)
    version = max((c.version for c in log), default=0)
    if any(c.run == run_id for c in log):
        raise RunExistsError(f"store {path} has a run {run_id}")
    if expect_version is not None and any(c.run is not None and c.version > expect_version for c in log):
        # the IDs this run excluded are stale: appending could label an ID twice
        raise ConcurrentRunError(f"store {path} changed since this run read it")
    return version


def _uncompacted(log: list[Commit]) -> int:
    upto = max((c.upto for c in log if c.base), default=0)
    return sum(c.run is not None and c.version > upto for c in log)


def compact_ids(spark: SparkSession, path: str, ids_per_bucket: int = IDS_PER_BUCKET) -> None:
    """Merge the IDs of all committed runs into one index bucketed by ID; readers take it from its commit on."""
    version = store_version(spark, path)
    every = store_ids(spark, path)
    buckets = max(1, math.ceil(every.count() / ids_per_bucket))
    base = f"base-{uuid.uuid4().hex[:12]}"
    _bucketed(spark, _child(path, IDS, base), buckets, every.distinct())
    while not _commit(spark, path, Commit(store_version(spark, path) + 1, base=base, buckets=buckets, upto=version)):
        pass


def import_store(spark: SparkSession, source: str, store_path: str, run_id: str = "00000000T000000-import", *,
                 id_field: str = "id", class_field: str = "ad_class") -> str:
    """Bring an existing labelled JSONL file (plain or compressed) into the
    store as its first run, in line order; invalid lines are skipped as the
    store reader would skip them."""
    from corpusprep.sources.jsonl import read_jsonl

    lines = valid_records(read_jsonl(spark, source)).select("value", SEQ)
    return append_run(lines, store_path, run_id, id_field=id_field, class_field=class_field)
