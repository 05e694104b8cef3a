"""Shard marks: finished shards are not opened, half-written ones are redone."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corpusprep.plans import jobs
from corpusprep.session import scratch_path
from corpusprep.sources.archive import Archive


def _archive(root, shards, layout):
    for (paper, year), texts in shards.items():
        folder = root / paper if layout == "shard_files" else root / f"newspaper={paper}" / f"yr={year}"
        folder.mkdir(parents=True, exist_ok=True)
        name = f"{paper}-{year}.jsonl" if layout == "shard_files" else "part-0.txt"
        (folder / name).write_text("".join(json.dumps({"id": f"{paper}-{year}-{i}", "ft": t}) + "\n" for i, t in enumerate(texts)))
        yield (paper, year), folder / name


def _profiles(spark, out):
    rows = spark.read.schema("value string, newspaper string, yr string").option("basePath", out).text(f"{out}/newspaper=*").collect()
    return {(json.loads(r["value"])["id"], json.loads(r["value"])["length"], json.loads(r["value"])["ts"]) for r in rows}


@pytest.mark.parametrize("layout", ["partitioned", "shard_files"])
def test_finished_shards_are_not_opened(spark, tmp_path, layout):
    shards = {("gaz", "1901"): ["aa", "bbb"], ("gaz", "1902"): ["c"], ("exp", "1901"): ["dddd"]}
    files = dict(_archive(tmp_path / "in", shards, layout))
    archive, out = Archive(spark, f"file://{tmp_path}/in", layout=layout), scratch_path(spark, "profiled")
    jobs.profile_shards(archive, out, "t1")
    first = _profiles(spark, out)
    assert first == {("gaz-1901-0", 2, "t1"), ("gaz-1901-1", 3, "t1"), ("gaz-1902-0", 1, "t1"), ("exp-1901-0", 4, "t1")}
    # other text of the same size and time: whoever opens the file would see it
    path = files["gaz", "1902"]
    at = path.stat()
    path.write_text(path.read_text().replace('"c"', '999'))
    os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
    if (path.parent / f".{path.name}.crc").exists():
        raise AssertionError("a checksum file would hide the change")
    # a shard that grew, and a new one
    grown = files["exp", "1901"]
    grown.write_text(grown.read_text() + json.dumps({"id": "exp-1901-9", "ft": "new"}) + "\n")
    dict(_archive(tmp_path / "in", {("neu", "1999"): ["n"]}, layout))
    jobs.profile_shards(archive, out, "t2")
    kept = {r for r in first if not r[0].startswith("exp")}
    assert _profiles(spark, out) == kept | {("exp-1901-0", 4, "t2"), ("exp-1901-9", 3, "t2"), ("neu-1999-0", 1, "t2")}
    jobs.profile_shards(archive, out, "t3")
    assert {r[2] for r in _profiles(spark, out)} == {"t1", "t2"}


def test_half_written_shards_are_redone(spark, tmp_path):
    dict(_archive(tmp_path / "in", {("gaz", "1901"): ["aa", "bbb"], ("gaz", "1902"): ["c"]}, "partitioned"))
    archive, out = Archive(spark, f"file://{tmp_path}/in"), scratch_path(spark, "half")
    # what an interrupted run left: some lines of one shard, no mark
    half = spark.createDataFrame([('{"id":"gaz-1901-0","length":2,"alphabetic_ratio":1.0,"ts":"t0"}', "gaz", "1901")], "value string, newspaper string, yr string")
    half.write.partitionBy("newspaper", "yr").text(out)
    jobs.profile_shards(archive, out, "t1")
    assert _profiles(spark, out) == {("gaz-1901-0", 2, "t1"), ("gaz-1901-1", 3, "t1"), ("gaz-1902-0", 1, "t1")}
    marks = jobs.finished_shards(spark, out)
    assert marks.count() == 2 and marks.filter(F.length("fingerprint") == 64).count() == 2
