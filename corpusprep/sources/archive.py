"""The article archive: JSONL shards partitioned by ``(newspaper, yr)``.

Looking records up by ID is a join on ``(newspaper, yr, id)``: the first two
columns come from the ID (``newspaper-year-...``) and are the archive's
partition columns, so Spark prunes shards statically or dynamically (DPP)
instead of scanning the whole archive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.coerce import as_str, shard_key, to_int
from corpusprep.sources.jsonl import FILE, SEQ, VAR, line_seq, parse_lines, valid_records
from corpusprep.sources.staging import stage

NEWSPAPER = "newspaper"
YEAR = "yr"


def shard_of(record_id: Column) -> tuple[Column, Column]:
    """(newspaper, year) partition values named by an ID."""
    shard = shard_key(record_id)
    return F.substring_index(shard, "-", 1), F.substring_index(shard, "-", -1)


@dataclass
class Archive:
    """An archive location and its field names; read lazily, pruned per lookup.

    ``layout="partitioned"``: ``newspaper=<n>/yr=<y>/`` folders.
    ``layout="shard_files"``: ``<n>/<n>-<y>.jsonl[.bz2|.gz]`` files (one per
    newspaper-year), pruned by file name.
    """

    spark: SparkSession
    path: str
    match_field: str = "id"
    text_field: str = "ft"
    length_field: str = "len"
    title_field: str = "title"
    layout: str = "partitioned"

    def read(self, shards: DataFrame | None = None) -> DataFrame:
        """Archive rows projected to ``a_id, a_text, a_len, a_title`` plus shard columns and line position.

        ``shards`` (``newspaper, yr``) limits the scan to those shards, before anything is parsed.
        """
        v = F.col(VAR)
        return self.records(shards).select(
            NEWSPAPER, YEAR, SEQ,
            as_str(v, self.match_field).alias("a_id"),
            as_str(v, self.text_field).alias("a_text"),
            to_int(v, self.length_field).alias("a_len"),
            as_str(v, self.title_field).alias("a_title"),
        )

    def records(self, shards: DataFrame | None = None) -> DataFrame:
        """The valid records themselves with shard columns and line position."""
        if self.layout == "shard_files":
            lines = self._shard_file_lines(shards)
        elif self.layout == "partitioned":
            lines = self._partition_lines(shards)
        else:
            raise ValueError(f"unknown archive layout {self.layout!r}")
        return valid_records(parse_lines(lines.withColumn(SEQ, line_seq(None, F.col(FILE), F.col("_block"))).drop("_block")))

    def shards(self) -> DataFrame:
        """The shards that the archive holds (``newspaper, yr``, and ``file`` for shard files): from file names, no file is opened."""
        files = self.files()
        return files.select(NEWSPAPER, YEAR, "file").distinct() if self.layout == "shard_files" else files.select(NEWSPAPER, YEAR).distinct()

    def files(self) -> DataFrame:
        """(newspaper, yr, file, length, modified) of every file, from its status; no file is opened."""
        files = self.spark.read.format("binaryFile")
        name = F.substring_index("path", "/", -1)
        facts = [name.alias("file"), "length", F.col("modificationTime").alias("modified")]
        if self.layout == "shard_files":
            found = files.option("recursiveFileLookup", "true").load(self.path).filter(name.rlike(_SHARD_FILE_RE))
            return found.select(*_shard_of_file(name), *facts)
        typed = files.schema(f"path string, modificationTime timestamp, length bigint, content binary, {NEWSPAPER} string, {YEAR} string")
        return typed.load(self.path).select(NEWSPAPER, YEAR, *facts)

    def fingerprints(self) -> DataFrame:
        """(newspaper, yr, fingerprint): names, sizes and times of a shard's files."""
        file = F.concat_ws(":", "file", F.col("length").cast("string"), F.unix_micros("modified").cast("string"))
        return self.files().groupBy(NEWSPAPER, YEAR).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(file)), "|"), 256).alias("fingerprint"))

    def _partition_lines(self, shards: DataFrame | None) -> DataFrame:
        raw = self.spark.read.schema(f"value string, {NEWSPAPER} string, {YEAR} string").text(self.path)
        raw = raw.select("value", NEWSPAPER, YEAR, *_file_columns())
        if shards is None:
            return raw
        # on the raw scan, before the parse: Spark turns the join into a dynamic filter on the partition
        # columns (which it does for a side with a condition of its own).  At most the archive's own folders are
        # broadcast, and the order of lines survives the join.
        held = stage(shards.join(self.shards(), [NEWSPAPER, YEAR], "left_semi").select(NEWSPAPER, YEAR), "archive_shards")
        return raw.join(F.broadcast(held.filter(F.length(NEWSPAPER) + F.length(YEAR) > 0)), [NEWSPAPER, YEAR], "left_semi")

    def _shard_file_lines(self, shards: DataFrame | None) -> DataFrame:
        raw = self.spark.read.format("text").option("recursiveFileLookup", "true").load(self.path)
        name = F.col("_metadata.file_name")
        raw = raw.filter(name.rlike(_SHARD_FILE_RE))
        if shards is not None:
            # names of files that exist, no more than the scan's own listing holds: a filter on them is applied to that listing
            held = self.shards().join(shards, [NEWSPAPER, YEAR], "left_semi").select("file").distinct()
            raw = raw.filter(name.isin([r["file"] for r in held.collect()]))
        return raw.select("value", *_shard_of_file(name), *_file_columns())


_SHARD_FILE_RE = "^(.+)-([^-]+)\\.jsonl(\\.bz2|\\.gz)?$"


def _shard_of_file(name: Column) -> tuple[Column, Column]:
    return F.regexp_extract(name, _SHARD_FILE_RE, 1).alias(NEWSPAPER), F.regexp_extract(name, _SHARD_FILE_RE, 2).alias(YEAR)


def _file_columns() -> tuple[Column, Column]:
    return F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("_block")


def lookup(archive: Archive | DataFrame, ids: DataFrame, id_col: str = "_id", *, stage_keys: bool = True) -> DataFrame:
    """Archive rows for the wanted IDs, one per ID (the last in archive order wins).

    ``ids`` holds one ID column.  The distinct wanted keys are staged once
    (``stage_keys=False`` when ``ids`` already reads a staged table, so it is
    cheap to evaluate twice); for an :class:`Archive` their shards prune the scan
    by a join (dynamic partition pruning).  IDs that name no shard (no ``-``: SHA-1 of a record
    without an ID) are in no archive and are left out at once.  The archive is then semi-joined
    to the keys and only the matched rows are aggregated.
    """
    keys = ids.select(F.col(id_col).alias("a_id")).filter(F.contains(F.col("a_id"), F.lit("-"))).distinct()
    news, year = shard_of(F.col("a_id"))
    keys = keys.select(news.alias(NEWSPAPER), year.alias(YEAR), "a_id")
    if isinstance(archive, Archive):
        if stage_keys:
            keys = stage(keys, "archive_keys")
        archive = archive.read(keys.select(NEWSPAPER, YEAR).distinct())
    matched = archive.join(keys, [NEWSPAPER, YEAR, "a_id"], "left_semi")
    last = matched.groupBy("a_id").agg(
        F.max_by(F.struct("a_text", "a_len", "a_title"), F.col(SEQ)).alias("_r"),
        # a title replaces only when it is not blank: the last non-blank one
        F.max_by(F.col("a_title"), F.when(F.col("a_title") != "", F.col(SEQ))).alias("a_title_nb"),
    )
    # at most one row per wanted ID: staged, so callers can size-check it for
    # a broadcast join without reading the archive twice
    return stage(last.select(
        "a_id", F.col("_r.a_text").alias("a_text"), F.col("_r.a_len").alias("a_len"),
        F.col("_r.a_title").alias("a_title"), "a_title_nb",
    ), "archive_matches")


def write_archive(rows: DataFrame, path: str) -> None:
    """Write archive rows (``value`` line + shard columns) partitioned by shard."""
    (rows.select("value", NEWSPAPER, YEAR).sortWithinPartitions(NEWSPAPER, YEAR)
     .write.mode("overwrite").partitionBy(NEWSPAPER, YEAR).text(path))
