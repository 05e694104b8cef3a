"""A folder of per-language JSONL files.

Two layouts are read: files named after their language (``de.jsonl``,
``de.jsonl.gz``; a ``keywords_`` prefix is dropped) and the split job's
``lang_bucket=<language>/part-*`` folders.  The summary file and
``keywords_*`` outputs are skipped.  File filters use ``_metadata``, which
Spark applies while listing, so skipped files are never opened.
"""

from __future__ import annotations

import logging
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.fixed import KEYWORDS_FILE_PREFIX, SPLIT_SUMMARY_NAME
from corpusprep.sources.jsonl import FILE, SEQ, line_seq, parse_lines

log = logging.getLogger(__name__)

LANG_FILE = "_lang_file"
#: One input file of the run: a file, or a language folder of a split output.
SOURCE = "_lang_source"
_JSONL_NAME = "(?i)\\.jsonl(\\.gz)?$"


def language_of(path: Column, name: Column) -> Column:
    """Partition folder value, else the file stem without ``keywords_``."""
    folder = F.regexp_extract(path, "/lang_bucket=([^/]+)/[^/]*$", 1)
    stem = F.regexp_replace(name, "(?i)(\\.jsonl\\.gz|\\.jsonl)$", "")
    stem = F.regexp_replace(stem, "^" + KEYWORDS_FILE_PREFIX, "")
    return F.when(folder != "", folder).otherwise(stem)


def scan_language_folder(
    spark: SparkSession, prefix: str, *, summary_name: str = SPLIT_SUMMARY_NAME, recursive: bool = True
) -> DataFrame:
    """Parsed lines of every language file under ``prefix`` with ``_lang_file`` and ``_lang_source``.

    ``recursive=False`` reads the files directly under ``prefix`` only.
    """
    reader = spark.read.format("text")
    raw = reader.option("recursiveFileLookup", "true").load(prefix) if recursive else reader.load(prefix.rstrip("/") + "/*.*")
    # file names only (the listing Spark already holds): fail when nothing is
    # usable, warn when the split summary is absent
    names = [f.rstrip("/") for f in raw.inputFiles()]

    def is_summary(f: str) -> bool:  # a file, or Spark's one-file folder of that name
        return os.path.basename(f) == summary_name or f"/{summary_name}/" in f

    usable = [
        f for f in names
        if (re.search(_JSONL_NAME, os.path.basename(f)) or re.search("/lang_bucket=[^/]+/[^/]*$", f))
        and not os.path.basename(f).startswith(KEYWORDS_FILE_PREFIX) and not is_summary(f)
    ]
    if not usable:
        raise ValueError(f"no input JSONL files under {prefix}")
    if not any(is_summary(f) for f in names):
        log.warning("no %s under %s", summary_name, prefix)
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    in_bucket = path.rlike("/lang_bucket=[^/]+/[^/]*$")
    summary = (name == summary_name) | path.contains(f"/{summary_name}/")
    keep = (name.rlike(_JSONL_NAME) | in_bucket) & ~name.startswith(KEYWORDS_FILE_PREFIX) & ~summary
    lines = raw.filter(keep).select(
        "value", line_seq().alias(SEQ), path.alias(FILE), language_of(path, name).alias(LANG_FILE),
        F.when(in_bucket, F.regexp_extract(path, "^(.*/lang_bucket=[^/]+)/[^/]*$", 1)).otherwise(path).alias(SOURCE),
    )
    return parse_lines(lines)
