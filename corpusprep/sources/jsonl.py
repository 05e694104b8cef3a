"""Line-delimited JSON: scan, strict parse, quarantine, write.

A scanned line keeps its raw text (``value``), its position (``_seq``) and a
parsed VARIANT (``_v``).  ``_status`` says why a line is not a record:

* ``blank``      -- empty after stripping; skipped and not counted
* ``bad_utf8``   -- bytes that are not UTF-8
* ``invalid``    -- not exactly one JSON value (trailing junk, two objects,
                    NaN, single quotes, ...)
* ``too_large``  -- a line that could not be parsed and is longer than the JSON
                    parser's limit for one string (20,000,000 characters)
* ``not_object`` -- valid JSON that is not an object (``[1,2]``, ``5``)
* ``ok``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.coerce import py_strip

LINE_STATUS_OK = "ok"
#: The JSON parser's longest string; Spark offers no setting for it.
MAX_STRING = 20_000_000
SEQ = "_seq"
VAR = "_v"
STATUS = "_status"
FILE = "_file"


def part_number(name: Column) -> Column:
    """The number of a ``part-<number>-...`` file, -1 for files that are not named so."""
    number = F.substring_index(F.substr(name, F.lit(6)), "-", 1).try_cast("bigint")
    return F.when(F.startswith(name, F.lit("part-")), F.coalesce(number, F.lit(-1))).otherwise(F.lit(-1))


def line_seq(folder: Column | None = None, path: Column | None = None, block: Column | None = None) -> Column:
    """Total order of scanned lines: folder, part number, file name, split start, position within the split.

    Part numbers compare by value (``part-100000`` follows ``part-99999``).  ``folder`` may be any column that orders the folders.
    ``path`` and ``block`` (file and split start) default to the scan's own.
    """
    path = F.col("_metadata.file_path") if path is None else path
    block = F.col("_metadata.file_block_start") if block is None else block
    name = F.substring_index(path, "/", -1)
    if folder is None:
        folder = F.substr(path, F.lit(1), F.length(path) - F.length(name))
    return F.struct(folder.alias("folder"), part_number(name).alias("part"), name.alias("file"), block.alias("block"),
                    F.monotonically_increasing_id().alias("pos"))


def read_jsonl(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    recursive: bool = False,
    glob: str | None = None,
    min_partitions: int | str | None = None,
    partition_filter: Column | str | None = None,
) -> DataFrame:
    """Scan JSONL (plain, .gz, .bz2; codec by extension) into parsed lines.

    Gzip files are not splittable, one task each; pass ``min_partitions`` to
    spread the parse over the cluster right after the scan, or ``"auto"`` to
    do so only when there are fewer gzip files than the default parallelism
    (file names from the listing decide; no data is read).
    ``partition_filter`` (on partition columns of a partitioned folder) is
    applied to the raw scan, before parsing, so Spark prunes folders; filters
    written after parsing stay above the parse and do not prune.
    """
    reader = spark.read.format("text")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.load(list(paths) if not isinstance(paths, str) else paths)
    if partition_filter is not None:
        raw = raw.filter(partition_filter)
    lines = raw.select(
        *raw.columns,
        line_seq().alias(SEQ),
        F.col("_metadata.file_path").alias(FILE),
    )
    if min_partitions == "auto":
        gz = [f for f in raw.inputFiles() if f.lower().endswith(".gz")]
        parallelism = spark.sparkContext.defaultParallelism
        min_partitions = parallelism if gz and len(gz) < parallelism else None
    if min_partitions:
        lines = lines.repartition(int(min_partitions))
    return parse_lines(lines)


def parse_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Add ``_v`` (VARIANT object or NULL) and ``_status`` to a frame of raw lines.

    A line is wrapped in brackets before parsing so that anything after the
    first value (``{..} x``, ``{..},{..}``) makes the line invalid.

    Parsing is the costliest step of every job, so it must run once per line.
    Catalyst would push later filters below this projection and re-evaluate
    the parse inside them; the projection therefore carries
    ``spark_partition_id()`` (non-deterministic), which keeps filters above it.
    """
    passthrough = [F.col(c) for c in lines.columns]
    staged = lines.select(*passthrough, py_strip(F.col(line_col)).alias("_line"))
    staged = staged.select(
        "*", F.try_parse_json(F.concat(F.lit("["), F.col("_line"), F.lit("]"))).alias("_wrapped")
    )
    line, wrapped = F.col("_line"), F.col("_wrapped")
    status = (
        F.when(line == "", F.lit("blank"))
        .when(~F.is_valid_utf8(F.col(line_col)), F.lit("bad_utf8"))
        .when(wrapped.isNull() & (F.char_length(line) > MAX_STRING), F.lit("too_large"))
        .when(wrapped.isNull() | F.variant_get(wrapped, "$[1]", "variant").isNotNull(), F.lit("invalid"))
        .when(~line.startswith("{"), F.lit("not_object"))
        .otherwise(F.lit(LINE_STATUS_OK))
    )
    barrier = F.spark_partition_id() >= 0
    return staged.select(
        *passthrough,
        status.alias(STATUS),
        F.when(barrier & (status == LINE_STATUS_OK), F.variant_get(wrapped, "$[0]", "variant")).alias(VAR),
    )


def valid_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(STATUS) == LINE_STATUS_OK)


def line_counts(parsed: DataFrame) -> DataFrame:
    """One row: non-blank lines, records, and each kind of rejected line."""
    s = F.col(STATUS)
    return parsed.agg(
        F.count_if(s != "blank").alias("total_lines"),
        F.count_if(s == LINE_STATUS_OK).alias("valid_records"),
        F.count_if(s == "invalid").alias("invalid_json_lines"),
        F.count_if(s == "not_object").alias("non_object_lines"),
        F.count_if(s == "bad_utf8").alias("bad_utf8_lines"),
        F.count_if(s == "too_large").alias("too_large_lines"),
    )


def write_jsonl(
    df: DataFrame,
    path: str,
    *,
    line_col: str = "value",
    compression: str | None = None,
    partition_by: Sequence[str] = (),
    order_by: str | None = None,
    mode: str = "overwrite",
) -> None:
    """Write one JSON line per row; codec ``gzip``/``bzip2``/None.

    By default rows are written as they are partitioned (no shuffle); each
    part file keeps its rows in scan order.  With ``order_by`` (e.g. ``_seq``)
    the global line order is kept: rows are range partitioned on it and
    sorted within each task, so part files read back in name order reproduce
    the input order.  That costs a sampling pass and a shuffle -- use it for
    outputs whose consumers take "the first N lines" (language files, exports).
    """
    cols = [line_col, *partition_by]
    out = df
    if order_by and order_by in df.columns:
        out = out.repartitionByRange(order_by).sortWithinPartitions(*partition_by, order_by)
    writer = out.select(*cols).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.text(path)
