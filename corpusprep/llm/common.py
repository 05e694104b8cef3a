"""Helpers shared by the operators: staged tables, words, narrow inputs."""

from __future__ import annotations

import os
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: A word: a run of code points other than space and \t \n \v \f \r.
WORD = "[^\\x20\\x09-\\x0D]+"


#: Spark removes the shuffle files of a query when it has ended, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> None:
    """Write a table that is read again; nothing else reads the shuffle files of the write, so they go with its end."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage so that lost executors never recompute earlier work, fixes
    non-deterministic columns (row ids, partition ids) once and for all, and
    gives the planner real sizes, so that it picks broadcasts by bytes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _note(path)
    _write(df, path)
    return spark.read.schema(df.schema).parquet(path)


_scopes = threading.local()


def _note(path: str) -> None:
    """The innermost ``stage_alone`` under way deletes ``path`` at its end."""
    if getattr(_scopes, "open", None):
        _scopes.open[-1].append(path)


def stage_alone(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``stage`` of what ``build`` returns; all tables that ``build`` staged on the way are deleted when it is written.

    They are deleted, too, where ``build`` or the write fails.
    """
    path = scratch_path(spark, name)
    _scopes.open = [*getattr(_scopes, "open", []), []]
    try:
        df = build()
        _write(df, path)
    finally:
        for made in _scopes.open.pop():
            delete(spark, made)
    _note(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a staged table from the shared folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def unit(*cols: Column) -> Column:
    """A uniform number in (0, 1) from a hash of ``cols``: 52 bits, never 0 or 1."""
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 12)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def write_back(df: DataFrame, path: str) -> DataFrame:
    """``df`` as written to ``path`` and read again."""
    _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def places(rows: DataFrame, order: Sequence[str], path: str) -> DataFrame:
    """``rows`` with ``place`` (from 0, by ``order`` in each group ``g``) and ``total`` (the group's rows).

    Parts of a range partition are numbered on their own; what comes before a part in its group is a running sum over
    one row for each part and group.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("g", *order)]
    lined = write_back(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), path)
    part = F.shiftright("at", 33)
    parts = lined.groupBy(part.alias("part"), F.col("g").alias("part_g")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("part_g")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", "part_g", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("total"))
    met = lined.join(parts, (part == F.col("part")) & F.col("g").eqNullSafe(F.col("part_g")))
    return met.select(*rows.columns, (F.col("at") + F.col("shift")).alias("place"), "total")
