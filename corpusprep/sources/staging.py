"""Staged tables in the shared checkpoint folder.

A job that needs one parsed input for two outputs (files and statistics)
writes the parsed columns once as Parquet and reads them back: JSON is parsed
once, the statistics pass reads two narrow columns, and lineage is cut so a
lost executor does not replay the whole scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table (``schema``: ``name type, ...``) that Spark's planner knows to be empty.

    ``createDataFrame([], schema)`` has no known size: the other side of a join with it is shuffled.
    """
    columns = [c.split(" ", 1) for c in schema.split(", ")]
    return spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(kind).alias(name) for name, kind in columns])
