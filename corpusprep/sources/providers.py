"""Provider reference data: ``{provider: {country, titles: [newspaper, ...]}}``.

Flattened to ``newspaper -> country``: providers that are not objects and
``titles`` that are not lists are skipped, blank titles dropped, and when a
newspaper is listed more than once the last listing (provider order, then
title order) wins.  Newspapers listed with different countries are reported.

The file is one JSON document: reference data, read whole by one task.  A file
that is not exactly one JSON object raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.coerce import py_strip


def parse_providers(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """``(newspaper, country, provider_pos, title_pos)`` for every usable listing."""
    # one value and nothing behind it; the map keeps the order of the providers
    wrapped = F.try_parse_json(F.concat(F.lit("["), py_strip(F.col(text_col)), F.lit("]")))
    good = (F.try_variant_get(wrapped, "$[1]", "variant").isNull()
            & F.coalesce(F.schema_of_variant(F.try_variant_get(wrapped, "$[0]", "variant")).startswith("OBJECT"), F.lit(False)))
    m = F.when(good, F.from_json(F.col(text_col), "map<string,variant>")).otherwise(
        F.raise_error(F.lit("the provider file is not one JSON object")))
    providers = docs.select(F.posexplode(m).alias("p_pos", "provider", "payload"))
    is_obj = F.schema_of_variant(F.col("payload")).startswith("OBJECT")
    providers = providers.filter(is_obj).select(
        "p_pos",
        "provider",
        F.coalesce(py_strip(F.try_variant_get("payload", "$.country", "string")), F.lit("")).alias("country"),
        F.try_variant_get("payload", "$.titles", "array<variant>").alias("titles"),
    )
    listed = providers.filter(F.col("titles").isNotNull()).select(
        "p_pos", "provider", "country", F.posexplode("titles").alias("t_pos", "title")
    )
    newspaper = F.coalesce(py_strip(F.try_variant_get("title", "$", "string")), F.lit(""))
    return listed.select(newspaper.alias("newspaper"), "country", "provider", "p_pos", "t_pos").filter(
        F.col("newspaper") != ""
    )


def newspaper_country(listings: DataFrame) -> DataFrame:
    """One row per newspaper: the country of its last listing."""
    return listings.groupBy("newspaper").agg(
        F.max_by("country", F.struct("p_pos", "t_pos")).alias("country")
    )


def conflicts(listings: DataFrame) -> DataFrame:
    """Newspapers listed with more than one country."""
    return (
        listings.groupBy("newspaper")
        .agg(F.count_distinct("country").alias("n_countries"))
        .filter(F.col("n_countries") > 1)
    )


def read_providers(spark: SparkSession, path: str) -> DataFrame:
    """Parse the provider file(s)."""
    return parse_providers(spark.read.option("wholetext", "true").text(path))
