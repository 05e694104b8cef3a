"""Small tables with the awkward cases, as fixtures for the operator tests (imported, so that no second conftest exists)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Null columns, empty and blank texts, a very long text, ties, repeated rows, clashing extra columns."""
    prose = "the quick brown fox jumps over the lazy dog and runs far away from here to the old river bank again"
    rows = [
        (1, prose, "en", "a", 1), (2, prose, "en", "a", 1), (2, prose, "en", "a", 1), (3, None, None, None, None),
        (4, "", "en", None, 0), (5, " \n\t\r ", "de", "b", 3), (None, prose + " x", "en", "b", 1), (None, None, None, None, None),
        (6, "word " * 30000, "en", "a", 1), (7, "wörter über straße\n" * 40, "de", "b", 1), (8, "日本語 テスト 文字", "ja", "c", 1),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    for clash in ("id", "size", "rank", "copies", "row", "cid", "region", "u", "p", "line", "pos", "words", "score", "kept", "removed", "first", "key"):
        df = df.withColumn(clash, F.lit("clash"))
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
