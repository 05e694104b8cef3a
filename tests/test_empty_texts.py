"""Documents with an empty text: the quality of their records is 0 / 0, which no query may fail on."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from corpusprep.plans import views as V
from corpusprep.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [(1, "", "de", "src1", 0), (3, " .;", "en", "src1", 3), (6, "ab, c", "en", "src1", 5),
        (7, "", "fr", "src0", 0), (8, "", "de", "src1", 0), (10, "", "de", "src2", 0), (17, "", "lb", "src1", 0)]


@pytest.fixture(scope="module")
def tables(spark):
    path = scratch_path(spark, "empty_texts")
    spark.createDataFrame(ROWS, SCHEMA).coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, f"N{k}") for k in range(4)], "n_nationkey int, n_name string").coalesce(1).write.parquet(f"{path}/nation.parquet")
    return path


def _norm(rows):
    return sorted((tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in r) for r in rows), key=repr)


def test_quality_of_empty_text(spark):
    docs = spark.createDataFrame([*ROWS, (2, None, "fr", "src2", None)], SCHEMA)
    found = {r.doc_id: r.ocrqa for r in V.record_columns(docs).collect()}
    assert {k for k, q in found.items() if q is not None and math.isnan(q)} == {1, 7, 8, 10, 17}
    assert {k: q for k, q in found.items() if k in (2, 3, 6)} == {2: None, 3: 0.0, 6: 0.6}


@pytest.mark.parametrize("name", ["filter_records", "filter_ocrqa", "filter_counts", "jsonl_scan", "dedup_last", "record_length",
                                  "language_bucket", "split_summary", "newspaper_country", "classify_labels", "non_ad_counts"])
def test_queries_on_empty_texts(spark, tables, name):
    df = E.queries()[name](spark, tables)
    rows = df.collect()
    con = duckdb.connect()
    for t in ("documents", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet/*.parquet')")
    res = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert _norm([tuple(r[c] for c in columns) for r in rows]) == _norm(res.fetchall())
