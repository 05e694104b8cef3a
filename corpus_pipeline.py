"""The training-data pipeline: quality rules, line dedup, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``.  Between stages the result is written as Parquet to the shared folder and read again, so
a lost executor costs the tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import jaccard, linededup, mixing, packing, quality
from corpusprep.llm.common import WORD, read_table, stage
from corpusprep.session import apply_defaults


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are mostly content, as they were."""
    apply_defaults(spark)
    weights = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, weights)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier equal or similar line makes needless.

    A document that had words and loses them all is a copy of earlier ones and goes; one without words stays.
    ``n_chars``, where there is one, follows the text.
    """
    apply_defaults(spark)
    had = "had_" + "_".join(docs.columns)  # clashes with no column of docs
    some = lambda: F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    marked = docs.withColumn(had, F.struct(some().alias("words"), F.char_length("text").alias("size")))
    out = linededup.dedup_lines(marked, n=5, num=80, den=100).filter(~F.col(had)["words"] | some())
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed = F.char_length("text") != F.col(had)["size"]
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones (5-word shingles, Jaccard >= 0.8)."""
    apply_defaults(spark)
    return jaccard.keep_one(docs, n=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    apply_defaults(spark)
    mixed = mixing.mix(docs, weights=(3, 1, 2), share=1.5, max_copies=2, carry=docs.columns)
    copies = mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return copies.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences of 1024 tokens; a document that the mix took twice has the pieces of both copies."""
    apply_defaults(spark)
    return packing.pack(docs, max_tokens=1024, cut=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Viterbi decoding, components and the tokenizer are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None
