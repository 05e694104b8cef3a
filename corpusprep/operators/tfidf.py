"""Keywords without a model: the top terms of each article by TF-IDF.

Terms are runs of letters and digits of any length, lower case.  Tokenise -> sort and count the terms inside
their row, staged once -> document frequency per term from the staged table -> score -> top ``k`` per article.
All native; no term crosses a shuffle to be counted in its article.  Frequencies of frequent terms are broadcast (at most
``FREQUENT`` terms, so most occurrences meet theirs where they are, and no hot term has a partition); the occurrences of the other
terms are joined by term.  An article's best terms are cut to ``k`` in each task before they are exchanged.  Every row is an
article of its own, whatever its ID.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.sources.staging import stage

TOKEN_RE = "[\\p{L}\\p{N}]+"
#: Scores are compared after rounding, so that equal ones tie whatever the order of operations.
SCORE_DIGITS = 9
#: Terms whose document frequency is broadcast, at most.
FREQUENT = 200_000


def tfidf_keywords(docs: DataFrame, id_col: str, text_col: str, k: int = 5, token_re: str = TOKEN_RE) -> DataFrame:
    """``(id, keywords)`` with up to ``k`` terms per row, best first (ties by term); a
    row without terms gets an empty list."""
    tokens = F.coalesce(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(token_re), 0), F.array().cast("array<string>"))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), F.sort_array(tokens).alias("tokens"))
    # row numbers are fixed by staging
    counted = stage(rows.select("_row", "_id", _counted("tokens").alias("terms")), "term_counts")
    n_docs = counted.count()
    df = stage(counted.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count("*").alias("df")), "term_df")
    frequent = df["df"] >= _bound(df)
    tf = counted.select("_row", F.inline("terms"))
    often = F.broadcast(df.filter(frequent))
    score = F.round(F.col("tf") * F.log(F.lit(float(n_docs + 1)) / (F.col("df") + 1)), SCORE_DIGITS)
    scored = tf.join(often, "term").unionByName(tf.join(often, "term", "left_anti").join(df.filter(~frequent), "term"))
    w = Window.partitionBy("_row").orderBy(F.col("score").desc(), F.col("term"))
    top = scored.select("_row", "term", score.alias("score")).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    best = top.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "term"))), lambda x: x["term"]).alias("keywords"))
    keywords = F.coalesce("keywords", F.array().cast("array<string>"))
    return counted.select("_row", F.col("_id").alias(id_col)).join(best, "_row", "left").select(id_col, keywords.alias("keywords"))


def _counted(tokens: str) -> Column:
    """array<struct<term, tf>> of the sorted terms of a row."""
    words = F.col(tokens)
    starts = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: (i == 1) | (F.get(words, i - 1) != F.get(words, i - 2)))
    ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.size(words) + 1))
    runs = F.transform(F.arrays_zip(starts.alias("first"), ends.alias("after")), lambda r: F.struct(
        F.get(words, r["first"] - 1).alias("term"), (r["after"] - r["first"]).cast("bigint").alias("tf")))
    return F.when(F.size(words) > 0, runs).otherwise(F.array().cast("array<struct<term:string,tf:bigint>>"))


def _bound(df: DataFrame) -> int:
    """The smallest power of two that at most ``FREQUENT`` terms reach as their document frequency."""
    counts = df.agg(*[F.count_if(F.col("df") >= 2 ** p).alias(str(p)) for p in range(63)]).first()
    return next((2 ** p for p in range(63) if counts[p] <= FREQUENT), 2 ** 62)
