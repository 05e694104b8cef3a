"""A trainable ad model on Spark ML, fitted on labelled store rows.

Features: TF-IDF of the tokens plus two layout signals that separate
advertisements from articles in general -- log text length and the share of
digits.  A regularised logistic regression maps them to ``ad``/``non-ad``.
Fit and prediction are distributed; this is an alternative to the pluggable
per-worker classifier.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, IDF, IndexToString, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _with_signals(df: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.char_length(text)
    digits = F.char_length(F.regexp_replace(text, "[^0-9]", ""))
    return df.withColumn("text", text).withColumn("log_len", F.log1p(n.cast("double"))).withColumn(
        "digit_share", F.when(n > 0, digits / n).otherwise(F.lit(0.0))
    )


def fit(train: DataFrame, *, num_features: int = 1 << 16, max_iter: int = 50, reg: float = 0.01) -> PipelineModel:
    """``train`` has ``text`` and ``label`` (``ad``/``non-ad``) columns; the
    returned model maps ``text`` to ``ad_class``."""
    train = _with_signals(train)
    indexer = StringIndexer(inputCol="label", outputCol="label_idx", handleInvalid="skip").fit(train)
    features = Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="tokens", pattern="\\W+", toLowercase=True),
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features),
        IDF(inputCol="tf", outputCol="tfidf"),
        VectorAssembler(inputCols=["tfidf", "log_len", "digit_share"], outputCol="features"),
    ]).fit(train)
    lr = LogisticRegression(featuresCol="features", labelCol="label_idx", maxIter=max_iter, regParam=reg,
                            standardization=True).fit(features.transform(indexer.transform(train)))
    lr = _without_summary(lr, train.sparkSession)
    to_label = IndexToString(inputCol="prediction", outputCol="ad_class", labels=indexer.labels)
    # prediction needs no label column: feature stages, the classifier, the label names
    return PipelineModel(stages=[*features.stages, lr, to_label])


def _without_summary(model: LogisticRegressionModel, spark) -> LogisticRegressionModel:
    """The fitted model reloaded from the shared folder: a loaded model has no
    training summary, whose reference to the session would otherwise travel
    with every prediction task (and fails to serialise once the session has
    used an ``Observation``)."""
    from corpusprep.session import scratch_path

    path = scratch_path(spark, "ad_model")
    model.write().overwrite().save(path)
    return LogisticRegressionModel.load(path)


def predict(model: PipelineModel, records: DataFrame) -> DataFrame:
    return model.transform(_with_signals(records))
