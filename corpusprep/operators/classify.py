"""Batch text classification into ``ad`` / ``non-ad``.

A model is a zero-argument factory (shipped to the workers) of an object with
``predict(texts) -> labels``: one label string per text.  It runs in a scalar
iterator pandas UDF: Arrow ships only the text column, the model is built once
per Python worker, and a batch is an Arrow batch
(``spark.sql.execution.arrow.maxRecordsPerBatch``).  Trimming, lower-casing and
validation happen in Spark, and an unknown label fails the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corpusprep.fixed import AD, NON_AD
from corpusprep.functions.coerce import py_strip


@cache
def _loaded(factory: Callable[[], Any]) -> Any:
    return factory()


def classifier_udf(factory: Callable[[], Any]):
    """A pandas UDF ``text -> label as the model gives it``."""

    @pandas_udf("string")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _loaded(factory)
        for texts in batches:
            labels = pd.Series(list(model.predict(texts.fillna("").tolist())), dtype="object")
            if len(labels) != len(texts):
                raise ValueError(f"the model labelled {len(labels)} of {len(texts)} texts")
            yield labels

    return label


def checked_label(raw: Column, record_id: Column) -> Column:
    """The label stripped and lower-cased; anything but ``ad``/``non-ad`` raises."""
    label = F.lower(py_strip(raw))
    return F.when(label.isin(AD, NON_AD), label).otherwise(
        F.raise_error(F.concat(F.lit("unknown label of record "), F.coalesce(record_id, F.lit("?")),
                               F.lit(": "), F.coalesce(raw, F.lit("none"))))
    )


def classify(text: Column, record_id: Column, factory: Callable[[], Any]) -> Column:
    return checked_label(classifier_udf(factory)(text), record_id)
