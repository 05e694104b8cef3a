"""Session construction and the shared scratch folder.

Jobs that cut lineage or stage data write under ``spark.checkpoint.dir``, the
folder the cluster shares between executors.  A default is set only when the
session has none (local runs and tests).
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Results depend on these: they are set whatever the session says.
REQUIRED = {
    # JSON objects with a repeated key: the last value wins, as in Python.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Set only where the session or its builder has no value of its own.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows per Arrow batch sent to Python (classifier, completer).  Whole
    # articles can be long; 512 keeps a batch to a few MB instead of GBs.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


def get_session(master: str | None = None, app: str = "corpusprep", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL settings the operators depend on (idempotent).

    A setting that the caller gave keeps its value; only ``REQUIRED`` ones are
    forced, and a session that refuses one of these raises.
    """
    given = {r["key"] for r in spark.sql("SET").collect()}
    for key, value in SESSION_DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    checkpoint_dir(spark)
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusprep`` importable in Python workers (UDFs unpickle against it).

    For local masters the package is zipped once per application and added
    with ``addPyFile``.  Cluster deployments ship it with ``--py-files`` (or
    install it on the executors); nothing is written to a node-local folder.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED or not sc.master.startswith("local"):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="corpusprep-pkg-")
    archive = shutil.make_archive(
        os.path.join(out, "corpusprep"), "zip", root_dir=os.path.dirname(pkg), base_dir=os.path.basename(pkg)
    )
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a temporary one only for a local master without one.

    On a cluster a folder of the driver's machine would be missing on the
    executors, so an unset ``spark.checkpoint.dir`` raises there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current and not re.match(r"local($|\[)", sc.master):
        raise ValueError(f"master {sc.master}: set spark.checkpoint.dir to a folder that all executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="corpusprep-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for staged tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "corpusprep", f"{name}-{uuid.uuid4().hex[:12]}")
