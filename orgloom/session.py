"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # plans with many expressions are built faster without a call site for each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str, cores: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    builder = builder.config("spark.driver.memory", "8g")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_roots: dict[str, str] = {}


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder that the cluster names.

    Only where the session names none, which a local test run may do, a temporary
    folder is made and kept for the whole application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="orgloom-")
        root = _local_roots[app]
    return os.path.join(root, "orgloom", f"{name}-{uuid.uuid4().hex[:12]}")
