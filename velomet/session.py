"""Session construction for jobs, tests and the benchmark."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job wants, whatever the cluster. Sizes that depend on the cluster
# (executors, memory, shuffle partitions) belong to the submitter.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM leaves methods over 8000 bytes uncompiled. Wide projections of text cells exceed
    # that as one generated method; under this limit Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python call site of every column expression costs seconds per wide plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "velomet", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the base settings; keyword dots are written as double underscores."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names.

    Where none is named, a folder beside the tables of the warehouse stands in, which executors share too.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for the tables of one run, in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"
