"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Every timestamp in the model is UTC text or a UTC instant, so the session must agree.
_RUNTIME_CONF = {"spark.sql.session.timeZone": "UTC"}


def build_session(app: str = "cumulo", **conf: str) -> SparkSession:
    """A session for the jobs; master, memory and parallelism come from the deployment."""
    builder = SparkSession.builder.appName(app)
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name in storage that the driver and all executors share: the checkpoint
    folder, or else the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/cumulo/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, *partitions: str) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage for a result that several writes consume; unlike cached blocks the files
    survive the loss of executors, and they stay columnar.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
