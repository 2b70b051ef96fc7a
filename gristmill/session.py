"""Session defaults. Everything here is optional: each function works on any SparkSession it is given."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let a skewed join split its hot partition even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # Plans here are built from many small expressions; recording a call site for each costs more than the analysis.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # ISO-8859-15 is refused by the CSV reader without it.
    "spark.sql.legacy.javaCharsets": "true",
}


def build(app: str = "gristmill", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A new path in the folder named by ``spark.checkpoint.dir``, which all executors share. The session is not changed."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder.rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: a lost executor never restarts the loop that made it."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
