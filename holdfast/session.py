"""Session settings and shared scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "holdfast", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Master, memory and ``spark.checkpoint.dir`` are left to the cluster; any
    setting can be overridden through ``conf`` (dots written as ``__``).
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Call-site capture costs driver round trips for every column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster an
    unset folder is an error, because a driver-local path is lost to executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="holdfast-"))
    return context.getCheckpointDir()


# Folder of the tables that materialise() writes, below the shared one.
SCRATCH = "tables"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all tables this application has materialised; DataFrames that read them can't be used any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/{SCRATCH}")
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage at a point that survives executor loss, and lets the steps
    that read the result more than once prune columns instead of recomputing it.
    """
    path = f"{shared_root(df.sparkSession)}/{SCRATCH}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
