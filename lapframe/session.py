"""Session settings and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings the operators rely on at scale. None of them changes results.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no Python call site per column expression: halves the time to build a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "lapframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Pin the session time zone; every time function here counts in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session. A local folder is made only when it is
    unset and the master is local, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = os.path.join(tempfile.gettempdir(), "lapframe-scratch")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop_path(spark, path)
    return fs.exists(hpath)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop_path(spark, path)
    return fs.delete(hpath, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, hpath = _hadoop_path(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(hpath)] if fs.exists(hpath) else []


def naive_timestamps(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP column to TIMESTAMP_NTZ, for consumers that expect naive UTC times."""
    casts = {
        f.name: F.col(f.name).cast(T.TimestampNTZType())
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    }
    return df.withColumns(casts) if casts else df


def zoned_timestamps(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP_NTZ column to TIMESTAMP: epoch functions and watermarks need it."""
    casts = {
        f.name: F.col(f.name).cast(T.TimestampType())
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return df.withColumns(casts) if casts else df
