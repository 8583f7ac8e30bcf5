"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# UTC keeps zone-less event times and epoch seconds in step.  Skew-join
# splitting is forced because every fact join here is many-to-one, so a split
# partition never changes the result.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tidemark", **extra: str) -> SparkSession:
    """Session with the settings above; a cluster's own master wins when none is given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dir()


def stage_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table that several later steps read, and read it back.

    Parquet rather than an RDD checkpoint: each reader then scans only its own
    columns, and a lost executor costs a re-read instead of a re-computation.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
