"""Materialising intermediate results in the shared folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, one in the warehouse. A warehouse on
    the machine's own disk is shared by nobody, so on a cluster it is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    own_disk = warehouse.startswith(("file:", "/"))
    if own_disk and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("executors share no folder: set spark.checkpoint.dir, or a warehouse that all of them reach")
    return f"{warehouse}/intermediate"


def _session_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/abono-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A folder name in the shared folder that nobody else uses."""
    return f"{_session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_intermediates(spark: SparkSession) -> None:
    """Delete everything this session materialised. Call it when no DataFrame that rests
    on such results is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: later passes read columns from Parquet instead of
    recomputing, and the result no longer depends on lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
