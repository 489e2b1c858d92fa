"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from abono.operators.shared import new_path


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of this session's intermediates that nobody else uses; drop_intermediates
    deletes it with all others."""
    return new_path(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written below the shared folder and read back: computed once, its lineage cut. A
    table of another run is never read."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
