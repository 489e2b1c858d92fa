"""Tables laid out by a hash bucket of their key, and the manifests that say where each is.

A load writes one folder with a subfolder per bucket that it touches, and then a manifest: for
every bucket of the table, the folder that holds it now. A manifest counts once it holds Spark's
_SUCCESS marker and is read as a whole, so a load is seen entirely or not at all, and buckets
that a load did not touch keep their files.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from abono.sinks.facts import write_observed

BUCKET = "cubeta"
#: Buckets of a table unless its first load names another number. A bucket should hold what a task
#: rewrites with ease, so a very large table needs thousands.
BUCKETS = 16
MANIFEST = "kind string, bucket int, folder string, note string"


@dataclass(frozen=True)
class Manifest:
    """folders: where each bucket is, below the table's path. others: further folders that the
    table consists of, all read whole."""

    keys: list[str]
    buckets: int
    schema: StructType
    folders: dict[int, str] = field(default_factory=dict)
    others: list[str] = field(default_factory=list)

    def same_layout(self, keys: list[str], buckets: int | None) -> bool:
        return self.keys == keys and buckets in (None, self.buckets)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, folder: str, keys: list[str], buckets: int, cursor: str | None = None,
                  hit: set[int] | None = None) -> None:
    """One subfolder per bucket that df has rows of. Rows go to the tasks by bucket, so that a
    bucket is one file. Where `hit`, the buckets that df may have rows of, is given, their facts are
    kept."""
    def write(rows: DataFrame) -> None:
        rows.write.mode("errorifexists").partitionBy(BUCKET).parquet(folder)

    dealt = df.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(BUCKET)
    if hit is None:
        write(dealt)
    else:
        write_observed(dealt, folder, cursor, write, BUCKET, hit)


def list_buckets(spark: SparkSession, path: str, folder: str) -> dict[int, str]:
    """The buckets that a load wrote, with their places below path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
    names = [s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    found = [n for n in names if n.startswith(f"{BUCKET}=")]
    return {int(n.split("=")[1]): f"{folder}/{n}" for n in found}


def write_manifest(spark: SparkSession, path: str, name: str, manifest: Manifest) -> None:
    head = json.dumps({"keys": manifest.keys, "buckets": manifest.buckets, "schema": manifest.schema.json()})
    rows = [("head", None, None, head)]
    rows += [("bucket", b, f, None) for b, f in sorted(manifest.folders.items())]
    rows += [("other", None, f, None) for f in manifest.others]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{path}/{name}")


def read_manifest(spark: SparkSession, path: str, name: str) -> Manifest:
    """A manifest has a row per bucket."""
    rows = spark.read.schema(MANIFEST).json(f"{path}/{name}").collect()
    head = json.loads(next(r.note for r in rows if r.kind == "head"))
    return Manifest(
        head["keys"], head["buckets"], StructType.fromJson(json.loads(head["schema"])),
        {r.bucket: r.folder for r in rows if r.kind == "bucket"}, sorted(r.folder for r in rows if r.kind == "other"))


def read_folders(spark: SparkSession, path: str, folders: list[str], schema: StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders])


def touched(df: DataFrame, keys: list[str], buckets: int) -> set[int]:
    """Buckets that df has rows of; as many as the table has, at most."""
    return {r[0] for r in df.select(bucket_of(keys, buckets)).distinct().collect()}
