"""Row counts and newest moments, observed while a table is written.

They are kept in a file beside the rows, `_facts`, which Spark's readers pass over and which goes
when its folder goes. A folder without one, because a load failed between the two or an earlier
version wrote it, has no facts; its rows are then read when somebody asks.

What is observed is what the writing tasks hand to the files: the observation is the last step
before the write, in the stage that Spark counts once per finished partition, so a task that ran
twice counts once."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from abono.functions.columns import as_ts

FACTS = "_facts"
#: Buckets of one write that are observed one by one; a write to more has no facts.
MOST = 256


@dataclass(frozen=True)
class Facts:
    """rows, and the newest moment of the cursor, as text; None where there is none."""

    rows: int
    newest: str | None
    cursor: str | None


def _pair(which: Column, newest: Column, name: str) -> list[Column]:
    return [F.count_if(which).alias(f"n{name}"), F.max(F.when(which, newest)).cast("string").alias(f"t{name}")]


def write_observed(df: DataFrame, folder: str, cursor: str | None, write: Callable[[DataFrame], None],
                   bucket: str | None = None, buckets: Iterable[int] = ()) -> None:
    """write(df), and the facts of what it wrote in folder: of all rows or, where `bucket` names a
    column, of each of `buckets`, which are all the values it has."""
    spark, known = df.sparkSession, sorted(buckets)
    if len(known) > MOST:
        write(df)
        return
    # a text or number is no moment; a load must not fail for one
    kind = dict(df.dtypes).get(cursor)
    cursor = cursor if kind in ("date", "timestamp", "timestamp_ntz") else None
    newest = as_ts(cursor) if cursor else F.lit(None).cast("timestamp_ntz")
    parts = {str(k): F.col(bucket) == k for k in known} if bucket else {"": F.lit(True)}
    seen = Observation()
    write(df.observe(seen, *[c for k, which in parts.items() for c in _pair(which, newest, k)]))
    # nothing is observed where the plan is found to have no rows
    got = seen.get
    facts = {k: asdict(Facts(got.get(f"n{k}") or 0, got.get(f"t{k}"), cursor)) for k in parts}
    fs, path = _place(spark, f"{folder}/{FACTS}")
    out = fs.create(path, True)
    try:
        out.write(bytearray(json.dumps(facts).encode()))
    finally:
        out.close()


def _place(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def read_facts(spark: SparkSession, folder: str) -> dict[str, Facts]:
    """Facts by bucket, or under "" for all rows; empty if there are none."""
    fs, path = _place(spark, f"{folder}/{FACTS}")
    if not fs.exists(path):
        return {}
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {k: Facts(**v) for k, v in json.loads(text).items()}


def together(parts: list[Facts | None], cursor: str) -> Facts | None:
    """Facts of a table from those of its parts, if all are known and have that cursor."""
    if not parts or any(p is None or p.cursor != cursor for p in parts):
        return None
    return Facts(sum(p.rows for p in parts), max((p.newest for p in parts if p.newest), default=None), cursor)
