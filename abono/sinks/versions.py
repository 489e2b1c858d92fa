"""Loads into plain Parquet folders that readers can use at any time.

A table is a folder of numbered subfolders: v00000007 holds a whole version, a00000008
rows appended to it, u00000009 the buckets that an upsert touched, and m00000009 the manifest of
that upsert, which says where every bucket is. A subfolder counts once it holds Spark's _SUCCESS
marker, which the job commit writes last, so a load that fails or loses executors leaves the
table as it was. The table reads as its highest version or manifest and what was appended after
it; no path is overwritten while being read. A table has one writer at a time: two loads at once
may pick the same number, and the later one fails.

An upsert reads and rewrites only buckets that hold keys of its batch. Rows that are not in
buckets yet, because a replace or an append wrote them, move there with the next upsert.

Snapshots have open versions in buckets and closed ones beside them: a run reads the open ones,
writes the buckets with a change anew, and what it closed; no other file is touched.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from abono.operators.history import changed_versions, new_versions, open_versions
from abono.operators.merge import above, merge_into_table, merge_upsert, one_per_key, watermark
from abono.operators.shared import materialize
from abono.sinks import buckets as b
from abono.sinks.buckets import BUCKETS, Manifest
from abono.sinks.facts import Facts, read_facts, together, write_observed

RUN, OPEN = "run", "abierta"


def _folders(spark: SparkSession, path: str) -> list[tuple[int, str, bool]]:
    """(number, folder, complete), by number."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [re.fullmatch(r"(?:v|a|u|m|run=)(\d{8,})", s.getPath().getName())
             for s in fs.listStatus(root)]
    return sorted((int(n[1]), f"{path}/{n[0]}", fs.exists(hadoop(f"{path}/{n[0]}/_SUCCESS")))
                  for n in names if n)


def _kind(folder: str) -> str:
    return folder.rsplit("/", 1)[1][0]


def _next_number(spark: SparkSession, path: str) -> int:
    """Numbers of failed loads are not used again."""
    return max([n for n, _, _ in _folders(spark, path)], default=0) + 1


def _next(spark: SparkSession, path: str, kind: str) -> str:
    """A folder that never existed."""
    return f"{path}/{kind}{_next_number(spark, path):08d}"


def _state(spark: SparkSession, path: str) -> tuple[int | None, Manifest | None, list[str]]:
    """(number, manifest, loose): the current version or manifest, and the complete folders of
    rows that are in no bucket."""
    done = [(n, folder) for n, folder, complete in _folders(spark, path) if complete]
    bases = [(n, folder) for n, folder in done if _kind(folder) in "vm"]
    if not bases:
        return None, None, []
    number, base = max(bases)
    loose = [folder for n, folder in done if n > number and _kind(folder) == "a"]
    if _kind(base) == "v":
        return number, None, [base, *loose]
    return number, b.read_manifest(spark, path, base.rsplit("/", 1)[1]), loose


def current_version(spark: SparkSession, path: str) -> int | None:
    return _state(spark, path)[0]


def _read(spark: SparkSession, path: str, manifest: Manifest | None, loose: list[str]) -> DataFrame:
    if manifest is None:
        return spark.read.parquet(*loose)
    rows = b.read_folders(spark, path, sorted(manifest.folders.values()), manifest.schema)
    return rows.unionByName(spark.read.schema(manifest.schema).parquet(*loose)) if loose else rows


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as it stands, or None when it was never loaded."""
    number, manifest, loose = _state(spark, path)
    return None if number is None else _read(spark, path, manifest, loose)


def _write(df: DataFrame, folder: str, cursor: str | None) -> None:
    write_observed(df, folder, cursor, lambda rows: rows.write.mode("errorifexists").parquet(folder))


def load_replace(df: DataFrame, path: str, cursor: str | None = None) -> DataFrame:
    """Full replace; returns the table."""
    spark = df.sparkSession
    _write(df, _next(spark, path, "v"), cursor)
    return read_current(spark, path)


def load_append(df: DataFrame, path: str, cursor: str | None = None) -> DataFrame:
    spark = df.sparkSession
    if current_version(spark, path) is None:
        return load_replace(df, path, cursor)
    _write(df, _next(spark, path, "a"), cursor)
    return read_current(spark, path)


def loaded_facts(spark: SparkSession, path: str, cursor: str) -> Facts | None:
    """Row count and newest cursor of the table as it stands, from what its loads observed: no row
    is read. None if some part of it was written without that."""
    number, manifest, loose = _state(spark, path)
    if number is None:
        return None
    parts = [read_facts(spark, folder).get("") for folder in loose]
    if manifest is not None:
        at = [place.rsplit("/", 1) for place in manifest.folders.values()]
        held = {folder: read_facts(spark, f"{path}/{folder}") for folder in {folder for folder, _ in at}}
        parts += [held[folder].get(bucket.split("=")[1]) for folder, bucket in at]
    return together(parts, cursor)


def _write_buckets(rows: DataFrame, path: str, kept: dict[int, str], keys: list[str], buckets: int,
                   cursor: str | None = None) -> DataFrame:
    """Write rows as buckets, and a manifest of them and the kept ones; returns the table."""
    spark = rows.sparkSession
    number = _next_number(spark, path)
    folder = f"u{number:08d}"
    b.write_buckets(rows, f"{path}/{folder}", keys, buckets, cursor, set(range(buckets)) - set(kept))
    found = kept | b.list_buckets(spark, path, folder)
    b.write_manifest(spark, path, f"m{number:08d}", Manifest(keys, buckets, rows.schema, found))
    return read_current(spark, path)


def load_buckets(df: DataFrame, path: str, keys, cursor: str | None = None, buckets: int | None = None) -> DataFrame:
    """Full replace by rows in buckets of their key, one per key: what an upsert can follow
    without moving anything."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _write_buckets(one_per_key(df, keys, cursor), path, {}, keys, buckets or BUCKETS, cursor)


def load_upsert(updates: DataFrame, path: str, keys, cursor: str | None = None,
                buckets: int | None = None) -> DataFrame:
    """One row per key, whatever the batch repeats: the newest by the cursor, and of equally
    new ones the greatest by its other columns. Only buckets with keys of the batch, and rows
    that are in no bucket, are read and written. `buckets` is for the first load; another number
    later, or other keys, lays the whole table out anew."""
    spark = updates.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    number, manifest, loose = _state(spark, path)
    if number is None:
        return load_buckets(updates, path, keys, cursor, buckets)
    schema = _read(spark, path, manifest, loose).schema
    if manifest is not None and not manifest.same_layout(keys, buckets):
        loose = [*loose, *[f"{path}/{f}" for f in manifest.folders.values()]]
        manifest = None
    total = manifest.buckets if manifest else buckets or BUCKETS
    batch = materialize(one_per_key(updates, keys, cursor), "batch")
    hit = b.touched(batch, keys, total)
    # Appended rows move to their buckets now; a replaced table's rows lie in all of them.
    extra = spark.read.schema(schema).parquet(*loose) if loose else None
    if extra is not None and manifest is not None:
        hit |= b.touched(extra, keys, total)
    if manifest is not None and not hit:
        return _read(spark, path, manifest, loose)
    held = manifest.folders if manifest else {}
    old = b.read_folders(spark, path, [f for k, f in sorted(held.items()) if k in hit], schema)
    if extra is not None:
        old = old.unionByName(extra)
    kept = {k: f for k, f in held.items() if k not in hit}
    return _write_buckets(merge_upsert(old, batch, keys, cursor), path, kept, keys, total, cursor)


def load_incremental(source: DataFrame, path: str, keys, cursor: str,
                     inclusive: bool = False, buckets: int | None = None) -> DataFrame:
    """Rows newer than the target's highest cursor, merged by key."""
    spark = source.sparkSession
    mark = watermark(read_current(spark, path), cursor)
    fresh = source if mark is None else above(source, cursor, mark, inclusive)
    return load_upsert(fresh, path, keys, cursor, buckets)


def load_table(source: DataFrame, path: str, key: str, incremental: bool,
               full_refresh: bool = False, cursor: str = "updated_at", buckets: int | None = None) -> DataFrame:
    """Replace when asked to or when the table has no cursor, else merge. A table that is merged
    later is replaced in buckets, one row per key."""
    if not incremental:
        return load_replace(source, path, cursor)
    if full_refresh:
        return load_buckets(source, path, key, cursor, buckets)
    return load_incremental(source, path, key, cursor, buckets=buckets)


def load_catalog_table(source: DataFrame, table: str, key: str, incremental: bool,
                       full_refresh: bool = False, cursor: str = "updated_at") -> DataFrame:
    """load_table for a table of a catalog with row-level writes, where MERGE INTO is the upsert.
    The first load creates the table."""
    spark = source.sparkSession
    exists = spark.catalog.tableExists(table)
    if full_refresh or not incremental or not exists:
        rows = one_per_key(source, key, cursor) if incremental else source
        rows.writeTo(table).createOrReplace()
        return spark.table(table)
    mark = watermark(spark.table(table), cursor)
    merge_into_table(source if mark is None else above(source, cursor, mark), table, key, cursor)
    return spark.table(table)


def _snapshot(spark: SparkSession, path: str) -> Manifest | None:
    done = [folder for _, folder, complete in _folders(spark, path) if complete and _kind(folder) == "m"]
    return b.read_manifest(spark, path, done[-1].rsplit("/", 1)[1]) if done else None


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """Open versions as the last run left them, and those that any run closed."""
    now = _snapshot(spark, path)
    if now is None:
        return None
    opened = b.read_folders(spark, path, sorted(now.folders.values()), schema)
    return opened.unionByName(b.read_folders(spark, path, now.others, schema))


def load_snapshot(source: DataFrame, path: str, key: str, updated_at: str, run_ts,
                  hard_deletes: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """One snapshot run over `source`. It compares open versions with the source, and writes what
    it closes and the buckets in which something opens or closes; other buckets and closed history
    keep their files. The manifest comes last, so all of it counts or nothing does."""
    spark = source.sparkSession
    fresh = new_versions(source, key, updated_at)
    schema, now = fresh.schema, _snapshot(spark, path)
    number = _next_number(spark, path)
    run = f"{RUN}={number:08d}"
    if now is None:
        b.write_buckets(fresh, f"{path}/{run}/{OPEN}=1", [key], buckets)
        found = b.list_buckets(spark, path, f"{run}/{OPEN}=1")
        b.write_manifest(spark, path, f"m{number:08d}", Manifest([key], buckets, schema, found))
        return read_snapshot(spark, path, schema)
    opened = b.read_folders(spark, path, sorted(now.folders.values()), schema)
    changed = materialize(changed_versions(opened, source, key, updated_at, run_ts, hard_deletes), "changes")
    hit = b.touched(changed, [key], now.buckets)
    if not hit:
        return read_snapshot(spark, path, schema)
    closed = changed.filter(~open_versions())
    others = now.others
    if not closed.isEmpty():
        closed.write.mode("errorifexists").parquet(f"{path}/{run}/{OPEN}=0")
        others = [*others, f"{run}/{OPEN}=0"]
    before = b.read_folders(spark, path, [f for k, f in sorted(now.folders.items()) if k in hit], schema)
    # A key that changed has one open version at most from now on: the new one.
    after = before.join(changed.select(key).distinct(), key, "left_anti").select(*schema.names)
    after = after.unionByName(changed.filter(open_versions()))
    b.write_buckets(after, f"{path}/{run}/{OPEN}=1", [key], now.buckets)
    found = {k: f for k, f in now.folders.items() if k not in hit} | b.list_buckets(spark, path, f"{run}/{OPEN}=1")
    b.write_manifest(spark, path, f"m{number:08d}", Manifest([key], now.buckets, schema, found, others))
    return read_snapshot(spark, path, schema)


FACT_DATE = "id_dim_fecha_rfm"


def _fact_dates(spark: SparkSession, path: str) -> list[str]:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(f"{path}/{n}" for n in names if n.startswith(f"{FACT_DATE}="))


def fact_dates(spark: SparkSession, path: str) -> list[str]:
    """Dates that have scores; one whose first load failed has none."""
    return [d.rsplit("=", 1)[1] for d in _fact_dates(spark, path) if current_version(spark, d) is not None]


def read_fact_rfm(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The current state of every date."""
    folders = []
    for date in _fact_dates(spark, path):
        _, manifest, loose = _state(spark, date)
        folders += [*loose, *[f"{date}/{f}" for f in (manifest.folders.values() if manifest else [])]]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def read_fact_date(spark: SparkSession, path: str, date) -> DataFrame | None:
    """The scores of one date, no other date's files being read; None if there are none."""
    found = read_current(spark, f"{path}/{FACT_DATE}={date}")
    return None if found is None else found.withColumn(FACT_DATE, F.lit(str(date)).cast("date"))


def write_fact_rfm(df: DataFrame, path: str) -> DataFrame:
    """Upsert on (date, account). Each date is a table of its own, whose loads never
    overwrite what is being read; only the dates at hand are read and written. Accounts
    scored earlier for the same date and missing now stay. A scoring run has one date; rows
    need one."""
    spark = df.sparkSession
    rows = materialize(df, "fact")
    for (date,) in rows.select(FACT_DATE).distinct().collect():
        if date is None:
            raise ValueError(f"{FACT_DATE} is null")
        load_upsert(rows.filter(F.col(FACT_DATE) == F.lit(date)), f"{path}/{FACT_DATE}={date}",
                    [FACT_DATE, "id_dim_cuenta"])
    return read_fact_rfm(spark, path, df.schema)


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Deletes what the current version or manifest of a table does not refer to: older folders,
    and buckets of newer ones that were written again. Returns the number of folders deleted. To
    be called when no reader needs them any more; nothing calls it by itself."""
    number, manifest, loose = _state(spark, path)
    if number is None:
        return 0
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    kept = set(loose) | {f"{path}/m{number:08d}"} | {f"{path}/{f}" for f in manifest.folders.values()} if manifest else set(loose)
    gone = 0
    for n, folder, _ in _folders(spark, path):
        if n > number or folder in kept:
            continue
        parts = [f for f in kept if f.startswith(f"{folder}/")]
        inner = [f"{path}/{f}" for f in b.list_buckets(spark, path, folder.rsplit("/", 1)[1]).values()] if parts else [folder]
        for old in inner:
            if old not in kept:
                place = hadoop(old)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
                gone += 1
    return gone
