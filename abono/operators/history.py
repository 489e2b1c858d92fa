"""Versioned history: snapshot merge, versions from a change log, dimensions, as-of joins."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import AtomicType

from abono import fixed
from abono.functions import as_date, last_day_before, moment
from abono.operators.rank import top_n_per_key
from abono.operators.skew import DEFAULT_LIMITS, HotLimits, with_neighbours

VERSION_COLUMNS = ["dbt_scd_id", "dbt_valid_from", "dbt_valid_to"]


def version_id(key: Column, updated_at: Column) -> Column:
    """md5 of key and epoch microseconds; independent of the session time zone."""
    micros = F.timestamp_diff("MICROSECOND", moment("1970-01-01 00:00:00"), updated_at)
    return F.md5(F.concat_ws("|", key.cast("string"), micros.cast("string")))


def new_versions(source: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Every source row as an open version: the first snapshot."""
    return source.select(
        "*",
        version_id(F.col(key), F.col(updated_at)).alias("dbt_scd_id"),
        F.col(updated_at).alias("dbt_valid_from"),
        F.lit(None).cast(source.schema[updated_at].dataType).alias("dbt_valid_to"),
    )


def open_versions() -> Column:
    return F.col("dbt_valid_to").isNull()


def snapshot_changes(
    opened: DataFrame | None,
    source: DataFrame,
    key: str,
    updated_at: str,
    run_ts,
    hard_deletes: bool = True,
) -> DataFrame:
    """Open versions after one run over `source` (one row per key), and those it closed.

    A newer source row closes the open version and opens the next; an unknown key opens
    one; a key gone from the source closes at run_ts. A key that comes back after that
    opens a version at its own updated_at. One full outer join decides all cases."""
    fresh = new_versions(source, key, updated_at)
    if opened is None:
        return fresh
    kept, added = _run_over(key, updated_at, run_ts, hard_deletes)
    return _met(opened, fresh, key).select(F.inline(F.array_compact(F.array(kept, added))))


def changed_versions(opened: DataFrame, source: DataFrame, key: str, updated_at: str, run_ts,
                     hard_deletes: bool = True) -> DataFrame:
    """The versions that a run closes, and those that it opens."""
    kept, added = _run_over(key, updated_at, run_ts, hard_deletes)
    closed = F.when(kept["dbt_valid_to"].isNotNull(), kept)
    fresh = new_versions(source, key, updated_at)
    return _met(opened, fresh, key).select(F.inline(F.array_compact(F.array(closed, added))))


def _met(opened: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Old and new version of each key. The keys stay beside the rows, so that inputs hashed on
    them are not shuffled again."""
    columns = fresh.columns
    return opened.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("old")).join(
        fresh.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("new")),
        F.col("_old_key") == F.col("_new_key"), "full_outer")


def _run_over(key: str, updated_at: str, run_ts, hard_deletes: bool) -> tuple[Column, Column]:
    """Of a pair of old and new: the old version as the run leaves it, and the one it opens."""
    newer = F.col(f"new.{updated_at}") > F.col("old.dbt_valid_from")
    gone = F.col("new").isNull()
    end = F.when(newer, F.col(f"new.{updated_at}"))
    if hard_deletes:
        end = end.when(gone, moment(run_ts))
    kept = F.when(F.col("old").isNotNull(), F.col("old").withField("dbt_valid_to", end))
    return kept, F.when(~gone & (F.col("old").isNull() | newer), F.col("new"))


def snapshot_merge(
    snapshot: DataFrame | None,
    source: DataFrame,
    key: str,
    updated_at: str,
    run_ts,
    hard_deletes: bool = True,
) -> DataFrame:
    """Whole snapshot after one run: the changes, and closed history as it was."""
    if snapshot is None:
        return new_versions(source, key, updated_at)
    changed = snapshot_changes(
        snapshot.filter(open_versions()), source, key, updated_at, run_ts, hard_deletes)
    return changed.unionByName(snapshot.filter(~open_versions()).select(*changed.columns))


def versions_from_history(
    log: DataFrame,
    key: str,
    updated_at: str,
    tiebreak: str,
    limits: HotLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """A full change log as versions, for backfills: each change is valid until the next.
    Of changes at the same instant only the last by `tiebreak` is a version."""
    following = with_neighbours(
        log.filter(F.col(updated_at).isNotNull()), key, [updated_at, tiebreak],
        lead={"_next": updated_at}, limits=limits)
    return following.filter(
        F.col("_next").isNull() | (F.col("_next") > F.col(updated_at))
    ).select(
        *log.columns,
        version_id(F.col(key), F.col(updated_at)).alias("dbt_scd_id"),
        F.col(updated_at).alias("dbt_valid_from"),
        F.col("_next").alias("dbt_valid_to"),
    )


def last_version_per_day(snapshot: DataFrame, key: str) -> DataFrame:
    """The version a key ended each day with. An open version wins a tie."""
    return top_n_per_key(
        snapshot.withColumn("_day", F.col("dbt_valid_from").cast("date")),
        [key, "_day"],
        [F.col("dbt_valid_from").desc_nulls_last(), F.col("dbt_valid_to").desc_nulls_first(),
         F.col("dbt_scd_id")],
    ).drop("_day")


def scd2_dimension(
    snapshot: DataFrame,
    key: str,
    surrogate: str,
    created: str = "fecha_creacion",
    type1_cols: list[str] | None = None,
) -> DataFrame:
    """Date-grained dimension. The first version starts on the creation date, later ones
    on the day they became valid; each ends the day before it was replaced. A version
    removed on the day it appeared ends before it starts and matches nothing.
    type1_cols show their latest value on all versions."""
    attributes = [c for c in snapshot.columns if c not in VERSION_COLUMNS]
    # After the per-day reduction a key has at most one row per day of history.
    by_key = Window.partitionBy(key).orderBy(
        F.col("dbt_valid_from").asc_nulls_last(), F.col("dbt_scd_id"))
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    latest = set(type1_cols or [])
    is_first = F.row_number().over(by_key) == 1
    return last_version_per_day(snapshot, key).select(
        F.col("dbt_scd_id").alias(surrogate),
        *[F.last(c).over(whole).alias(c) if c in latest else F.col(c) for c in attributes],
        F.when(is_first, F.col(created).cast("date"))
        .otherwise(F.col("dbt_valid_from").cast("date")).alias("valido_desde"),
        F.coalesce(last_day_before("dbt_valid_to"), as_date(fixed.FAR_DATE)).alias("valido_hasta"),
        F.col("dbt_valid_to").isNull().alias("es_actual"),
    )


def overlapping_versions(dim: DataFrame, key: str, start: str = "valido_desde",
                         end: str = "valido_hasta") -> DataFrame:
    """Versions of a key that reach into the key's next version."""
    valid = dim.filter(F.col(start) <= F.col(end))
    return with_neighbours(valid, key, [start, end], lead={"_next": start}).filter(
        F.col("_next") <= F.col(end)).drop("_next")


@dataclass(frozen=True)
class Slices:
    """How an as-of join on few key values is spread: time in so many stretches between the facts'
    first and last date, and each stretch's facts in so many shares. A version is repeated for
    every stretch that it is valid in and for every share, so this is for dimensions of few
    versions; a dimension with many keys is spread by its key."""

    stretches: int = 64
    shares: int = 4
    #: First and last date of the facts, where the caller knows them; else they are looked up.
    span: tuple[dt.date, dt.date] | None = None


def date_span(df: DataFrame, column: str) -> tuple[dt.date, dt.date]:
    """First and last date; of a table without dates any day, as none of its rows meets a version."""
    day = F.col(column).cast("date")
    found = df.agg(F.min(day).alias("low"), F.max(day).alias("high")).first()
    return (found["low"], found["high"]) if found["low"] else (dt.date(1970, 1, 1), dt.date(1970, 1, 1))


def asof_dim(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    on_date: str,
    surrogate: str,
    out: str | None = None,
    dim_key: str | None = None,
    on_overlap: str = "keep",
    slices: Slices | None = None,
) -> DataFrame:
    """Attach the surrogate of the version valid at each fact's date, null where none is.

    The key is an equi-join, so Spark hashes on it and checks the range afterwards;
    dimensions small enough are broadcast by Spark's own size check, and adaptive
    execution splits a hot key on the fact side. With `slices` the join is on key, stretch of
    time and share, so that few key values, or facts without a key, fill all tasks by
    themselves. Overlapping versions multiply facts unless on_overlap='error' refuses them."""
    dim_key = dim_key or key
    if on_overlap == "error" and not overlapping_versions(dim, dim_key).isEmpty():
        raise ValueError(f"versions of {dim_key} overlap")
    versions = dim.select(
        F.col(dim_key).alias("_k"), F.col("valido_desde").alias("_from"),
        F.col("valido_hasta").alias("_to"), F.col(surrogate).alias(out or surrogate))
    hit = (F.col(key) == F.col("_k")) & F.col(on_date).between(F.col("_from"), F.col("_to"))
    if slices:
        fact, versions = _sliced(fact, versions, on_date, slices)
        hit = hit & (F.col("_stretch") == F.col("_v_stretch")) & (F.col("_share") == F.col("_v_share"))
    return fact.join(versions, hit, "left").drop("_k", "_from", "_to", "_stretch", "_share", "_v_stretch", "_v_share")


def _sliced(fact: DataFrame, versions: DataFrame, on_date: str, slices: Slices) -> tuple[DataFrame, DataFrame]:
    """Facts with their stretch and share, and versions once for each of those they serve."""
    day = F.col(on_date).cast("date")
    low, high = slices.span or date_span(fact, on_date)
    width = (high - low).days // slices.stretches + 1
    last = (high - low).days // width

    def stretch(date: Column) -> Column:
        return F.floor(F.datediff(date, as_date(low)) / width).cast("int")

    simple = [f.name for f in fact.schema if isinstance(f.dataType, AtomicType)]
    spread = fact.select("*", stretch(day).alias("_stretch"), F.pmod(F.xxhash64(*simple), F.lit(slices.shares)).cast("int").alias("_share"))
    first, final = F.greatest(stretch(F.col("_from").cast("date")), F.lit(0)), F.least(stretch(F.col("_to").cast("date")), F.lit(last))
    served = versions.withColumn("_first", first).withColumn("_final", final).filter(F.col("_first") <= F.col("_final"))
    served = served.withColumn("_v_stretch", F.explode(F.sequence("_first", "_final")))
    served = served.withColumn("_v_share", F.explode(F.sequence(F.lit(0), F.lit(slices.shares - 1))))
    return spread, served.drop("_first", "_final")


def dim_at(dim: DataFrame, as_of) -> DataFrame:
    """Versions valid on one date."""
    return dim.filter(as_date(as_of).between(F.col("valido_desde"), F.col("valido_hasta")))
