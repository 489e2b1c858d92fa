"""Ordered neighbours within a key (previous, next, first row) that survive a hot key.

A plain window puts all rows of a key into one task. Here keys too large for one task
are cut into slices along the window order; each slice is windowed on its own, and the
values that cross a slice border come from the slices' first and last rows, a few rows
per slice. Cut points only steer the layout: any cut gives the same result, and every
row is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from abono.operators.shared import materialize


@dataclass(frozen=True)
class HotLimits:
    """A key is hot with more rows than group_rows, which a task sorts comfortably."""

    group_rows: int = 5_000_000


DEFAULT_LIMITS = HotLimits()
SAMPLES_PER_SLICE = 200
CHUNK = 64


def hot_keys(df: DataFrame, key: str, limits: HotLimits = DEFAULT_LIMITS) -> DataFrame:
    """(_key, _rows, _slices) of the hot keys, as a table: there may be many. One count per
    key, combined in the map tasks."""
    counted = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))
    slices = F.floor(F.col("_rows") / limits.group_rows) + 1
    return materialize(
        counted.filter(F.col("_rows") > limits.group_rows).withColumn("_slices", slices), "hot")


def _position(order: list[str]) -> Column:
    """Sortable struct equal to ascending order with nulls last."""
    parts = []
    for i, name in enumerate(order):
        parts += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*parts)


def _slice_cuts(df: DataFrame, key: str, order: list[str], hot: DataFrame) -> DataFrame:
    """(_key, _heads, _chunks): cut positions of each hot key, about a task's rows apart,
    sorted and grouped in chunks so that a row looks at few of them."""
    total = hot.agg(F.sum("_rows").alias("rows"), F.sum("_slices").alias("slices")).first()
    share = min(1.0, SAMPLES_PER_SLICE * total["slices"] / total["rows"])
    whole = Window.partitionBy("_key")
    sampled = (
        df.select(F.col(key).alias("_k"), _position(order).alias("_pos"))
        .sample(share, seed=11)
        .join(hot, F.col("_k").eqNullSafe(F.col("_key")))
        .withColumn("_rn", F.row_number().over(whole.orderBy("_pos")))
        .withColumn("_n", F.count("*").over(whole))
        .withColumn("_tile", F.floor((F.col("_rn") - 1) * F.col("_slices") / F.col("_n")))
    )
    cuts = (
        sampled.filter("_tile > 0")
        .groupBy("_key", "_tile").agg(F.min("_pos").alias("_cut"))
        .groupBy("_key").agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))
        .select("_key", F.transform(
            F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / CHUNK).cast("int")),
            lambda i: F.slice("_cuts", i * CHUNK + 1, F.lit(CHUNK))).alias("_chunks"))
        .select("_key", "_chunks", F.transform("_chunks", lambda c: c[0]).alias("_heads"))
    )
    # The sample must not be drawn twice with different outcomes.
    return materialize(cuts, "cuts")


def with_neighbours(
    df: DataFrame,
    key: str,
    order: list[str],
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    first: dict[str, str] | None = None,
    limits: HotLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add columns {out: source} holding the value of the previous, next or first row of
    the same key in ascending `order` (nulls last). `order` should end in a unique column."""
    lag, lead, first = lag or {}, lead or {}, first or {}
    hot = hot_keys(df, key, limits)
    sort = [F.col(c).asc_nulls_last() for c in order]
    if hot.isEmpty():
        w = Window.partitionBy(key).orderBy(*sort)
        return df.select(
            "*",
            *[F.lag(c).over(w).alias(out) for out, c in lag.items()],
            *[F.lead(c).over(w).alias(out) for out, c in lead.items()],
            *[F.first(c).over(w).alias(out) for out, c in first.items()],
        )

    cuts = _slice_cuts(df, key, order, hot)
    position = _position(order)
    chunk = F.size(F.filter("_heads", lambda c: c <= position))
    within = F.size(F.filter(F.get("_chunks", F.col("_chunk") - 1), lambda c: c <= position))
    # Spark broadcasts cuts and edges while they are small, and splits a hot key's rows
    # among tasks where they are not.
    sliced = (
        df.join(cuts, F.col(key).eqNullSafe(F.col("_key")), "left")
        .withColumn("_hot", F.col("_heads").isNotNull())
        .withColumn("_chunk", F.when(F.col("_hot"), chunk).otherwise(F.lit(0)))
        .withColumn("_slice", F.when(
            F.col("_chunk") > 0, (F.col("_chunk") - 1) * CHUNK + within).otherwise(F.lit(0)))
        .drop("_key", "_heads", "_chunks", "_chunk")
    )

    needed = sorted({*lag.values(), *lead.values(), *first.values()})
    row = F.struct(*[F.col(c) for c in needed])
    by_slice = Window.partitionBy("_ek").orderBy("_es")
    edges = (
        sliced.filter("_hot")
        .groupBy(F.col(key).alias("_ek"), F.col("_slice").alias("_es"))
        .agg(F.min_by(row, position).alias("_head"), F.max_by(row, position).alias("_tail"))
        .select(
            "_ek", "_es",
            F.lag("_tail").over(by_slice).alias("_before"),
            F.lead("_head").over(by_slice).alias("_after"),
            F.first("_head").over(by_slice).alias("_start"),
        )
    )

    w = Window.partitionBy(key, "_slice").orderBy(*sort)
    local = sliced.select(
        "*",
        F.lag(F.lit(True)).over(w).isNull().alias("_at_start"),
        F.lead(F.lit(True)).over(w).isNull().alias("_at_end"),
        *[F.lag(c).over(w).alias(f"_lag_{out}") for out, c in lag.items()],
        *[F.lead(c).over(w).alias(f"_lead_{out}") for out, c in lead.items()],
        *[F.first(c).over(w).alias(f"_first_{out}") for out, c in first.items()],
    )
    joined = local.join(
        edges,
        F.col("_hot") & F.col(key).eqNullSafe(F.col("_ek")) & (F.col("_slice") == F.col("_es")),
        "left")

    def pick(at_border: Column, edge: str, source: str, inside: str) -> Column:
        return F.when(at_border, F.col(edge)[source]).otherwise(F.col(inside))

    return joined.select(
        *df.columns,
        *[pick(F.col("_at_start"), "_before", c, f"_lag_{out}").alias(out)
          for out, c in lag.items()],
        *[pick(F.col("_at_end"), "_after", c, f"_lead_{out}").alias(out)
          for out, c in lead.items()],
        *[pick(F.col("_hot"), "_start", c, f"_first_{out}").alias(out)
          for out, c in first.items()],
    )
