"""Renaming projection and pivot of attribute rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def rename_project(df: DataFrame, mapping: dict[str, str],
                   casts: dict[str, str] | None = None) -> DataFrame:
    """Select {source: out} columns, cast where {out: type} says so."""
    casts = casts or {}
    return df.select(*[
        (F.col(src).cast(casts[out]) if out in casts else F.col(src)).alias(out)
        for src, out in mapping.items()])


def pivot_eav(
    df: DataFrame,
    key: str,
    attributes: dict[str, tuple[str, str]],
    name_column: str = "attribute_name",
    extra: list[Column] | None = None,
) -> DataFrame:
    """One row per key with {out: (attribute, value column)} as max over the attribute's
    rows; partial aggregation reduces each key before the shuffle."""
    return df.groupBy(key).agg(
        *[F.max(F.when(F.col(name_column) == attr, F.col(value))).alias(out)
          for out, (attr, value) in attributes.items()],
        *(extra or []),
    )
