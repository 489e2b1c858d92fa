"""Upsert by key, high-watermark filter, newest row per key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from abono.operators.rank import newest_per_key


def one_per_key(updates: DataFrame, keys, cursor: str | None = None) -> DataFrame:
    """The newest row of each key by the cursor; ties, and all rows without a cursor, go by
    the greatest values of the other columns, in order."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in updates.columns if c not in keys and c != cursor]
    first, *rest = [cursor, *others] if cursor else others or keys
    return newest_per_key(updates, keys, first, rest)


def merge_upsert(target: DataFrame, updates: DataFrame, keys, cursor: str | None = None) -> DataFrame:
    """Rows of `updates` replace those of `target` with the same key; new keys are added,
    nothing is deleted. Several updates of a key count as one, see one_per_key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    updates = one_per_key(updates, keys, cursor).select(*target.columns)
    return target.join(updates.select(*keys), keys, "left_anti").unionByName(updates)


def merge_statement(table: str, updates: str, keys: list[str]) -> str:
    """The upsert as MERGE INTO, from a view of updates with one row per key."""
    on = " AND ".join(f"destino.`{k}` = cambios.`{k}`" for k in keys)
    return (f"MERGE INTO {table} AS destino USING `{updates}` AS cambios ON {on}"
            " WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")


def merge_into_table(updates: DataFrame, table: str, keys, cursor: str | None = None) -> None:
    """The same upsert as MERGE INTO, for catalogs with row-level writes: only files
    holding touched keys are rewritten."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    view = f"cambios_{uuid.uuid4().hex}"
    one_per_key(updates, keys, cursor).createOrReplaceTempView(view)
    try:
        updates.sparkSession.sql(merge_statement(table, view, keys))
    finally:
        updates.sparkSession.catalog.dropTempView(view)


def watermark(target: DataFrame | None, column: str) -> str | None:
    """Highest value in the target as text; None when there is no target or it is empty."""
    if target is None:
        return None
    return target.agg(F.max(column).cast("string").alias("top")).first()["top"]


def above(df: DataFrame, column: str, mark: str, inclusive: bool = False) -> DataFrame:
    """Rows past the mark, which is a literal, so the scan can skip row groups."""
    limit = F.lit(mark).cast(df.schema[column].dataType)
    return df.filter(F.col(column) >= limit if inclusive else F.col(column) > limit)


def since_watermark(
    df: DataFrame,
    target: DataFrame | None,
    column: str,
    target_column: str | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Rows whose cursor lies above the target's highest one. A missing or empty target
    loads everything.

    The strict default loses late rows that tie with the maximum and rows without a
    cursor; `inclusive` keeps the ties, which is safe before an upsert."""
    mark = watermark(target, target_column or column)
    return df if mark is None else above(df, column, mark, inclusive)
