"""Bounded samples of labelled rows, and the parts of an id that may be learned from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abono.llm.text import about


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def labelled(labels: DataFrame, id_col: str, label_col: str, allowed: Column, n: int) -> DataFrame:
    """(id_col, __label) of about n labelled ids, 2 n at most, one row per id; ids or labels
    that are null are left out. Where an id has both labels, it counts as label 1."""
    rows = labels.where(F.col(label_col).isNotNull() & allowed).select(id_col, label_col)
    picked = about(rows, id_col, n)
    return picked.groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("__label"))
