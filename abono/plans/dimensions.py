"""The four dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abono import fixed
from abono.functions import as_date
from abono.operators.history import scd2_dimension
from abono.operators.rank import top_n_per_key


def dim_cuentas_base(snapshot: DataFrame) -> DataFrame:
    return scd2_dimension(snapshot, "id_cuenta", "id_dim_cuenta")


def dim_suscripciones(snapshot: DataFrame) -> DataFrame:
    return scd2_dimension(snapshot, "id_suscripcion", "id_dim_suscripcion")


def dim_contenidos(snapshot: DataFrame, type1_cols: list[str] | None = None) -> DataFrame:
    return scd2_dimension(snapshot, "id_contenido", "id_dim_contenido", type1_cols=type1_cols)


def newest_segments(scores: DataFrame) -> DataFrame:
    """The two most recent segments of each scored account version: s1 of date f1, s2 of date f2."""
    recent = top_n_per_key(
        scores.select("id_dim_cuenta", "segmento_rfm", "id_dim_fecha_rfm"),
        "id_dim_cuenta", [F.col("id_dim_fecha_rfm").desc_nulls_last()], n=2, rank="puesto")

    def ranked(column, n):
        return F.max(F.when(F.col("puesto") == n, F.col(column)))

    return recent.groupBy("id_dim_cuenta").agg(
        ranked("segmento_rfm", 1).alias("s1"), ranked("id_dim_fecha_rfm", 1).alias("f1"),
        ranked("segmento_rfm", 2).alias("s2"), ranked("id_dim_fecha_rfm", 2).alias("f2"))


def merged_segments(kept: DataFrame, scores: DataFrame) -> DataFrame:
    """newest_segments of all scores that `kept` was made of and of `scores`, for the account
    versions in `scores`. A date that both have counts as `scores` has it. Dates are not null."""
    def entries(side):
        both = F.array(*[F.struct(F.col(f"{side}.f{n}").alias("f"), F.col(f"{side}.s{n}").alias("s")) for n in (1, 2)])
        return F.filter(both, lambda e: e["f"].isNotNull())

    rows = newest_segments(scores).alias("new").join(kept.alias("old"), "id_dim_cuenta", "left")
    rows = rows.select("id_dim_cuenta", entries("new").alias("new"), entries("old").alias("old"))
    dates = F.transform("new", lambda e: e["f"])
    others = F.filter("old", lambda e: ~F.array_contains(dates, e["f"]))
    newest = rows.select("id_dim_cuenta", F.sort_array(F.concat("new", others), asc=False).alias("e"))
    return newest.select(
        "id_dim_cuenta", *[F.get("e", F.lit(n - 1))[c].alias(f"{c}{n}") for n in (1, 2) for c in ("s", "f")])


def with_segments(base: DataFrame, segments: DataFrame) -> DataFrame:
    """Account versions with their last and previous segment, side by side."""
    none, never = F.lit(fixed.NO_SEGMENT), as_date(fixed.NO_DATE)
    return base.join(segments, "id_dim_cuenta", "left").select(
        *base.columns,
        F.coalesce("s1", none).alias("segmento_rfm_ultimo"),
        F.coalesce("f1", never).alias("fecha_rfm_ultimo"),
        F.coalesce("s2", none).alias("segmento_rfm_anterior"),
        F.coalesce("f2", never).alias("fecha_rfm_anterior"),
    )


def dim_cuentas(base: DataFrame, fact_rfm: DataFrame) -> DataFrame:
    """Account versions with their last and previous segment, from one aggregate over all scores."""
    return with_segments(base, newest_segments(fact_rfm))
