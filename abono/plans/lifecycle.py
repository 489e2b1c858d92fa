"""Subscription lifecycle: plan changes, duration and churn per subscription period."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from abono import fixed
from abono.functions import as_date, days_between
from abono.operators.history import Slices, asof_dim, date_span
from abono.operators.skew import DEFAULT_LIMITS, HotLimits, with_neighbours


def ordered_periods(periods: DataFrame, limits: HotLimits = DEFAULT_LIMITS) -> DataFrame:
    """Each period next to the previous, next and first one of its account, by start and
    then period id."""
    return with_neighbours(
        periods, "id_cuenta", ["fecha_inicio", "id_suscripcion_cuenta"],
        lag={"id_suscripcion_anterior": "id_suscripcion", "fecha_inicio_anterior": "fecha_inicio"},
        lead={"id_suscripcion_siguiente": "id_suscripcion"},
        first={"fecha_primer_suscripcion": "fecha_inicio"},
        limits=limits)


def change_type(current, previous):
    """Plans rank by their number."""
    return (F.when(previous.isNull(), fixed.NEW_SUBSCRIPTION)
            .when(current > previous, fixed.UPGRADE)
            .when(current < previous, fixed.DOWNGRADE)
            .otherwise(fixed.SAME_SUBSCRIPTION))


def lifecycle_periods(periods: DataFrame, as_of, limits: HotLimits = DEFAULT_LIMITS) -> DataFrame:
    """Periods with duration (an open one lasts until as_of), kind of change, and churn:
    a period that ended with no other after it."""
    start, end = F.col("fecha_inicio"), F.col("fecha_fin")
    churned = F.col("id_suscripcion_siguiente").isNull()
    return ordered_periods(periods, limits).select(
        "*",
        days_between(start, F.coalesce(end, as_date(as_of))).alias("duracion_dias"),
        change_type(F.col("id_suscripcion"), F.col("id_suscripcion_anterior")).alias("tipo_cambio"),
        F.when(churned, end).alias("fecha_churn"),
        F.when(churned, days_between("fecha_inicio_anterior", end))
        .alias("dias_desde_cambio_anterior"),
        F.when(churned, days_between("fecha_primer_suscripcion", end))
        .alias("dias_desde_inicio_cuenta"),
    )


def fact_suscripciones(
    periods: DataFrame,
    dim_accounts: DataFrame,
    dim_plans: DataFrame,
    as_of,
    on_overlap: str = "keep",
    limits: HotLimits = DEFAULT_LIMITS,
    slices: Slices | None = Slices(),
) -> DataFrame:
    """The fact: lifecycle columns with the account, plan and previous plan versions valid
    at the start of the period. The account join reuses the windows' partitioning; plans are few,
    and first periods have no previous one, so those joins are spread over time."""
    facts = lifecycle_periods(periods, as_of, limits)
    if slices and slices.span is None:
        slices = replace(slices, span=date_span(periods, "fecha_inicio"))
    facts = asof_dim(facts, dim_accounts, "id_cuenta", "fecha_inicio", "id_dim_cuenta",
                     on_overlap=on_overlap)
    facts = asof_dim(facts, dim_plans, "id_suscripcion", "fecha_inicio", "id_dim_suscripcion",
                     on_overlap=on_overlap, slices=slices)
    facts = asof_dim(facts, dim_plans, "id_suscripcion_anterior", "fecha_inicio",
                     "id_dim_suscripcion", "id_dim_suscripcion_anterior", "id_suscripcion", slices=slices)
    return facts.select(
        "id_dim_cuenta", "id_dim_suscripcion", "id_dim_suscripcion_anterior",
        "fecha_inicio", "fecha_fin", "duracion_dias", "tipo_cambio", "fecha_churn",
        "dias_desde_cambio_anterior", "dias_desde_inicio_cuenta")
