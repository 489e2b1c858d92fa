"""Activity per account: latest date, number, amount."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abono.schemas import MONEY


def last_activity(df: DataFrame, key: str, ts: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(ts).alias(out))


def activity_count(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(out))


def activity_amount(df: DataFrame, key: str, amount: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(amount).cast(MONEY).alias(out))


def payments_by_account(payments: DataFrame, periods: DataFrame) -> DataFrame:
    """Payment totals per subscription period with the period's account. Payments are
    summed up before the join, so the join sees one row per period on either side
    however many payments one period has."""
    totals = payments.groupBy("id_suscripcion_cuenta").agg(
        F.max("fecha_pago").alias("ultimo_pago"),
        F.count("*").alias("total_pagos_realizados"),
        F.sum("monto").cast(MONEY).alias("total_pagado_suscripciones"))
    return totals.join(
        periods.select("id_suscripcion_cuenta", "id_cuenta"), "id_suscripcion_cuenta")
