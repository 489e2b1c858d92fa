"""Recency, frequency and monetary scoring of accounts at a reference date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from abono import fixed
from abono.functions import (
    as_date, as_ts, days_between, has_tenure, in_window, paid_plan, valid_at)
from abono.operators.activity import payments_by_account
from abono.operators.history import dim_at
from abono.operators.rank import exact_ntile
from abono.schemas import MONEY

MEASURES = [
    "ultima_actividad", "dias_desde_ultima_actividad",
    "total_contenidos_creados", "total_pagos_realizados", "total_features_compradas",
    "frecuencia_total", "total_pagado_suscripciones", "total_pagado_features",
    "valor_monetario_total",
]
SCORES = {
    "recency_score": ("dias_desde_ultima_actividad", "desc"),
    "frequency_score": ("frecuencia_total", "asc"),
    "monetary_score": ("valor_monetario_total", "asc"),
}


def rfm_universe(dim_accounts: DataFrame, fact_subs: DataFrame, dim_plans: DataFrame, as_of,
                 min_tenure_months: int | None = 6) -> DataFrame:
    """Accounts on a paid plan at as_of with the minimum tenure. Tenure is read from the
    account version the period started under; periods without a version do not count."""
    paid = dim_plans.filter(paid_plan("nombre_suscripcion")).select("id_dim_suscripcion")
    active = (
        fact_subs.filter(valid_at(as_of, "fecha_inicio", "fecha_fin"))
        .join(paid, "id_dim_suscripcion", "left_semi")
        .select("id_dim_cuenta").distinct()
    )
    return (
        dim_accounts.filter(has_tenure("fecha_creacion", as_of, min_tenure_months))
        .join(active, "id_dim_cuenta", "left_semi")
        .select("id_cuenta").distinct()
    )


def account_activity(contents: DataFrame, payments: DataFrame, periods: DataFrame,
                     features: DataFrame, as_of, window_months: int | None = 6) -> DataFrame:
    """Latest date, counts and sums per account over all three activities in one
    aggregate; each source is read once and reduced before the shuffle."""
    def part(df, last, contents_n, payments_n, features_n, payments_sum, features_sum):
        money = F.lit(0).cast(MONEY)
        zero = F.lit(0).cast("bigint")
        return df.select(
            "id_cuenta", as_ts(last).alias("last"),
            (contents_n if contents_n is not None else zero).alias("contents_n"),
            (payments_n if payments_n is not None else zero).alias("payments_n"),
            (features_n if features_n is not None else zero).alias("features_n"),
            (payments_sum if payments_sum is not None else money).cast(MONEY).alias("payments_sum"),
            (features_sum if features_sum is not None else money).cast(MONEY).alias("features_sum"))

    def recent(df, ts):
        return df.filter(in_window(ts, as_of, window_months))

    one = F.lit(1).cast("bigint")
    paid = payments_by_account(recent(payments, "fecha_pago"), periods)
    every = part(recent(contents, "fecha_creacion"), "fecha_creacion", one, None, None, None, None)
    every = every.unionByName(part(
        paid, "ultimo_pago", None, F.col("total_pagos_realizados"), None,
        F.col("total_pagado_suscripciones"), None))
    every = every.unionByName(part(
        recent(features, "fecha_compra"), "fecha_compra", None, None, one, None,
        F.col("monto_pagado")))
    return every.filter(F.col("id_cuenta").isNotNull()).groupBy("id_cuenta").agg(
        F.max("last").alias("last"),
        *[F.sum(c).alias(c) for c in ("contents_n", "payments_n", "features_n")],
        *[F.sum(c).cast(MONEY).alias(c) for c in ("payments_sum", "features_sum")])


def rfm_base(universe: DataFrame, activity: DataFrame) -> DataFrame:
    return universe.join(activity, "id_cuenta", "left")


def rfm_recency(base: DataFrame, as_of, day_mode: str = "calendar") -> DataFrame:
    """Latest activity, or the far past when there is none, and its age in days."""
    never = as_ts(as_date(fixed.NO_DATE))
    dated = base.withColumn("ultima_actividad", F.greatest(F.coalesce("last", never), never))
    return dated.withColumn(
        "dias_desde_ultima_actividad",
        days_between("ultima_actividad", as_date(as_of), day_mode))


def rfm_frequency(base: DataFrame) -> DataFrame:
    def count(c):
        return F.coalesce(c, F.lit(0).cast("bigint"))

    parts = {"total_contenidos_creados": "contents_n", "total_pagos_realizados": "payments_n",
             "total_features_compradas": "features_n"}
    return base.select(
        "*", *[count(c).alias(out) for out, c in parts.items()],
        (count("contents_n") + count("payments_n") + count("features_n")).alias("frecuencia_total"))


def rfm_monetary(base: DataFrame) -> DataFrame:
    """Contents carry no money."""
    def amount(c):
        return F.coalesce(c, F.lit(0).cast(MONEY))

    return base.select(
        "*", amount("payments_sum").alias("total_pagado_suscripciones"),
        amount("features_sum").alias("total_pagado_features"),
        (amount("payments_sum") + amount("features_sum")).cast(MONEY)
        .alias("valor_monetario_total"))


def rfm_metrics(universe: DataFrame, activity: DataFrame, as_of,
                day_mode: str = "calendar") -> DataFrame:
    base = rfm_base(universe, activity)
    return rfm_monetary(rfm_frequency(rfm_recency(base, as_of, day_mode))).select(
        "id_cuenta", *MEASURES)


def rfm_scores(metrics: DataFrame) -> DataFrame:
    """Quintiles over the whole universe; ties go by account id."""
    return exact_ntile(metrics, "id_cuenta", SCORES, k=5)


def rfm_score_text(r="recency_score", f="frequency_score", m="monetary_score") -> Column:
    return F.concat(F.col(r).cast("string"), F.lit("-"), F.col(f).cast("string"),
                    F.lit("-"), F.col(m).cast("string"))


def rfm_segment(r="recency_score", f="frequency_score", m="monetary_score") -> Column:
    """Segment of a score triple: the first rule of fixed.SEGMENT_RULES that holds.

    Two catalogue entries, 'No se pueden perder' and 'Perdidos', cannot occur: every
    triple they describe is already 'Necesitan Atención' or 'Clientes Dormidos'."""
    result = F.lit(fixed.OTHER_SEGMENT)
    for name, *bounds in reversed(fixed.SEGMENT_RULES):
        holds = F.lit(True)
        for column, (low, high) in zip((r, f, m), bounds):
            holds = holds & F.col(column).between(low, high)
        result = F.when(holds, name).otherwise(result)
    return result


def fact_rfm(
    dim_accounts: DataFrame,
    fact_subs: DataFrame,
    dim_plans: DataFrame,
    contents: DataFrame,
    payments: DataFrame,
    periods: DataFrame,
    features: DataFrame,
    as_of,
    window_months: int | None = 6,
    min_tenure_months: int | None = 6,
    day_mode: str = "calendar",
) -> DataFrame:
    """One row per scored account at as_of. Scores are taken over the whole universe;
    accounts without a version valid at as_of leave only afterwards."""
    universe = rfm_universe(dim_accounts, fact_subs, dim_plans, as_of, min_tenure_months)
    activity = account_activity(contents, payments, periods, features, as_of, window_months)
    scored = rfm_scores(rfm_metrics(universe, activity, as_of, day_mode))
    return scored.join(
        dim_at(dim_accounts, as_of).select("id_cuenta", "id_dim_cuenta"), "id_cuenta"
    ).select(
        "id_dim_cuenta", *MEASURES, *SCORES,
        rfm_score_text().alias("rfm_score"),
        rfm_segment().alias("segmento_rfm"),
        as_date(as_of).alias("id_dim_fecha_rfm"))
