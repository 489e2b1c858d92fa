"""Staging tables: rename, cast, defaults, and the content pivot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abono import fixed
from abono.functions import as_ts
from abono.operators.merge import above, since_watermark, watermark
from abono.operators.project import pivot_eav, rename_project

TS = "timestamp_ntz"
DATED = {"fecha_creacion": TS, "fecha_actualizacion": TS}

# Target key of each table that loads incrementally; the others are rebuilt.
INCREMENTAL_KEYS = {
    "stg_accounts": "id_cuenta",
    "stg_contents": "id_contenido",
    "stg_subscription_payments": "id_pago",
}
# Here the key itself is the watermark: new rows cannot meet old ones, so appending them
# is the upsert, and nothing is rewritten.
GROWING_KEYS = {"stg_subscription_payments"}


def stg_accounts(raw: DataFrame, target: DataFrame | None = None,
                 inclusive: bool = False) -> DataFrame:
    rows = since_watermark(raw, target, "updated_at", "fecha_actualizacion", inclusive)
    return rename_project(rows, {
        "account_id": "id_cuenta", "account_name": "nombre_cuenta",
        "email": "correo_electronico", "created_at": "fecha_creacion",
        "updated_at": "fecha_actualizacion"}, DATED)


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    return rename_project(raw, {
        "subscription_id": "id_suscripcion", "subscription_name": "nombre_suscripcion",
        "max_contents_per_month": "max_contenidos_mensuales",
        "created_at": "fecha_creacion", "updated_at": "fecha_actualizacion"}, DATED)


def stg_accounts_subscription(raw: DataFrame) -> DataFrame:
    return rename_project(raw, {
        "account_subscription_id": "id_suscripcion_cuenta", "account_id": "id_cuenta",
        "subscription_id": "id_suscripcion", "start_date": "fecha_inicio",
        "end_date": "fecha_fin"})


def stg_subscription_payments(raw: DataFrame, target: DataFrame | None = None,
                              inclusive: bool = False) -> DataFrame:
    """Payments never change, so a growing id is the cursor."""
    rows = since_watermark(raw, target, "payment_id", "id_pago", inclusive)
    return rename_project(rows, {
        "payment_id": "id_pago", "account_subscription_id": "id_suscripcion_cuenta",
        "payment_date": "fecha_pago", "amount": "monto",
        "payment_method": "metodo_pago", "billing_cycle": "ciclo_facturacion"})


def stg_premium_features(raw: DataFrame) -> DataFrame:
    return rename_project(raw, {
        "feature_id": "id_feature", "feature_name": "nombre_feature",
        "description": "descripcion", "base_price": "precio_base",
        "created_at": "fecha_creacion", "updated_at": "fecha_actualizacion"}, DATED)


def stg_account_premium_features(raw: DataFrame) -> DataFrame:
    return rename_project(raw, {
        "account_feature_id": "id_cuenta_feature", "account_id": "id_cuenta",
        "feature_id": "id_feature", "purchase_date": "fecha_compra",
        "amount_paid": "monto_pagado"})


def content_attributes_wide(attrs: DataFrame) -> DataFrame:
    return pivot_eav(
        attrs, "content_id",
        {"categoria": (fixed.CATEGORY_ATTRIBUTE, "string_value"),
         "duracion": (fixed.DURATION_ATTRIBUTE, "decimal_value")},
        extra=[F.max(as_ts("created_at")).alias("created_at"),
               F.max(as_ts("updated_at")).alias("updated_at")])


def stg_contents(contents: DataFrame, attrs: DataFrame, target: DataFrame | None = None,
                 strict_nulls: bool = False, inclusive: bool = False) -> DataFrame:
    """Contents with their pivoted attributes; either side may be missing.

    Dates are the later of both sides. By default a missing side is ignored; with
    strict_nulls it makes the date null, and such rows never pass the watermark.

    With a target, contents changed on neither side are left out before the pivot and the
    join; what remains is filtered by the joined date as well."""
    mark = watermark(target, "fecha_actualizacion")
    if mark is not None:
        def changed(df):
            return above(df, "updated_at", mark, inclusive).select("content_id")
        ids = changed(contents).unionByName(changed(attrs)).distinct()
        contents = contents.join(ids, "content_id", "left_semi")
        attrs = attrs.join(ids, "content_id", "left_semi")
    c = contents.alias("c")
    a = content_attributes_wide(attrs).alias("a")

    def later(name):
        left, right = as_ts(f"c.{name}"), F.col(f"a.{name}")
        if strict_nulls:
            return F.when(left.isNotNull() & right.isNotNull(), F.greatest(left, right))
        return F.greatest(left, right)

    joined = c.join(a, F.col("c.content_id") == F.col("a.content_id"), "full_outer").select(
        F.coalesce("c.content_id", "a.content_id").alias("id_contenido"),
        F.col("c.account_id").alias("id_cuenta"),
        F.coalesce("c.title", F.lit(fixed.NO_TITLE)).alias("titulo"),
        F.coalesce("c.description", F.lit(fixed.NO_DESCRIPTION)).alias("descripcion"),
        F.coalesce("c.content_type", F.lit(fixed.NO_TYPE)).alias("tipo_contenido"),
        F.col("a.categoria"),
        F.col("a.duracion"),
        later("created_at").alias("fecha_creacion"),
        later("updated_at").alias("fecha_actualizacion"),
    )
    return joined if mark is None else above(joined, "fecha_actualizacion", mark, inclusive)
