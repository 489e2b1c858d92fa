"""Segment catalogue and customer lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abono import fixed
from abono.functions import current_only, int_or_zero, text_or_empty


def segment_catalog(spark) -> DataFrame:
    return spark.createDataFrame(
        fixed.SEGMENTS, "segmento string, descripcion string, caracteristicas string")


def with_segment_text(fact_rfm: DataFrame) -> DataFrame:
    """Scores with the description and rule of their segment. The catalogue has a fixed
    number of rows."""
    catalog = F.broadcast(segment_catalog(fact_rfm.sparkSession))
    return fact_rfm.join(catalog, fact_rfm["segmento_rfm"] == catalog["segmento"], "left").drop(
        "segmento")


def customer_rfm(dim: DataFrame, ids: DataFrame) -> DataFrame:
    """Current row of each requested account as served."""
    wanted = ids.select("id_cuenta").distinct()
    return current_only(dim).join(wanted, "id_cuenta", "left_semi").select(
        int_or_zero("id_cuenta").alias("id_cuenta"),
        text_or_empty("correo_electronico").alias("email"),
        text_or_empty("nombre_cuenta").alias("nombre"),
        text_or_empty("segmento_rfm_ultimo").alias("segmento_rfm_ultimo"),
        text_or_empty("fecha_rfm_ultimo").alias("fecha_rfm_ultimo"),
        text_or_empty("segmento_rfm_anterior").alias("segmento_rfm_anterior"),
        text_or_empty("fecha_rfm_anterior").alias("fecha_rfm_anterior"))


def customers_not_found(dim: DataFrame, ids: DataFrame) -> DataFrame:
    return ids.select("id_cuenta").distinct().join(
        current_only(dim).select("id_cuenta"), "id_cuenta", "left_anti")
