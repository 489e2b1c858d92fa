"""Segment updates for a CRM, as tables instead of calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from abono import fixed
from abono.functions import current_only


def crm_candidates(dim: DataFrame, limit: int | None = None) -> DataFrame:
    """Current accounts with a segment: all of them, or with a limit the ones of the lowest
    ids (0 means no rows)."""
    found = current_only(dim).filter(F.col("segmento_rfm_ultimo").isNotNull()).select(
        "id_cuenta", "segmento_rfm_ultimo")
    return found if limit is None else found.orderBy("id_cuenta").limit(limit)


def crm_match(candidates: DataFrame, companies: DataFrame,
              company_key: str = "id_cuenta", company_id: str = "company_id") -> DataFrame:
    """Candidates with the CRM's company id, null where the CRM has none. An extract that
    repeats a key counts with its lowest company id."""
    crm = companies.groupBy(F.col(company_key).alias("_k")).agg(F.min(company_id).alias("company_id"))
    return candidates.join(crm, F.col("id_cuenta") == F.col("_k"), "left").drop("_k").withColumn(
        "encontrada", F.col("company_id").isNotNull())


def crm_payload(matched: DataFrame) -> DataFrame:
    """One update per matched company."""
    body = F.to_json(F.struct(F.struct(
        F.col("segmento_rfm_ultimo").alias(fixed.CRM_PROPERTY)).alias("properties")))
    return matched.filter("encontrada").select("company_id", body.alias("payload"))


def crm_summary(matched: DataFrame) -> DataFrame:
    """Found, not found, total, and the share found in percent (null without rows)."""
    found = F.count_if("encontrada")
    return matched.agg(
        found.alias("encontradas"),
        F.count_if(~F.col("encontrada")).alias("no_encontradas"),
        F.count("*").alias("total"),
        F.round(F.try_divide(found * 100.0, F.count("*")), 1).alias("tasa_coincidencia"))


def mapping_test(dim: DataFrame, companies: DataFrame, account_id) -> DataFrame:
    """Summary for a single account, to probe the mapping."""
    one = current_only(dim).filter(F.col("id_cuenta") == account_id).select(
        "id_cuenta", "segmento_rfm_ultimo")
    return crm_summary(crm_match(one, companies))
