"""Report of accounts whose latest subscription is the enterprise plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abono import fixed
from abono.functions import days_between
from abono.operators.rank import top_n_per_key
from abono.sinks.reports import write_report
from abono.sources.tables import extract_report_inputs


def enterprise_report(accounts: DataFrame, plans: DataFrame, periods: DataFrame,
                      plan: str = fixed.ENTERPRISE_PLAN) -> DataFrame:
    """Latest and previous period per account, from the account's two newest periods;
    kept where the latest is on the plan. The flag marks any other plan before it.

    Only the two newest rows of an account leave a map task, and accounts are joined
    after the filter."""
    named = periods.join(plans.select("subscription_id", "subscription_name"), "subscription_id")
    newest = [F.col("start_date").desc_nulls_last(), F.col("account_subscription_id").desc()]
    two = top_n_per_key(
        named.select("account_id", "account_subscription_id", "start_date", "subscription_name"),
        "account_id", newest, n=2, rank="puesto")

    def ranked(column, n):
        return F.max(F.when(F.col("puesto") == n, F.col(column)))

    latest = two.groupBy("account_id").agg(
        ranked("start_date", 1).alias("start"), ranked("subscription_name", 1).alias("name"),
        ranked("start_date", 2).alias("prev_start"),
        ranked("subscription_name", 2).alias("prev_name"),
    ).filter(F.col("name") == plan)
    return latest.join(
        accounts.select("account_id", "account_name", "created_at"), "account_id"
    ).select(
        "account_id", "account_name",
        F.col("created_at").alias("account_created_date"),
        F.col("start").alias("enterprise_start_date"),
        days_between("prev_start", "start").alias("days_between_prev_and_enterprise"),
        F.when(F.col("prev_name") != plan, 1).otherwise(0).cast("int").alias("is_upgrade_flag"))


def run_report(spark, source, out_dir: str, run_date) -> bool:
    """Extract, transform, write. Stops without writing when an input or the result is
    empty; says whether a report was written."""
    accounts, plans, periods = extract_report_inputs(spark, source)
    if any(df.isEmpty() for df in (accounts, plans, periods)):
        return False
    return write_report(enterprise_report(accounts, plans, periods), out_dir, run_date)
