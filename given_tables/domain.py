"""Given tables as the domain's raw tables, and everything derived from them.

The oracle repeats this mapping in SQL (given_tables/oracle.py)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from abono.functions import as_date, moment
from abono.operators.history import new_versions, snapshot_merge
from abono.operators.shared import materialize
from abono.plans import dimensions, lifecycle, rfm, staging

AS_OF = "2000-07-01"
EARLIER = "2000-01-01"
NOW = "2024-01-31 00:00:00"
# Accounts are snapshotted twice: as they stood at the end of this day, and complete.
FIRST_RUN = "1998-12-31"
SECOND_RUN = "2002-01-01 00:00:00"
# The event log is snapshotted at these two moments.
EVENTS_FIRST = "2024-01-15 00:00:00"
EVENTS_SECOND = "2024-02-01 00:00:00"

PLAN_NAMES = ["Gratuita", "Basica", "Premium", "Empresarial", "Corporativa"]
PLAN_LIMITS = [5, 20, 50, 500, 999]


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._files: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        """A given table; its schema is looked up once."""
        if name not in self._files:
            self._files[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._files[name]

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """Domain as a source: raw tables by name."""
        if name not in RAW_NAMES:
            raise KeyError(f"no table {name}")
        return getattr(self, name)

    # Raw tables.

    def accounts_until(self, day: str | None = None) -> DataFrame:
        """Accounts as of the end of a day: an account exists from its first order on and
        is updated by each."""
        orders = self.read("orders")
        if day:
            orders = orders.filter(F.col("o_orderdate") < moment(F.date_add(as_date(day), 1)))
        dates = orders.groupBy("o_custkey").agg(
            F.min("o_orderdate").alias("created_at"), F.max("o_orderdate").alias("updated_at"))
        return self.read("customer").join(dates, F.col("c_custkey") == F.col("o_custkey")).select(
            F.col("c_custkey").alias("account_id"), F.col("c_name").alias("account_name"),
            F.concat(F.lower("c_mktsegment"), F.col("c_custkey").cast("string"),
                     F.lit("@example.com")).alias("email"),
            "created_at", "updated_at")

    @cached_property
    def accounts(self) -> DataFrame:
        return self.accounts_until()

    @cached_property
    def subscriptions(self) -> DataFrame:
        """Plans: one per order priority, in service since its first order."""
        names = F.array(*[F.lit(n) for n in PLAN_NAMES])
        limits = F.array(*[F.lit(n) for n in PLAN_LIMITS])
        return self.read("orders").groupBy("o_orderpriority").agg(
            F.min("o_orderdate").alias("created_at"), F.max("o_orderdate").alias("updated_at"),
        ).withColumn("subscription_id", _plan("o_orderpriority")).select(
            "subscription_id",
            F.get(names, F.col("subscription_id") - 1).alias("subscription_name"),
            F.get(limits, F.col("subscription_id") - 1).alias("max_contents_per_month"),
            "created_at", "updated_at")

    @cached_property
    def accounts_subscription(self) -> DataFrame:
        start = F.col("o_orderdate").cast("date")
        return self.read("orders").select(
            F.col("o_orderkey").alias("account_subscription_id"),
            F.col("o_custkey").alias("account_id"),
            _plan("o_orderpriority").alias("subscription_id"),
            start.alias("start_date"),
            F.when(F.col("o_orderstatus") != "O", F.date_add(start, 90)).alias("end_date"))

    @cached_property
    def contents(self) -> DataFrame:
        """Orders that are not pending."""
        low = F.col("o_orderpriority").startswith
        return self.read("orders").filter(F.col("o_orderstatus") != "P").select(
            F.col("o_orderkey").alias("content_id"), F.col("o_custkey").alias("account_id"),
            F.when(~low("5"), F.concat(F.lit("c"), F.col("o_orderkey").cast("string")))
            .alias("title"),
            F.when(F.col("o_totalprice") > 250000, F.concat(F.lit("d "), F.col("o_orderpriority")))
            .alias("description"),
            F.when(low("4"), None).when(F.col("o_orderstatus") == "F", "articulo")
            .otherwise("quiz").alias("content_type"),
            F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"))

    @cached_property
    def content_attributes(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.read("lineitem").select(
            F.concat_ws("-", *[F.col(c).cast("string") for c in (
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("attribute_id"), F.col("l_orderkey").alias("content_id"),
            F.when(flag == "A", "Categoría").when(flag == "R", "Duración").otherwise("Otro")
            .alias("attribute_name"),
            F.col("l_linestatus").alias("string_value"),
            F.col("l_quantity").cast("decimal(18,3)").alias("decimal_value"),
            F.col("l_shipdate").cast("date").alias("date_value"),
            F.col("l_shipdate").alias("created_at"), F.col("l_shipdate").alias("updated_at"))

    @cached_property
    def premium_features(self) -> DataFrame:
        since = moment("1995-01-01 00:00:00")
        return self.read("part").select(
            F.col("p_partkey").alias("feature_id"), F.col("p_name").alias("feature_name"),
            F.col("p_type").alias("description"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("base_price"),
            since.alias("created_at"), since.alias("updated_at"))

    @cached_property
    def subscription_payments(self) -> DataFrame:
        return self.read("lineitem").select(
            _line_id().alias("payment_id"),
            F.col("l_orderkey").alias("account_subscription_id"),
            F.col("l_shipdate").alias("payment_date"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
            F.when(F.col("l_linestatus") == "O", "PayPal").otherwise("Tarjeta de Crédito")
            .alias("payment_method"),
            F.lit("Mensual").alias("billing_cycle"))

    @cached_property
    def account_premium_features(self) -> DataFrame:
        bought = self.read("lineitem").filter(F.col("l_returnflag") == "R")
        return bought.join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
            _line_id().alias("account_feature_id"), F.col("o_custkey").alias("account_id"),
            F.col("l_partkey").alias("feature_id"), F.col("l_shipdate").alias("purchase_date"),
            F.col("l_quantity").cast("decimal(10,2)").alias("amount_paid"))

    # Staging.

    @cached_property
    def stg_accounts(self) -> DataFrame:
        return staging.stg_accounts(self.accounts)

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return staging.stg_subscriptions(self.subscriptions)

    @cached_property
    def stg_accounts_subscription(self) -> DataFrame:
        return staging.stg_accounts_subscription(self.accounts_subscription)

    @cached_property
    def stg_contents(self) -> DataFrame:
        return staging.stg_contents(self.contents, self.content_attributes)

    @cached_property
    def stg_subscription_payments(self) -> DataFrame:
        return staging.stg_subscription_payments(self.subscription_payments)

    @cached_property
    def stg_premium_features(self) -> DataFrame:
        return staging.stg_premium_features(self.premium_features)

    @cached_property
    def stg_account_premium_features(self) -> DataFrame:
        return staging.stg_account_premium_features(self.account_premium_features)

    # Snapshots, dimensions, facts.

    @cached_property
    def accounts_snapshot(self) -> DataFrame:
        first = new_versions(staging.stg_accounts(self.accounts_until(FIRST_RUN)),
                             "id_cuenta", "fecha_actualizacion")
        return snapshot_merge(first, self.stg_accounts, "id_cuenta", "fecha_actualizacion",
                              SECOND_RUN)

    @cached_property
    def subscriptions_snapshot(self) -> DataFrame:
        return new_versions(self.stg_subscriptions, "id_suscripcion", "fecha_actualizacion")

    @cached_property
    def contents_snapshot(self) -> DataFrame:
        return new_versions(self.stg_contents, "id_contenido", "fecha_actualizacion")

    @cached_property
    def dim_cuentas_base(self) -> DataFrame:
        return dimensions.dim_cuentas_base(self.accounts_snapshot)

    @cached_property
    def dim_suscripciones(self) -> DataFrame:
        return dimensions.dim_suscripciones(self.subscriptions_snapshot)

    @cached_property
    def dim_contenidos(self) -> DataFrame:
        return dimensions.dim_contenidos(self.contents_snapshot)

    @cached_property
    def fact_suscripciones(self) -> DataFrame:
        return lifecycle.fact_suscripciones(
            self.stg_accounts_subscription, self.dim_cuentas_base, self.dim_suscripciones, AS_OF)

    # Dimensions at rest for the scoring queries, which read them several times.

    @cached_property
    def dim_cuentas_base_stored(self) -> DataFrame:
        return materialize(self.dim_cuentas_base, "dim_cuentas_base")

    @cached_property
    def dim_suscripciones_stored(self) -> DataFrame:
        return materialize(self.dim_suscripciones, "dim_suscripciones")

    @cached_property
    def fact_suscripciones_scored(self) -> DataFrame:
        return lifecycle.fact_suscripciones(
            self.stg_accounts_subscription, self.dim_cuentas_base_stored,
            self.dim_suscripciones_stored, AS_OF)

    def universe(self, as_of: str = AS_OF) -> DataFrame:
        return rfm.rfm_universe(
            self.dim_cuentas_base_stored, self.fact_suscripciones_scored,
            self.dim_suscripciones_stored, as_of)

    def activity(self, as_of: str = AS_OF) -> DataFrame:
        return rfm.account_activity(
            self.stg_contents, self.stg_subscription_payments, self.stg_accounts_subscription,
            self.stg_account_premium_features, as_of)

    def metrics(self, as_of: str = AS_OF) -> DataFrame:
        return rfm.rfm_metrics(self.universe(as_of), self.activity(as_of), as_of)

    def fact_rfm(self, as_of: str = AS_OF, **options) -> DataFrame:
        return rfm.fact_rfm(
            self.dim_cuentas_base_stored, self.fact_suscripciones_scored,
            self.dim_suscripciones_stored,
            self.stg_contents, self.stg_subscription_payments, self.stg_accounts_subscription,
            self.stg_account_premium_features, as_of, **options)

    @cached_property
    def fact_rfm_latest(self) -> DataFrame:
        return self.fact_rfm()

    @cached_property
    def fact_rfm_both(self) -> DataFrame:
        """Scores at two dates."""
        return self.fact_rfm(EARLIER).unionByName(self.fact_rfm_latest)

    @cached_property
    def dim_cuentas(self) -> DataFrame:
        return dimensions.dim_cuentas(self.dim_cuentas_base_stored, self.fact_rfm_both)

    @cached_property
    def companies(self) -> DataFrame:
        """CRM extract: customers with a positive balance are known there."""
        return self.read("customer").filter(F.col("c_acctbal") > 0).select(
            F.col("c_custkey").alias("id_cuenta"),
            F.concat(F.lit("crm-"), F.col("c_custkey").cast("string")).alias("company_id"))

    # The event log as a change log of users.

    @cached_property
    def events_log(self) -> DataFrame:
        return self.read("events").select("user_id", "ts", "event_id", "event_type", "value")


RAW_NAMES = {
    "accounts", "subscriptions", "accounts_subscription", "contents", "content_attributes",
    "premium_features", "subscription_payments", "account_premium_features",
}


def _plan(priority: str):
    return (F.lit(6) - F.substring(priority, 1, 1).cast("int")).cast("int")


def _line_id():
    """Lines have no unique id in the given tables; this one repeats for some."""
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")
