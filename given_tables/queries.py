"""One registered query per operator, with its SQL, over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from abono import fixed
from abono.functions import (
    current_only, has_tenure, in_window, last_day_before, paid_plan, valid_at, yyyymmdd)
from abono.operators import activity, checks, history, merge, rank
from abono.operators.shared import materialize, new_path
from abono.plans import (
    activation, dimensions, jobs, lifecycle, quality, report, rfm, serving, staging)
from abono.sinks import reports, versions
from abono.sources import tables as sources
from given_tables import domain as dm
from given_tables.domain import AS_OF, EARLIER, NOW, Domain
from given_tables.oracle import MONEY, sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(build: Callable[[Domain], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Domain(spark, sf_dir))
        if oracle:
            ORACLES[name] = sql(oracle)
        return build
    return add


def scratch(d: Domain, name: str) -> str:
    return new_path(d.spark, name)


def simple(name: str, build: Callable[[Domain], DataFrame], oracle: str) -> None:
    query(name, oracle)(build)


# Sources and loads.

@query("src1_read_tables", " UNION ALL BY NAME ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS filas FROM {t}"
    for t in fixed.RAW_TABLES))
def _(d):
    found = sources.read_tables(d.spark, d)
    return checks.union_results([
        df.agg(F.count("*").alias("filas")).select(F.lit(t).alias("table_name"), "filas")
        for t, df in found.items()])


_SRC2 = {"accounts": ("account_id", "account_name"), "subscriptions": ("subscription_id", "subscription_name"),
         "accounts_subscription": ("account_subscription_id", "account_id")}


@query("src2_report_inputs", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({a} AS VARCHAR) AS first, CAST({b} AS VARCHAR) AS second FROM {t}"
    for t, (a, b) in _SRC2.items()))
def _(d):
    found = zip(_SRC2.items(), sources.extract_report_inputs(d.spark, d))
    return checks.union_results([
        df.select(F.lit(t).alias("table_name"), F.col(a).cast("string").alias("first"), F.col(b).cast("string").alias("second"))
        for (t, (a, b)), df in found])


@query("ld4_upsert_repeated_keys", "SELECT user_id, event_id FROM events_all")
def _(d):
    """A batch with many rows per key, without and then with a cursor: one row per key."""
    path = scratch(d, "ld4r")
    log = d.events_log.select("user_id", "ts", "event_id")
    versions.load_upsert(log, path, "user_id")
    return versions.load_upsert(log, path, "user_id", "ts").select("user_id", "event_id")


@query("ld1_replace", "SELECT * FROM accounts")
def _(d):
    path = scratch(d, "ld1")
    versions.load_replace(d.accounts_until(dm.FIRST_RUN), path)
    return versions.load_replace(d.accounts, path)


@query("ld2_incremental", "SELECT user_id, ts, event_id, event_type, value FROM events_all")
def _(d):
    path = scratch(d, "ld2")
    before = d.events_log.filter(F.col("ts") < dm.moment(dm.EVENTS_FIRST))
    versions.load_upsert(before, path, "user_id", "ts")
    return versions.load_incremental(d.events_log, path, "user_id", "ts")


@query("ld3_mode_choice", "SELECT 'contents' AS table_name, content_id AS id FROM contents"
       " UNION ALL BY NAME SELECT 'accounts' AS table_name, account_id AS id FROM accounts")
def _(d):
    contents = versions.load_table(d.contents, scratch(d, "ld3"), "content_id", incremental=True)
    accounts = versions.load_table(d.accounts, scratch(d, "ld3"), "account_id", incremental=False)
    return contents.select(F.lit("contents").alias("table_name"), F.col("content_id").alias("id")
                           ).unionByName(accounts.select(F.lit("accounts").alias("table_name"),
                                                         F.col("account_id").alias("id")))


LD4_SQL = """
SELECT * FROM accounts WHERE updated_at > (SELECT max(updated_at) FROM accounts_first)
UNION ALL BY NAME
SELECT f.* FROM accounts_first f WHERE account_id NOT IN (
    SELECT account_id FROM accounts
    WHERE updated_at > (SELECT max(updated_at) FROM accounts_first))"""


@query("ld4_upsert", LD4_SQL)
def _(d):
    old = d.accounts_until(dm.FIRST_RUN)
    fresh = merge.since_watermark(d.accounts, old, "updated_at")
    return merge.merge_upsert(old, fresh, "account_id", "updated_at")


@query("ld4_upsert_buckets", LD4_SQL)
def _(d):
    """The same upsert on a stored table: only buckets with keys of the batch are written."""
    path = scratch(d, "ld4b")
    old = versions.load_upsert(d.accounts_until(dm.FIRST_RUN), path, "account_id", "updated_at", buckets=8)
    fresh = merge.since_watermark(d.accounts, old, "updated_at")
    return versions.load_upsert(fresh, path, "account_id", "updated_at")


@query("ld3_modes_in_turn", f"""
SELECT 'first' AS modo, * FROM accounts_first
UNION ALL BY NAME SELECT 'merged' AS modo, * FROM ({LD4_SQL})
UNION ALL BY NAME SELECT 'refreshed' AS modo, * FROM accounts_first""")
def _(d):
    """First load, merge and full refresh of one table, which is read after each of them."""
    path = scratch(d, "ld3t")
    found = []
    for mode, source, full in (("first", d.accounts_until(dm.FIRST_RUN), False), ("merged", d.accounts, False),
                               ("refreshed", d.accounts_until(dm.FIRST_RUN), True)):
        found.append(versions.load_table(source, path, "account_id", incremental=True, full_refresh=full)
                     .withColumn("modo", F.lit(mode)))
    return checks.union_results(found)


@query("src3_catalog_table", "SELECT user_id, ts, event_id, event_type, value FROM events")
def _(d):
    """A table of the session's catalog, by layer and environment."""
    schema, name = sources.schema_name("raw", "abono"), f"events_{uuid.uuid4().hex}"
    d.spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    d.events_log.write.saveAsTable(f"{schema}.{name}")
    return sources.CatalogSource("raw", "abono").table(d.spark, name)


@query("ld5_append", "SELECT * FROM accounts_first UNION ALL BY NAME SELECT * FROM accounts")
def _(d):
    path = scratch(d, "ld5")
    versions.load_append(d.accounts_until(dm.FIRST_RUN), path)
    return versions.load_append(d.accounts, path)


simple("ld6_watermark",
       lambda d: staging.stg_accounts(
           d.accounts, staging.stg_accounts(d.accounts_until(dm.FIRST_RUN))),
       """SELECT * FROM stg_accounts WHERE fecha_actualizacion >
          (SELECT max(fecha_actualizacion) FROM stg_accounts_first)""")


@query("ld7_fact_rfm_write", "SELECT * FROM fact_rfm_both")
def _(d):
    path = scratch(d, "ld7")
    versions.write_fact_rfm(d.fact_rfm(EARLIER), path)
    later = d.fact_rfm(AS_OF)
    versions.write_fact_rfm(later, path)
    return versions.write_fact_rfm(later, path)


@query("ld8_report_csv", "SELECT * FROM report")
def _(d):
    out = scratch(d, "ld8")
    found = report.enterprise_report(d.accounts, d.subscriptions, d.accounts_subscription)
    reports.write_report(found, out, AS_OF)
    name = reports.report_name(AS_OF)
    return sources.read_csv(d.spark, f"{out}/{name}", found.schema)


@query("ld9_crm_outbox", """SELECT company_id,
    '{"properties":{"segmento_rfm":"' || segmento_rfm_ultimo || '"}}' AS payload
    FROM crm_matched WHERE encontrada""")
def _(d):
    path = scratch(d, "ld9")
    payloads = activation.crm_payload(
        activation.crm_match(activation.crm_candidates(d.dim_cuentas), d.companies))
    reports.write_crm_outbox(payloads, path)
    return d.spark.read.schema(payloads.schema).json(path)


# Staging.

for _name in ["stg_accounts", "stg_subscriptions", "stg_accounts_subscription",
              "stg_subscription_payments", "stg_premium_features",
              "stg_account_premium_features", "stg_contents"]:
    simple(f"st{len([q for q in QUERIES if q.startswith('st')]) + 1}_{_name[4:]}",
           lambda d, n=_name: getattr(d, n), f"SELECT * FROM {_name}")

simple("st7_contents_strict_nulls",
       lambda d: staging.stg_contents(d.contents, d.content_attributes, strict_nulls=True),
       """SELECT s.* EXCLUDE (fecha_creacion, fecha_actualizacion),
                 CASE WHEN c.content_id IS NOT NULL AND a.content_id IS NOT NULL
                      THEN fecha_creacion END AS fecha_creacion,
                 CASE WHEN c.content_id IS NOT NULL AND a.content_id IS NOT NULL
                      THEN fecha_actualizacion END AS fecha_actualizacion
          FROM stg_contents s LEFT JOIN contents c ON s.id_contenido = c.content_id
          LEFT JOIN attributes_wide a ON s.id_contenido = a.content_id""")
simple("st7_contents_incremental",
       lambda d: staging.stg_contents(
           d.contents, d.content_attributes,
           target=d.stg_contents.filter(F.col("fecha_actualizacion") <= dm.moment(AS_OF))),
       f"""SELECT * FROM stg_contents WHERE fecha_actualizacion > (
           SELECT max(fecha_actualizacion) FROM stg_contents
           WHERE fecha_actualizacion <= TIMESTAMP '{AS_OF}')""")
simple("ag1_pivot_eav", lambda d: staging.content_attributes_wide(d.content_attributes),
       "SELECT * FROM attributes_wide")


# Filters and scalars.

simple("f1_window",
       lambda d: d.stg_contents.filter(in_window("fecha_creacion", AS_OF)),
       f"""SELECT * FROM stg_contents WHERE fecha_creacion
           BETWEEN DATE '{AS_OF}' - INTERVAL 6 MONTH AND CAST(DATE '{AS_OF}' AS TIMESTAMP)""")
simple("f2_tenure", lambda d: d.stg_accounts.filter(has_tenure("fecha_creacion", AS_OF)),
       f"SELECT * FROM stg_accounts WHERE fecha_creacion <= DATE '{AS_OF}' - INTERVAL 6 MONTH")
simple("f3_paid_plan",
       lambda d: d.stg_accounts_subscription.join(
           d.stg_subscriptions.filter(paid_plan("nombre_suscripcion")), "id_suscripcion",
           "left_semi"),
       """SELECT p.* FROM stg_accounts_subscription p WHERE id_suscripcion IN (
          SELECT id_suscripcion FROM stg_subscriptions WHERE nombre_suscripcion <> 'Gratuita')""")
simple("f4_valid_at",
       lambda d: d.stg_accounts_subscription.filter(valid_at(AS_OF, "fecha_inicio", "fecha_fin")),
       f"""SELECT * FROM stg_accounts_subscription WHERE DATE '{AS_OF}'
           BETWEEN fecha_inicio AND coalesce(fecha_fin, DATE '9999-12-31')""")
simple("f5_current", lambda d: current_only(d.dim_cuentas_base),
       "SELECT * FROM dim_cuentas_base WHERE es_actual")
simple("f8_top2_periods",
       lambda d: rank.top_n_per_key(
           d.stg_accounts_subscription, "id_cuenta",
           [F.col("fecha_inicio").desc_nulls_last(), F.col("id_suscripcion_cuenta").desc()],
           n=2, rank="puesto"),
       """SELECT *, row_number() OVER (PARTITION BY id_cuenta ORDER BY fecha_inicio DESC NULLS LAST,
                 id_suscripcion_cuenta DESC) AS puesto
          FROM stg_accounts_subscription QUALIFY puesto <= 2""")
simple("sc10_sc12_dates",
       lambda d: d.stg_accounts.select(
           "id_cuenta", last_day_before("fecha_creacion").alias("vispera"),
           yyyymmdd(F.col("fecha_creacion")).alias("texto")),
       """SELECT id_cuenta, CAST(CAST(fecha_creacion AS DATE) - 1 AS DATE) AS vispera,
                 strftime(fecha_creacion, '%Y%m%d') AS texto FROM stg_accounts""")


# Joins.

simple("j2_payments_by_account",
       lambda d: activity.payments_by_account(
           d.stg_subscription_payments, d.stg_accounts_subscription),
       f"""SELECT id_suscripcion_cuenta, max(fecha_pago) AS ultimo_pago,
                  CAST(count(*) AS BIGINT) AS total_pagos_realizados,
                  CAST(sum(monto) AS {MONEY}) AS total_pagado_suscripciones, id_cuenta
           FROM stg_subscription_payments JOIN stg_accounts_subscription USING (id_suscripcion_cuenta)
           GROUP BY id_suscripcion_cuenta, id_cuenta""")
simple("j6_asof_dim",
       lambda d: history.asof_dim(d.stg_accounts_subscription, d.dim_cuentas_base_stored,
                                  "id_cuenta", "fecha_inicio", "id_dim_cuenta",
                                  on_overlap="error"),
       """SELECT s.*, c.id_dim_cuenta FROM stg_accounts_subscription s
          LEFT JOIN dim_cuentas_base c ON s.id_cuenta = c.id_cuenta
           AND s.fecha_inicio BETWEEN c.valido_desde AND c.valido_hasta""")
simple("j6_asof_plans",
       lambda d: history.asof_dim(d.stg_accounts_subscription, d.dim_suscripciones_stored,
                                  "id_suscripcion", "fecha_inicio", "id_dim_suscripcion",
                                  on_overlap="error", slices=history.Slices()),
       """SELECT s.*, p.id_dim_suscripcion FROM stg_accounts_subscription s
          LEFT JOIN dim_suscripciones p ON s.id_suscripcion = p.id_suscripcion
           AND s.fecha_inicio BETWEEN p.valido_desde AND p.valido_hasta""")
simple("j7_dim_at",
       lambda d: d.stg_accounts.select("id_cuenta").join(
           history.dim_at(d.dim_cuentas_base, AS_OF).select("id_cuenta", "id_dim_cuenta"),
           "id_cuenta"),
       f"""SELECT a.id_cuenta, c.id_dim_cuenta FROM stg_accounts a JOIN dim_cuentas_base c
           ON a.id_cuenta = c.id_cuenta
           AND DATE '{AS_OF}' BETWEEN c.valido_desde AND c.valido_hasta""")
simple("j9_orphans",
       lambda d: checks.orphans(d.content_attributes, "content_id", d.contents, "content_id"),
       """SELECT a.* FROM content_attributes a LEFT JOIN contents c ON a.content_id = c.content_id
          WHERE a.content_id IS NOT NULL AND c.content_id IS NULL""")


# Aggregates.

simple("ag2_last_activity",
       lambda d: activity.last_activity(d.stg_contents, "id_cuenta", "fecha_creacion", "ultima"),
       "SELECT id_cuenta, max(fecha_creacion) AS ultima FROM stg_contents GROUP BY id_cuenta")
simple("ag3_activity_count",
       lambda d: activity.activity_count(d.stg_account_premium_features, "id_cuenta", "compras"),
       "SELECT id_cuenta, count(*) AS compras FROM stg_account_premium_features GROUP BY id_cuenta")
simple("ag4_activity_amount",
       lambda d: activity.activity_amount(
           d.stg_account_premium_features, "id_cuenta", "monto_pagado", "pagado"),
       f"""SELECT id_cuenta, CAST(sum(monto_pagado) AS {MONEY}) AS pagado
           FROM stg_account_premium_features GROUP BY id_cuenta""")
simple("se2_distinct_accounts",
       lambda d: d.stg_accounts_subscription.select("id_cuenta").distinct(),
       "SELECT DISTINCT id_cuenta FROM stg_accounts_subscription")


# Windows.

simple("w1_w3_neighbours", lambda d: lifecycle.ordered_periods(d.stg_accounts_subscription),
       "SELECT * FROM periods_ordered")
simple("w5_latest_period",
       lambda d: rank.newest_per_key(d.stg_accounts_subscription, "id_cuenta", "fecha_inicio",
                                     ["id_suscripcion_cuenta"]),
       """SELECT * FROM stg_accounts_subscription QUALIFY row_number() OVER (
          PARTITION BY id_cuenta ORDER BY fecha_inicio DESC NULLS LAST,
          id_suscripcion_cuenta DESC NULLS LAST) = 1""")
simple("w6_last_version_per_day",
       lambda d: history.last_version_per_day(
           history.versions_from_history(d.events_log, "user_id", "ts", "event_id"), "user_id"),
       """SELECT * FROM events_versions QUALIFY row_number() OVER (
          PARTITION BY user_id, CAST(dbt_valid_from AS DATE) ORDER BY dbt_valid_from DESC) = 1""")
W9_SQL = """SELECT id_cuenta, dias_desde_ultima_actividad, frecuencia_total, valor_monetario_total,
            recency_score, frequency_score, monetary_score FROM scores"""


def _quintiles(d: Domain, **options) -> DataFrame:
    return rank.exact_ntile(
        d.metrics().select("id_cuenta", "dias_desde_ultima_actividad", "frecuencia_total",
                           "valor_monetario_total"), "id_cuenta", rfm.SCORES, **options)


simple("w9_quintiles", _quintiles, W9_SQL)
# Tasks that sort few rows: tiles are found in several rounds of counting.
simple("w9_quintiles_distributed", lambda d: _quintiles(d, sorted_rows=50), W9_SQL)


_ORDER_SQL = """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS importe,
    ntile(5) OVER (ORDER BY CAST(o_totalprice AS DECIMAL(12,2)) NULLS LAST, o_orderkey) AS quintil
    FROM orders"""


def _order_quintiles(d: Domain, **options) -> DataFrame:
    prices = d.read("orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("importe"))
    return rank.exact_ntile(prices, "o_orderkey", {"quintil": ("importe", "asc")}, **options)


simple("w9_order_quintiles", _order_quintiles, _ORDER_SQL)
simple("w9_order_quintiles_distributed", lambda d: _order_quintiles(d, sorted_rows=500), _ORDER_SQL)


# Sort and limit.

simple("so1_topk", lambda d: activation.crm_candidates(d.dim_cuentas, fixed.CRM_DEFAULT_LIMIT),
       "SELECT * FROM crm_all ORDER BY id_cuenta LIMIT 5")


# Data quality.

def _check_sql(check: str, table: str, column: str | None, metric: str, tail: str,
               detail: str = "NULL") -> str:
    col = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return f"""
SELECT '{check}' AS check_name, '{table}' AS table_name, {col} AS column_name,
       CAST({metric} AS BIGINT) AS metric,
       CASE WHEN {metric} = 0 THEN 'OK' ELSE 'WARNING' END AS status,
       CAST({detail} AS VARCHAR) AS detail {tail}"""


def _counts_sql(table: str, source: str, target: str) -> str:
    return _check_sql("row_count", table, None, "s - t",
                      f"FROM (SELECT (SELECT count(*) FROM {source}) AS s,"
                      f" (SELECT count(*) FROM {target}) AS t)", "s || ' -> ' || t")


def _duplicates_sql(check: str, table: str, key: str, where: str = "") -> str:
    return _check_sql(check, table, key, "count(*)",
                      f"FROM (SELECT {key} FROM {table} {where} GROUP BY {key} HAVING count(*) > 1)")


def _fk_sql(check: str, table: str, fk: str, parent: str, pk: str) -> str:
    return _check_sql(check, table, fk, "count(*)",
                      f"FROM {table} t LEFT JOIN {parent} p ON t.{fk} = p.{pk}"
                      f" WHERE t.{fk} IS NOT NULL AND p.{pk} IS NULL", f"'parent {parent}'")


def _broken_sql(check: str, table: str, column: str, broken: str) -> str:
    return _check_sql(check, table, column, f"count(*) FILTER (WHERE {broken})", f"FROM {table}")


def _freshness_sql(table: str, column: str, now: str, hours: int) -> str:
    return f"""
SELECT 'freshness' AS check_name, '{table}' AS table_name, '{column}' AS column_name,
       CAST(date_sub('second', newest, TIMESTAMP '{now}') AS BIGINT) AS metric,
       CASE WHEN newest <= TIMESTAMP '{now}'
             AND newest > TIMESTAMP '{now}' - INTERVAL {hours} HOUR
            THEN 'OK' ELSE 'WARNING' END AS status,
       CASE WHEN newest IS NULL THEN 'no timestamps'
            ELSE CASE WHEN newest > TIMESTAMP '{now}' THEN 'future: '
                      WHEN newest > TIMESTAMP '{now}' - INTERVAL {hours} HOUR THEN 'fresh: '
                      ELSE 'stale: ' END || strftime(newest, '%Y-%m-%d %H:%M:%S') END AS detail
FROM (SELECT max({column}) AS newest FROM {table})"""


def _stated_sql(check: str, table: str, status: str, detail: str) -> str:
    return f"""
SELECT '{check}' AS check_name, '{table}' AS table_name, CAST(NULL AS VARCHAR) AS column_name,
       CAST(NULL AS BIGINT) AS metric, '{status}' AS status, '{detail}' AS detail"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL BY NAME\n".join(parts)


simple("dq1_counts", lambda d: checks.check_counts(d.accounts, d.accounts_until(dm.FIRST_RUN), "accounts"),
       _counts_sql("accounts", "accounts", "accounts_first"))
simple("dq2_duplicates", lambda d: checks.check_duplicates(
    d.subscription_payments, "payment_id", "subscription_payments"),
       _duplicates_sql("duplicates", "subscription_payments", "payment_id"))
simple("dq2_duplicate_keys", lambda d: checks.duplicate_keys(d.subscription_payments, "payment_id"),
       """SELECT payment_id, count(*) AS filas FROM subscription_payments
          GROUP BY payment_id HAVING count(*) > 1""")
simple("dq3_foreign_key", lambda d: checks.check_fk(
    d.content_attributes, "content_id", d.contents, "content_id", "content_attributes", "contents"),
       _fk_sql("foreign_key", "content_attributes", "content_id", "contents", "content_id"))
simple("dq3_labels_documents", lambda d: checks.check_fk(
    d.read("labels"), "doc_id", d.read("documents"), "doc_id", "labels", "documents"),
       _fk_sql("foreign_key", "labels", "doc_id", "documents", "doc_id"))
simple("dq4_freshness", lambda d: checks.check_freshness(d.read("events"), "ts", NOW, "events"),
       _freshness_sql("events", "ts", NOW, 48))
simple("dq5_not_null", lambda d: checks.check_not_null(d.stg_contents, "id_cuenta", "stg_contents"),
       _broken_sql("not_null", "stg_contents", "id_cuenta", "id_cuenta IS NULL"))
simple("dq6_unique", lambda d: checks.check_unique(
    d.stg_subscription_payments, "id_pago", "stg_subscription_payments"),
       _duplicates_sql("unique", "stg_subscription_payments", "id_pago",
                       "WHERE id_pago IS NOT NULL"))
simple("dq7_relationships", lambda d: checks.check_fk(
    d.stg_contents, "id_cuenta", d.stg_accounts, "id_cuenta", "stg_contents", "stg_accounts",
    "relationships"),
       _fk_sql("relationships", "stg_contents", "id_cuenta", "stg_accounts", "id_cuenta"))
_TYPES = ", ".join(f"'{t}'" for t in fixed.CONTENT_TYPES)
simple("dq8_accepted_values", lambda d: checks.check_accepted(
    d.stg_contents, "tipo_contenido", fixed.CONTENT_TYPES, "stg_contents"),
       _broken_sql("accepted_values", "stg_contents", "tipo_contenido",
                   f"tipo_contenido NOT IN ({_TYPES})"))
_EMAIL = f"NOT regexp_matches(correo_electronico, '{fixed.EMAIL_PATTERN}')"
simple("dq9_email_format", lambda d: checks.check_format(
    d.stg_accounts, "correo_electronico", "stg_accounts"),
       _broken_sql("email_format", "stg_accounts", "correo_electronico", _EMAIL))
simple("dq10_minimum", lambda d: checks.check_min(
    d.read("customer"), "c_acctbal", 0, "customer"),
       _broken_sql("minimum", "customer", "c_acctbal", "c_acctbal < 0"))


def _run_sql() -> str:
    from abono.schemas import LOAD_RELATIONS, RAW_KEYS
    parts = []
    for t in fixed.RAW_TABLES:
        parts.append(_counts_sql(t, t, t))
        parts.append(_duplicates_sql("duplicates", t, RAW_KEYS[t]))
        if t not in LOAD_RELATIONS:
            parts.append(_stated_sql("foreign_key", t, "SKIP", "no relations"))
        for fk, parent in LOAD_RELATIONS.get(t, {}).items():
            parts.append(_fk_sql("foreign_key", t, fk, parent, RAW_KEYS[parent]))
        if t in ("accounts_subscription", "account_premium_features", "subscription_payments"):
            parts.append(_stated_sql("freshness", t, "SKIP", "no column updated_at"))
        else:
            parts.append(_freshness_sql(t, "updated_at", NOW, 48))
    return _union(parts)


simple("dq12_full_run", lambda d: quality.run_checks(d.spark, d, d, NOW), _run_sql())
simple("dq11_quality_report",
       lambda d: checks.quality_report(quality.run_checks(d.spark, d, d, NOW)),
       f"SELECT check_name, status, count(*) AS resultados FROM ({_run_sql()}) GROUP BY ALL")


def _declared_sql(declared: dict[str, quality.Declared]) -> str:
    parts = []
    names = {"fact_suscripciones_cuentas": "fact_suscripciones"}
    for name, want in declared.items():
        t = names.get(name, name)
        found = []
        for col in ([want.key] if want.key else []) + want.required:
            found.append(_broken_sql("not_null", t, col, f"{col} IS NULL"))
        for col, values in want.accepted.items():
            listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
            found.append(_broken_sql("accepted_values", t, col, f"{col} NOT IN ({listed})"))
        if want.key:
            found.append(_duplicates_sql("unique", t, want.key, f"WHERE {want.key} IS NOT NULL"))
        for fk, (parent, pk) in want.references.items():
            found.append(_fk_sql("relationships", t, fk, parent, pk))
        parts += [p.replace(f"'{t}' AS table_name", f"'{name}' AS table_name") for p in found]
    return _union(parts)


RAW = list(quality.RAW_CHECKS)
STAGING = list(quality.STAGING_CHECKS)
simple("dq_declared_raw",
       lambda d: quality.declared_checks({t: getattr(d, t) for t in RAW}, quality.RAW_CHECKS),
       _declared_sql(quality.RAW_CHECKS))
simple("dq_declared_staging",
       lambda d: quality.declared_checks(
           {t: getattr(d, t) for t in STAGING}, quality.STAGING_CHECKS),
       _declared_sql(quality.STAGING_CHECKS))


@query("dq_declared_marts", _declared_sql(quality.MART_CHECKS))
def _(d):
    marts = {
        "stg_accounts": d.stg_accounts,
        "dim_cuentas_base": d.dim_cuentas_base_stored,
        "dim_suscripciones": d.dim_suscripciones_stored,
        "dim_contenidos": materialize(d.dim_contenidos, "dim_contenidos"),
        "dim_cuentas": materialize(d.dim_cuentas, "dim_cuentas"),
        "fact_suscripciones_cuentas": materialize(d.fact_suscripciones_scored, "fact_subs"),
        "fact_rfm": materialize(d.fact_rfm_latest, "fact_rfm"),
    }
    return quality.declared_checks(marts, quality.MART_CHECKS)


simple("dq_staging_rules",
       lambda d: quality.staging_rules({t: getattr(d, t) for t in STAGING}, d.subscriptions, NOW),
       _union([
           _broken_sql("not_null", "stg_accounts", "id_cuenta", "id_cuenta IS NULL"),
           _broken_sql("email_format", "stg_accounts", "correo_electronico", _EMAIL),
           _freshness_sql("stg_accounts", "fecha_actualizacion", NOW, 24),
           _duplicates_sql("unique", "stg_subscriptions", "id_suscripcion",
                           "WHERE id_suscripcion IS NOT NULL"),
           _counts_sql("stg_subscriptions", "subscriptions", "stg_subscriptions"),
           _fk_sql("foreign_key", "stg_accounts_subscription", "id_cuenta", "stg_accounts",
                   "id_cuenta"),
           _broken_sql("accepted_values", "stg_contents", "tipo_contenido",
                       f"tipo_contenido NOT IN ({_TYPES})"),
           _broken_sql("minimum", "stg_subscription_payments", "monto", "monto < 0")]))


# History.

@query("scd1_snapshot_merge", "SELECT * FROM events_merged")
def _(d):
    before = d.events_log.filter(F.col("ts") < dm.moment(dm.EVENTS_FIRST))
    first = rank.newest_per_key(before, "user_id", "ts", ["event_id"])
    # Users whose last event is an error count as deleted at the second run.
    second = rank.newest_per_key(d.events_log, "user_id", "ts", ["event_id"]).filter(
        F.col("event_type") != "error")
    return history.snapshot_merge(
        history.new_versions(first, "user_id", "ts"), second, "user_id", "ts", dm.EVENTS_SECOND)


@query("scd1_snapshot_store", "SELECT * FROM events_merged")
def _(d):
    path = scratch(d, "scd1")
    before = d.events_log.filter(F.col("ts") < dm.moment(dm.EVENTS_FIRST))
    for log, keep, run_ts in ((before, F.lit(True), dm.EVENTS_FIRST),
                              (d.events_log, F.col("event_type") != "error", dm.EVENTS_SECOND)):
        source = rank.newest_per_key(log, "user_id", "ts", ["event_id"]).filter(keep)
        stored = versions.load_snapshot(source, path, "user_id", "ts", run_ts)
    return stored


simple("scd1_accounts_snapshot", lambda d: d.accounts_snapshot, "SELECT * FROM accounts_snapshot")
simple("scd2_versions",
       lambda d: history.versions_from_history(d.events_log, "user_id", "ts", "event_id"),
       "SELECT * FROM events_versions")


@query("scd3_dimension", """
SELECT dbt_scd_id AS id_dim_usuario, user_id, ts, event_id, event_type, value,
       CAST(dbt_valid_from AS DATE) AS valido_desde,
       CAST(coalesce(CAST(dbt_valid_to AS DATE) - 1, DATE '9999-12-31') AS DATE) AS valido_hasta,
       dbt_valid_to IS NULL AS es_actual
FROM events_versions QUALIFY row_number() OVER (
    PARTITION BY user_id, CAST(dbt_valid_from AS DATE) ORDER BY dbt_valid_from DESC) = 1""")
def _(d):
    return history.scd2_dimension(
        history.versions_from_history(d.events_log, "user_id", "ts", "event_id"),
        "user_id", "id_dim_usuario", created="ts")


simple("scd3_dim_cuentas_base", lambda d: d.dim_cuentas_base, "SELECT * FROM dim_cuentas_base")
simple("scd3_dim_suscripciones", lambda d: d.dim_suscripciones, "SELECT * FROM dim_suscripciones")
simple("scd3_dim_contenidos", lambda d: d.dim_contenidos, "SELECT * FROM dim_contenidos")
simple("scd4_dim_cuentas", lambda d: d.dim_cuentas, "SELECT * FROM dim_cuentas")


@query("scd4_kept_segments", "SELECT * FROM dim_cuentas")
def _(d):
    """Segments stored after the earlier date, and brought up to date by the later one alone."""
    path = scratch(d, "scd4")
    kept = versions.load_buckets(dimensions.newest_segments(d.fact_rfm(EARLIER)), path, "id_dim_cuenta")
    kept = versions.load_upsert(dimensions.merged_segments(kept, d.fact_rfm_latest), path, "id_dim_cuenta")
    return dimensions.with_segments(d.dim_cuentas_base_stored, kept)




# Lifecycle and scoring.

simple("sub1_lifecycle", lambda d: d.fact_suscripciones, "SELECT * FROM fact_suscripciones")
simple("rfm1_universe", lambda d: d.universe(), "SELECT * FROM universe")
simple("rfm2_recency",
       lambda d: rfm.rfm_recency(rfm.rfm_base(d.universe(), d.activity()), AS_OF).select(
           "id_cuenta", "ultima_actividad", "dias_desde_ultima_actividad"),
       "SELECT id_cuenta, ultima_actividad, dias_desde_ultima_actividad FROM metrics")
simple("rfm3_frequency",
       lambda d: rfm.rfm_frequency(rfm.rfm_base(d.universe(), d.activity())).select(
           "id_cuenta", "total_contenidos_creados", "total_pagos_realizados",
           "total_features_compradas", "frecuencia_total"),
       """SELECT id_cuenta, total_contenidos_creados, total_pagos_realizados,
                 total_features_compradas, frecuencia_total FROM metrics""")
simple("rfm4_monetary",
       lambda d: rfm.rfm_monetary(rfm.rfm_base(d.universe(), d.activity())).select(
           "id_cuenta", "total_pagado_suscripciones", "total_pagado_features",
           "valor_monetario_total"),
       """SELECT id_cuenta, total_pagado_suscripciones, total_pagado_features,
                 valor_monetario_total FROM metrics""")
simple("rfm5_scores",
       lambda d: rfm.rfm_scores(d.metrics()).select("id_cuenta", *rfm.SCORES),
       "SELECT id_cuenta, recency_score, frequency_score, monetary_score FROM scores")
simple("rfm6_segments",
       lambda d: d.fact_rfm().groupBy("rfm_score", "segmento_rfm").agg(
           F.count("*").alias("cuentas")),
       """SELECT rfm_score, segmento_rfm, count(*) AS cuentas FROM fact_rfm
          GROUP BY rfm_score, segmento_rfm""")
simple("rfm7_fact", lambda d: d.fact_rfm(), "SELECT * FROM fact_rfm")
simple("rfm7_fact_elapsed_days", lambda d: d.fact_rfm(day_mode="elapsed"), "SELECT * FROM fact_rfm")


# Report, activation, serving.

simple("rpt1_enterprise",
       lambda d: report.enterprise_report(d.accounts, d.subscriptions, d.accounts_subscription),
       "SELECT * FROM report")


@query("rpt2_report_job", "SELECT * FROM report")
def _(d):
    out = scratch(d, "rpt2")
    report.run_report(d.spark, d, out, AS_OF)
    schema = report.enterprise_report(*sources.extract_report_inputs(d.spark, d)).schema
    return sources.read_csv(d.spark, f"{out}/{reports.report_name(AS_OF)}", schema)


simple("crm1_candidates", lambda d: activation.crm_candidates(d.dim_cuentas), "SELECT * FROM crm_all")
simple("crm2_match",
       lambda d: activation.crm_match(activation.crm_candidates(d.dim_cuentas), d.companies),
       "SELECT * FROM crm_matched")
simple("crm2_match_repeated_keys",
       lambda d: activation.crm_match(
           activation.crm_candidates(d.dim_cuentas),
           d.companies.unionByName(d.companies.withColumn("company_id", F.concat(F.lit("x"), "company_id")))),
       "SELECT * FROM crm_matched")
simple("crm3_payload",
       lambda d: activation.crm_payload(
           activation.crm_match(activation.crm_candidates(d.dim_cuentas), d.companies)),
       """SELECT company_id, '{"properties":{"segmento_rfm":"' || segmento_rfm_ultimo || '"}}'
                 AS payload FROM crm_matched WHERE encontrada""")
simple("crm4_summary",
       lambda d: activation.crm_summary(
           activation.crm_match(activation.crm_candidates(d.dim_cuentas), d.companies)),
       """SELECT CAST(count(*) FILTER (WHERE encontrada) AS BIGINT) AS encontradas,
                 CAST(count(*) FILTER (WHERE NOT encontrada) AS BIGINT) AS no_encontradas,
                 CAST(count(*) AS BIGINT) AS total,
                 round(count(*) FILTER (WHERE encontrada) * 100.0 / count(*), 1)
                     AS tasa_coincidencia
          FROM crm_matched""")
_TEXTS = ", ".join("('{}', '{}', '{}')".format(*s) for s in fixed.SEGMENTS)
simple("sv1_catalog", lambda d: serving.with_segment_text(d.fact_rfm()),
       f"""SELECT f.*, c.descripcion, c.caracteristicas FROM fact_rfm f
           LEFT JOIN (VALUES {_TEXTS}) c(segmento, descripcion, caracteristicas)
           ON f.segmento_rfm = c.segmento""")
_WANTED = "SELECT DISTINCT user_id AS id_cuenta FROM events"


def _wanted(d: Domain) -> DataFrame:
    return d.read("events").select(F.col("user_id").alias("id_cuenta"))


simple("sv2_lookup", lambda d: serving.customer_rfm(d.dim_cuentas, _wanted(d)),
       f"""SELECT id_cuenta, correo_electronico AS email, nombre_cuenta AS nombre,
                  segmento_rfm_ultimo, CAST(fecha_rfm_ultimo AS VARCHAR) AS fecha_rfm_ultimo,
                  segmento_rfm_anterior, CAST(fecha_rfm_anterior AS VARCHAR) AS fecha_rfm_anterior
           FROM dim_cuentas WHERE es_actual AND id_cuenta IN ({_WANTED})""")
simple("sv2_not_found",
       lambda d: serving.customers_not_found(
           d.dim_cuentas, d.read("orders").select(F.col("o_orderkey").alias("id_cuenta"))),
       """SELECT o_orderkey AS id_cuenta FROM orders WHERE o_orderkey NOT IN
          (SELECT id_cuenta FROM dim_cuentas WHERE es_actual)""")


@query("rfm1_recency_elapsed_hours", f"""SELECT o_orderkey AS id_cuenta,
       CAST(date_diff('second', CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INTEGER)),
            TIMESTAMP '{AS_OF}') // 86400 AS BIGINT) AS dias_desde_ultima_actividad
    FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '{AS_OF}' - 1""")
def _(d):
    """Elapsed days where activities have an hour."""
    last = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("o_orderkey") % 24)
    base = (d.read("orders").filter(F.col("o_orderdate").cast("date") < F.date_sub(F.lit(AS_OF).cast("date"), 1))
            .select(F.col("o_orderkey").alias("id_cuenta"), last.alias("last")))
    return rfm.rfm_recency(base, AS_OF, "elapsed").select("id_cuenta", "dias_desde_ultima_actividad")


# Jobs.

@query("job1_daily", "SELECT b.*, 'Sin segmentación' AS segmento_rfm_ultimo,"
       " DATE '1900-01-01' AS fecha_rfm_ultimo, 'Sin segmentación' AS segmento_rfm_anterior,"
       " DATE '1900-01-01' AS fecha_rfm_anterior FROM dim_cuentas_once b")
def _(d):
    lake = jobs.Lake(scratch(d, "job1"), "dev")
    jobs.run_daily(d.spark, jobs.JobConfig(d, lake, strict=False), AS_OF, dm.SECOND_RUN)
    return lake.read(d.spark, "analytics", "dim_cuentas")


@query("job3_full", "SELECT * FROM fact_rfm_once")
def _(d):
    lake = jobs.Lake(scratch(d, "job3"), "dev")
    jobs.run_full(d.spark, jobs.JobConfig(d, lake, strict=False), AS_OF, dm.SECOND_RUN)
    return lake.read(d.spark, "analytics", "fact_rfm")
