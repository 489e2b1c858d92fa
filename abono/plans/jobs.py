"""The daily, scoring and half-year jobs over a lake of Parquet folders."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from abono import fixed
from abono.operators.checks import ERROR, WARNING
from abono.operators.history import new_versions
from abono.plans import dimensions, lifecycle, quality, rfm, staging
from abono.schemas import MONEY, RAW_KEYS
from abono.sinks import versions
from abono.sinks.facts import Facts
from abono.sources.tables import read_tables, schema_name

RAW, STAGING, SNAPSHOTS, ANALYTICS = "raw", "staging", "snapshots", "analytics"

# The two newest segments of each account version, and the dates of scores they rest on.
SEGMENTS, SEGMENT_DATES = "ultimos_segmentos", "ultimos_segmentos_fechas"

# Snapshotted staging tables: name -> (source, key).
SNAPSHOT_SOURCES = {
    "accounts_snapshot": ("stg_accounts", "id_cuenta"),
    "contents_snapshot": ("stg_contents", "id_contenido"),
    "subscriptions_snapshot": ("stg_subscriptions", "id_suscripcion"),
}
FACT_RFM_SCHEMA = (
    "id_dim_cuenta string, ultima_actividad timestamp_ntz, dias_desde_ultima_actividad bigint,"
    " total_contenidos_creados bigint, total_pagos_realizados bigint,"
    f" total_features_compradas bigint, frecuencia_total bigint,"
    f" total_pagado_suscripciones {MONEY}, total_pagado_features {MONEY},"
    f" valor_monetario_total {MONEY}, recency_score bigint, frequency_score bigint,"
    " monetary_score bigint, rfm_score string, segmento_rfm string, id_dim_fecha_rfm date")


class ChecksFailed(RuntimeError):
    """Some declared checks did not hold; the job stopped before the next step."""

    def __init__(self, step: str, rows):
        self.step, self.rows = step, rows
        super().__init__(f"{step}: " + "; ".join(
            f"{r.check_name} {r.table_name}.{r.column_name}={r.metric}" for r in rows))


@dataclass(frozen=True)
class Lake:
    """Folders <root>/<layer>_<env>/<table>."""

    root: str
    env: str = "dev"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{schema_name(layer, self.env)}/{name}"

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        if name == "fact_rfm":
            return versions.read_fact_rfm(spark, self.path(layer, name), FACT_RFM_SCHEMA)
        found = self.maybe(spark, layer, name)
        if found is None:
            raise KeyError(f"{layer}.{name} was never loaded")
        return found

    def maybe(self, spark: SparkSession, layer: str, name: str) -> DataFrame | None:
        if layer != SNAPSHOTS:
            return versions.read_current(spark, self.path(layer, name))
        source, key = SNAPSHOT_SOURCES[name]
        staged = self.read(spark, STAGING, source)
        return versions.read_snapshot(
            spark, self.path(layer, name), new_versions(staged, key, "fecha_actualizacion").schema)


@dataclass(frozen=True)
class LayerSource:
    """One layer of a lake as a source of tables."""

    lake: Lake
    layer: str

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return self.lake.read(spark, self.layer, name)


@dataclass(frozen=True)
class JobConfig:
    """source hands out raw tables by name. strict stops a job at the first step whose
    declared checks find anything. raw_catalog names a catalog with row-level writes: raw tables
    are then merged there, in <raw_catalog>.<schema>.<table>, instead of in folders. buckets is the
    number that merged tables are first laid out in."""

    source: object
    lake: Lake
    strict: bool = True
    tables: list[str] | None = None
    full_refresh: dict[str, bool] = field(default_factory=dict)
    keys: dict[str, str] = field(default_factory=lambda: dict(RAW_KEYS))
    raw_catalog: str | None = None
    buckets: int | None = None

    def raw_table(self, name: str) -> str:
        return f"{self.raw_catalog}.{schema_name(RAW, self.lake.env)}.{name}"

    def raw(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(self.raw_table(name)) if self.raw_catalog else self.lake.read(spark, RAW, name)


@dataclass(frozen=True)
class RawSource:
    """Raw tables where a job's configuration has them."""

    cfg: JobConfig

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return self.cfg.raw(spark, name)

    def facts(self, spark: SparkSession, name: str, cursor: str) -> Facts | None:
        """What the loads observed; a catalog's tables have nothing of the kind."""
        return None if self.cfg.raw_catalog else versions.loaded_facts(spark, self.cfg.lake.path(RAW, name), cursor)


def run_load(spark: SparkSession, cfg: JobConfig) -> None:
    for name, df in read_tables(spark, cfg.source, cfg.tables).items():
        mode = cfg.keys[name], fixed.RAW_TABLES[name], cfg.full_refresh.get(name, False)
        if cfg.raw_catalog:
            versions.load_catalog_table(df, cfg.raw_table(name), *mode)
        else:
            versions.load_table(df, cfg.lake.path(RAW, name), *mode, buckets=cfg.buckets)


def run_validation(spark: SparkSession, cfg: JobConfig, now) -> DataFrame:
    """Loaded tables against their source, without loading anything."""
    return quality.run_checks(spark, cfg.source, RawSource(cfg), now, cfg.tables,
                              cfg.keys)


def _require(results: DataFrame, step: str, strict: bool) -> None:
    """Only the failing result rows, at most one per check, reach the driver."""
    bad = results.filter(F.col("status").isin(WARNING, ERROR)).collect()
    if bad and strict:
        raise ChecksFailed(step, bad)


def run_staging(spark: SparkSession, cfg: JobConfig) -> None:
    def raw(name):
        return cfg.raw(spark, name)

    def target(name):
        return cfg.lake.maybe(spark, STAGING, name)

    built = {
        "stg_accounts": staging.stg_accounts(raw("accounts"), target("stg_accounts")),
        "stg_subscriptions": staging.stg_subscriptions(raw("subscriptions")),
        "stg_accounts_subscription": staging.stg_accounts_subscription(
            raw("accounts_subscription")),
        "stg_contents": staging.stg_contents(
            raw("contents"), raw("content_attributes"), target("stg_contents")),
        "stg_subscription_payments": staging.stg_subscription_payments(
            raw("subscription_payments"), target("stg_subscription_payments")),
        "stg_premium_features": staging.stg_premium_features(raw("premium_features")),
        "stg_account_premium_features": staging.stg_account_premium_features(
            raw("account_premium_features")),
    }
    for name, df in built.items():
        path = cfg.lake.path(STAGING, name)
        if name in staging.GROWING_KEYS:
            versions.load_append(df, path)
        elif name in staging.INCREMENTAL_KEYS:
            versions.load_upsert(df, path, staging.INCREMENTAL_KEYS[name], buckets=cfg.buckets)
        else:
            versions.load_replace(df, path)


def run_snapshots(spark: SparkSession, cfg: JobConfig, run_ts) -> None:
    for name, (source, key) in SNAPSHOT_SOURCES.items():
        versions.load_snapshot(
            cfg.lake.read(spark, STAGING, source), cfg.lake.path(SNAPSHOTS, name),
            key, "fecha_actualizacion", run_ts)


def _accounts_base(spark: SparkSession, lake: Lake, anew: bool = False) -> DataFrame:
    """Account versions, stored once per daily run and read by the steps after it."""
    found = None if anew else lake.maybe(spark, ANALYTICS, "dim_cuentas_base")
    if found is not None:
        return found
    base = dimensions.dim_cuentas_base(lake.read(spark, SNAPSHOTS, "accounts_snapshot"))
    return versions.load_replace(base, lake.path(ANALYTICS, "dim_cuentas_base"))


def _keep_segments(spark: SparkSession, cfg: JobConfig, date) -> None:
    """Bring the stored last and previous segments up to date with the scores of one date. The
    first time, and after a run that failed between the scores and this, all scores are read: the
    dates that the segments rest on are stored beside them."""
    lake, path = cfg.lake, cfg.lake.path(ANALYTICS, SEGMENTS)
    scores_path = lake.path(ANALYTICS, "fact_rfm")
    dates = set(versions.fact_dates(spark, scores_path))
    known = lake.maybe(spark, ANALYTICS, SEGMENT_DATES)
    kept = lake.maybe(spark, ANALYTICS, SEGMENTS)
    seen = {r.fecha for r in known.collect()} if known is not None else set()
    if kept is None or dates - {str(date)} - seen:
        fresh = dimensions.newest_segments(lake.read(spark, ANALYTICS, "fact_rfm"))
        versions.load_buckets(fresh, path, "id_dim_cuenta", buckets=cfg.buckets)
    else:
        scores = versions.read_fact_date(spark, scores_path, date)
        if scores is not None:
            versions.load_upsert(dimensions.merged_segments(kept, scores), path, "id_dim_cuenta")
    done = spark.createDataFrame([(d,) for d in sorted(dates)], "fecha string")
    versions.load_replace(done.coalesce(1), lake.path(ANALYTICS, SEGMENT_DATES))


def refresh_dim_cuentas(spark: SparkSession, cfg: JobConfig) -> None:
    """dim_cuentas from the stored segments; where a date of scores is missing there, from all scores."""
    lake = cfg.lake
    kept, known = lake.maybe(spark, ANALYTICS, SEGMENTS), lake.maybe(spark, ANALYTICS, SEGMENT_DATES)
    seen = {r.fecha for r in known.collect()} if known is not None else set()
    if kept is None or set(versions.fact_dates(spark, lake.path(ANALYTICS, "fact_rfm"))) - seen:
        kept = dimensions.newest_segments(lake.read(spark, ANALYTICS, "fact_rfm"))
    dim = dimensions.with_segments(_accounts_base(spark, lake), kept)
    versions.load_replace(dim, lake.path(ANALYTICS, "dim_cuentas"))


def run_marts(spark: SparkSession, cfg: JobConfig, as_of) -> None:
    """All marts but fact_rfm; dim_cuentas shows the scores stored so far."""
    lake = cfg.lake
    plans = versions.load_replace(
        dimensions.dim_suscripciones(lake.read(spark, SNAPSHOTS, "subscriptions_snapshot")),
        lake.path(ANALYTICS, "dim_suscripciones"))
    versions.load_replace(
        dimensions.dim_contenidos(lake.read(spark, SNAPSHOTS, "contents_snapshot")),
        lake.path(ANALYTICS, "dim_contenidos"))
    versions.load_replace(
        lifecycle.fact_suscripciones(
            lake.read(spark, STAGING, "stg_accounts_subscription"),
            _accounts_base(spark, lake, anew=True), plans, as_of),
        lake.path(ANALYTICS, "fact_suscripciones_cuentas"))
    refresh_dim_cuentas(spark, cfg)


def run_daily(spark: SparkSession, cfg: JobConfig, as_of, run_ts) -> None:
    """Load, check sources, stage, check staging, snapshot, build marts."""
    run_load(spark, cfg)
    raw = {n: cfg.raw(spark, n) for n in quality.RAW_CHECKS}
    _require(quality.declared_checks(raw, quality.RAW_CHECKS), "source checks", cfg.strict)
    run_staging(spark, cfg)
    staged = {n: cfg.lake.read(spark, STAGING, n) for n in quality.STAGING_CHECKS}
    _require(quality.declared_checks(staged, quality.STAGING_CHECKS), "staging checks", cfg.strict)
    run_snapshots(spark, cfg, run_ts)
    run_marts(spark, cfg, as_of)


def run_rfm(spark: SparkSession, cfg: JobConfig, as_of) -> DataFrame:
    """Score one date and upsert it."""
    lake = cfg.lake
    fact = rfm.fact_rfm(
        _accounts_base(spark, lake),
        lake.read(spark, ANALYTICS, "fact_suscripciones_cuentas"),
        lake.read(spark, ANALYTICS, "dim_suscripciones"),
        lake.read(spark, STAGING, "stg_contents"),
        lake.read(spark, STAGING, "stg_subscription_payments"),
        lake.read(spark, STAGING, "stg_accounts_subscription"),
        lake.read(spark, STAGING, "stg_account_premium_features"), as_of)
    written = versions.write_fact_rfm(fact, lake.path(ANALYTICS, "fact_rfm"))
    _keep_segments(spark, cfg, str(as_of)[:10])
    return written


def run_full(spark: SparkSession, cfg: JobConfig, as_of, run_ts, refresh_dim: bool = False) -> None:
    """Daily job, then scoring. dim_cuentas keeps trailing by one run unless refreshed."""
    run_daily(spark, cfg, as_of, run_ts)
    run_rfm(spark, cfg, as_of)
    if refresh_dim:
        refresh_dim_cuentas(spark, cfg)
