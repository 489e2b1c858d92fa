"""Full validation runs over raw tables, and the declared checks of every layer."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from abono import fixed
from abono.operators import checks as c
from abono.schemas import LOAD_RELATIONS, RAW_KEYS


def run_checks(spark: SparkSession, source, target, now, tables: list[str] | None = None,
               keys: dict[str, str] | None = None,
               relations: dict[str, dict[str, str]] | None = None,
               hours: int = fixed.FRESHNESS_HOURS) -> DataFrame:
    """Counts, duplicates, foreign keys and freshness of loaded tables, as one result
    table. `source` and `target` hand out tables by name; a target that can name the facts its loads
    observed (`facts`) is not read for counts and freshness. Checks are evaluated here: keys and
    references of all tables in one job, counts and freshness of each in another. Where a job
    fails, its checks are tried again one by one; one whose tables cannot be read, or fail while
    being read, is reported as ERROR with the whole message, and all others count. A check is a
    handful of rows."""
    keys = RAW_KEYS if keys is None else keys
    relations = LOAD_RELATIONS if relations is None else relations

    def checks_of(name: str):
        """(check, column, what builds its result) of one table."""
        key = keys.get(name)
        yield "row_count", None, lambda: c.check_counts(
            source.table(spark, name), target.table(spark, name), name)
        yield "duplicates", key, lambda: c.check_duplicates(target.table(spark, name), key, name)
        if name not in relations:
            yield "foreign_key", None, lambda: c.stated(
                spark, "foreign_key", name, None, c.SKIP, "no relations")
        for fk, parent in relations.get(name, {}).items():
            yield "foreign_key", fk, lambda fk=fk, parent=parent: c.check_fk(
                target.table(spark, name), fk, target.table(spark, parent),
                keys.get(parent, "id"), name, parent)
        yield "freshness", "updated_at", lambda: c.check_freshness(
            target.table(spark, name), "updated_at", now, name, hours)

    def together(names: list[str]) -> list:
        """Everything about the keys, of all tables at once."""
        parents = {p for n in names for p in relations.get(n, {}).values()}
        frames = {n: target.table(spark, n) for n in {*names, *parents}}
        wanted = {n: c.Wanted(
            duplicates=[keys[n]] if keys.get(n) else [],
            references=[c.Reference(fk, p, keys.get(p, "id")) for fk, p in relations.get(n, {}).items()]) for n in names}
        return c.fused(frames, wanted).collect()

    def loaded(name: str) -> list:
        observed = getattr(target, "facts", lambda *_: None)(spark, name, "updated_at")
        if observed is not None:
            return c.check_observed(source.table(spark, name), observed.rows, observed.newest, "updated_at", now, name, hours).collect()
        return c.check_loaded(source.table(spark, name), target.table(spark, name), "updated_at", now, name, hours).collect()

    def tried(build):
        """Rows, or None if something failed."""
        try:
            return build()
        except (PySparkException, KeyError):
            return None

    names = tables or list(fixed.RAW_TABLES)
    of_keys = tried(lambda: together(names))
    rows = of_keys or []
    for name in names:
        of_load = tried(lambda: loaded(name))
        rows += of_load or []
        done = ({"row_count", "freshness"} if of_load is not None else set()) | (
            {"duplicates", "foreign_key"} if of_keys is not None else set())
        for check, column, build in checks_of(name):
            known = (check == "foreign_key" and name not in relations) or (check == "duplicates" and not column)
            if check in done and not known:
                continue
            try:
                rows += build().collect()
            except (PySparkException, KeyError) as e:
                rows.append((check, name, column, 0, c.ERROR, str(e)))
    return spark.createDataFrame(rows, c.RESULT)


@dataclass(frozen=True)
class Declared:
    """What a table must satisfy. The key is unique and not null; references are checked
    against the named parent, and not null where they are `required`."""

    key: str | None = None
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    required: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)


# Declared checks: fixed values. References read {column: (parent table, parent column)}.
RAW_CHECKS = {
    "accounts": Declared("account_id"),
    "subscriptions": Declared("subscription_id"),
    "accounts_subscription": Declared(
        "account_subscription_id",
        {"account_id": ("accounts", "account_id"),
         "subscription_id": ("subscriptions", "subscription_id")},
        ["account_id", "subscription_id"]),
    "contents": Declared("content_id", {"account_id": ("accounts", "account_id")}, ["account_id"]),
    "content_attributes": Declared(
        None, {"content_id": ("contents", "content_id")}, ["content_id"]),
    "subscription_payments": Declared(
        "payment_id",
        {"account_subscription_id": ("accounts_subscription", "account_subscription_id")},
        ["account_subscription_id"]),
    "premium_features": Declared("feature_id"),
    "account_premium_features": Declared(
        "account_feature_id",
        {"account_id": ("accounts", "account_id"), "feature_id": ("premium_features", "feature_id")},
        ["account_id", "feature_id"]),
}

STAGING_CHECKS = {
    "stg_accounts": Declared("id_cuenta"),
    "stg_subscriptions": Declared("id_suscripcion"),
    "stg_accounts_subscription": Declared(
        "id_suscripcion_cuenta",
        {"id_cuenta": ("stg_accounts", "id_cuenta"),
         "id_suscripcion": ("stg_subscriptions", "id_suscripcion")},
        ["id_cuenta", "id_suscripcion"]),
    "stg_contents": Declared("id_contenido", {"id_cuenta": ("stg_accounts", "id_cuenta")},
                             ["id_cuenta"]),
    "stg_subscription_payments": Declared(
        "id_pago",
        {"id_suscripcion_cuenta": ("stg_accounts_subscription", "id_suscripcion_cuenta")},
        ["id_suscripcion_cuenta"]),
    "stg_premium_features": Declared("id_feature"),
    "stg_account_premium_features": Declared(
        "id_cuenta_feature",
        {"id_cuenta": ("stg_accounts", "id_cuenta"),
         "id_feature": ("stg_premium_features", "id_feature")},
        ["id_cuenta", "id_feature"]),
}

MART_CHECKS = {
    "dim_cuentas_base": Declared(
        "id_dim_cuenta", required=["id_cuenta", "valido_desde", "valido_hasta"]),
    "dim_cuentas": Declared(
        "id_dim_cuenta", required=["id_cuenta", "valido_desde", "valido_hasta"]),
    "dim_suscripciones": Declared(
        "id_dim_suscripcion", required=["id_suscripcion", "valido_desde", "valido_hasta"]),
    "dim_contenidos": Declared(
        "id_dim_contenido", {"id_cuenta": ("stg_accounts", "id_cuenta")},
        ["id_contenido", "id_cuenta", "valido_desde", "valido_hasta"]),
    "fact_suscripciones_cuentas": Declared(
        None,
        {"id_dim_cuenta": ("dim_cuentas_base", "id_dim_cuenta"),
         "id_dim_suscripcion": ("dim_suscripciones", "id_dim_suscripcion")},
        ["id_dim_cuenta", "id_dim_suscripcion", "fecha_inicio"],
        {"tipo_cambio": [fixed.NEW_SUBSCRIPTION, fixed.UPGRADE, fixed.DOWNGRADE,
                         fixed.SAME_SUBSCRIPTION]}),
    "fact_rfm": Declared(
        None, {"id_dim_cuenta": ("dim_cuentas_base", "id_dim_cuenta")},
        ["id_dim_cuenta", "id_dim_fecha_rfm"],
        {"recency_score": [1, 2, 3, 4, 5], "frequency_score": [1, 2, 3, 4, 5],
         "monetary_score": [1, 2, 3, 4, 5], "segmento_rfm": [s[0] for s in fixed.SEGMENTS]}),
}


def wanted_of(want: Declared) -> c.Wanted:
    rules = [c.not_null(col) for col in ([want.key] if want.key else []) + want.required]
    rules += [c.accepted(col, values) for col, values in want.accepted.items()]
    references = [c.Reference(fk, parent, pk, "relationships") for fk, (parent, pk) in want.references.items()]
    return c.Wanted(rules, [want.key] if want.key else [], [], references)


def declared_checks(tables: dict[str, DataFrame], declared: dict[str, Declared]) -> DataFrame:
    """Results of all declared checks: one scan per table, and one shuffle for all."""
    return c.fused(tables, {name: wanted_of(want) for name, want in declared.items()})


def staging_rules(tables: dict[str, DataFrame], raw_subscriptions: DataFrame, now) -> DataFrame:
    """The further staging checks: formats, ranges, accepted types, daily freshness."""
    acc, subs = tables["stg_accounts"], tables["stg_subscriptions"]
    return c.union_results([
        c.check_rules(acc, [c.not_null("id_cuenta"), c.email_format("correo_electronico")],
                      "stg_accounts"),
        c.check_freshness(acc, "fecha_actualizacion", now, "stg_accounts", hours=24),
        c.check_unique(subs, "id_suscripcion", "stg_subscriptions"),
        c.check_counts(raw_subscriptions, subs, "stg_subscriptions"),
        c.check_fk(tables["stg_accounts_subscription"], "id_cuenta", acc, "id_cuenta",
                   "stg_accounts_subscription", "stg_accounts"),
        c.check_accepted(tables["stg_contents"], "tipo_contenido", fixed.CONTENT_TYPES,
                         "stg_contents"),
        c.check_min(tables["stg_subscription_payments"], "monto", 0,
                    "stg_subscription_payments"),
    ])
