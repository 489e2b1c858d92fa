import json

from pyspark.sql import functions as F

from abono import fixed
from abono.functions import as_date, as_ts, is_email, months_before, valid_at
from abono.plans import activation, lifecycle, report, serving, staging
from abono.sources.tables import FrameSource
from tests.conftest import day, rows, ts

CONTENTS = ("content_id int, account_id int, title string, description string,"
            " content_type string, created_at timestamp_ntz, updated_at timestamp_ntz")
ATTRS = ("content_id int, attribute_name string, string_value string,"
         " decimal_value decimal(18,3), created_at timestamp_ntz, updated_at timestamp_ntz")


def test_stg_contents_both_sides_and_defaults(frame):
    contents = frame([(1, 7, None, None, None, "2024-01-01", "2024-01-02"),
                      (2, 7, "t", "d", "quiz", "2024-01-01", "2024-01-02")], CONTENTS)
    attrs = frame([(1, "Categoría", "A", None, "2024-01-03", "2024-01-04"),
                   (1, "Categoría", "B", None, "2024-01-02", "2024-01-05"),
                   (1, "Duración", None, "2.500", "2024-01-01", "2024-01-01"),
                   (1, "Otro", "zz", "9.000", "2024-01-01", "2024-01-01"),
                   (3, "Duración", None, "1.000", "2024-02-01", "2024-02-02")], ATTRS)
    out = staging.stg_contents(contents, attrs)
    got = {r["id_contenido"]: r for r in out.collect()}
    assert tuple(got[1])[1:6] == (7, fixed.NO_TITLE, fixed.NO_DESCRIPTION, fixed.NO_TYPE, "B")
    assert (str(got[1]["duracion"]), got[1]["fecha_creacion"], got[1]["fecha_actualizacion"]) == (
        "2.500", ts("2024-01-03"), ts("2024-01-05"))
    assert got[2]["fecha_actualizacion"] == ts("2024-01-02") and got[2]["categoria"] is None
    assert got[3]["id_cuenta"] is None and got[3]["titulo"] == fixed.NO_TITLE
    strict = staging.stg_contents(contents, attrs, strict_nulls=True)
    assert {r["id_contenido"]: r["fecha_actualizacion"] for r in strict.collect()} == {
        1: ts("2024-01-05"), 2: None, 3: None}
    later = staging.stg_contents(contents, attrs, target=out.filter("id_contenido = 2"))
    assert rows(later, "id_contenido") == [(1,), (3,)]


def test_incremental_staging(frame):
    raw = frame([(1, "a", "e", "2024-01-01", "2024-01-01"), (2, "b", "e", "2024-01-01", "2024-01-03"),
                 (3, "c", "e", "2024-01-01", None)],
                "account_id int, account_name string, email string, created_at timestamp_ntz,"
                " updated_at timestamp_ntz")
    all_rows = staging.stg_accounts(raw)
    target = all_rows.filter("id_cuenta = 2")
    assert staging.stg_accounts(raw, target).isEmpty()
    assert rows(staging.stg_accounts(raw, target, inclusive=True), "id_cuenta") == [(2,)]
    assert staging.stg_accounts(raw, target.limit(0)).count() == 3  # empty target loads all
    assert all_rows.columns == ["id_cuenta", "nombre_cuenta", "correo_electronico",
                                "fecha_creacion", "fecha_actualizacion"]


def test_lifecycle_rules(frame):
    periods = frame([
        (10, 1, 2, "2023-01-01", "2023-02-01"), (11, 1, 3, "2023-02-01", "2023-03-01"),
        (12, 1, 1, "2023-03-01", "2023-04-01"), (13, 1, 1, "2023-04-01", "2023-05-01"),
        (20, 2, 5, "2023-06-01", None)],
        "id_suscripcion_cuenta int, id_cuenta int, id_suscripcion int, fecha_inicio date,"
        " fecha_fin date")
    out = lifecycle.lifecycle_periods(periods, "2023-06-11")
    got = {r["id_suscripcion_cuenta"]: r for r in out.collect()}
    assert [got[i]["tipo_cambio"] for i in (10, 11, 12, 13, 20)] == [
        fixed.NEW_SUBSCRIPTION, fixed.UPGRADE, fixed.DOWNGRADE, fixed.SAME_SUBSCRIPTION,
        fixed.NEW_SUBSCRIPTION]
    assert got[20]["duracion_dias"] == 10 and got[20]["fecha_churn"] is None
    assert [got[i]["fecha_churn"] for i in (10, 11, 12)] == [None] * 3
    last = got[13]
    assert (last["fecha_churn"], last["dias_desde_cambio_anterior"],
            last["dias_desde_inicio_cuenta"]) == (day("2023-05-01"), 61, 120)


def test_fact_resolves_versions_at_the_start(frame):
    periods = frame([(10, 1, 2, "2023-01-15", "2023-02-01"), (11, 1, 3, "2023-02-15", None),
                     (12, 9, 2, "2023-01-15", None)],
                    "id_suscripcion_cuenta int, id_cuenta int, id_suscripcion int,"
                    " fecha_inicio date, fecha_fin date")
    accounts = frame([("c1", 1, "2023-01-01", "2023-01-31"), ("c2", 1, "2023-02-01", "9999-12-31")],
                     "id_dim_cuenta string, id_cuenta int, valido_desde date, valido_hasta date")
    plans = frame([("p2", 2, "2020-01-01", "9999-12-31"), ("p3", 3, "2020-01-01", "9999-12-31")],
                  "id_dim_suscripcion string, id_suscripcion int, valido_desde date,"
                  " valido_hasta date")
    fact = lifecycle.fact_suscripciones(periods, accounts, plans, "2023-03-01")
    assert rows(fact, "id_dim_cuenta", "id_dim_suscripcion", "id_dim_suscripcion_anterior") == [
        ("c1", "p2", None), ("c2", "p3", "p2"), (None, "p2", None)]


def report_inputs(frame):
    accounts = frame([(21, "Norte", "2022-01-05"), (22, "Sur", "2023-05-05"),
                      (23, "Este", "2021-02-11"), (24, "Oeste", "2023-09-30")],
                     "account_id int, account_name string, created_at timestamp_ntz").withColumns(
        {"email": F.lit("x@y.zz"), "updated_at": F.col("created_at")})
    plans = frame([(1, "Gratuita"), (2, "Premium"), (3, "Empresarial")],
                  "subscription_id int, subscription_name string").withColumns(
        {"max_contents_per_month": F.lit(5), "created_at": F.lit(None), "updated_at": F.lit(None)})
    periods = frame([
        (1, 21, 2, "2022-02-01", "2022-08-31"), (2, 21, 3, "2022-09-10", None),
        (3, 22, 1, "2023-05-05", None),
        (4, 23, 1, "2021-03-01", "2021-12-31"), (5, 23, 3, "2022-01-15", None),
        (6, 24, 2, "2023-10-01", "2023-10-31"), (7, 24, 3, "2023-11-20", None)],
        "account_subscription_id int, account_id int, subscription_id int, start_date date,"
        " end_date date")
    return accounts, plans, periods


def test_enterprise_report_sample(frame):
    out = report.enterprise_report(*report_inputs(frame))
    assert rows(out, "account_id", "days_between_prev_and_enterprise", "is_upgrade_flag") == [
        (21, 221, 1), (23, 320, 1), (24, 50, 1)]


def test_enterprise_report_edges(frame):
    accounts, plans, periods = report_inputs(frame)
    more = periods.unionByName(frame([
        (8, 21, 2, "2023-01-01", None),     # left the plan: absent
        (9, 22, 3, "2023-05-05", None),     # same day: the higher id is the latest
        (10, 23, 3, "2022-02-14", None),    # plan to itself: no upgrade
        (11, 29, 3, "2023-09-01", None)],   # unknown account
        "account_subscription_id int, account_id int, subscription_id int, start_date date,"
        " end_date date"))
    out = report.enterprise_report(accounts, plans, more)
    assert rows(out, "account_id", "days_between_prev_and_enterprise", "is_upgrade_flag") == [
        (22, 0, 1), (23, 30, 0), (24, 50, 1)]
    only = report.enterprise_report(accounts, plans, periods.filter("account_subscription_id = 5"))
    assert rows(only, "account_id", "days_between_prev_and_enterprise", "is_upgrade_flag") == [
        (23, None, 0)]


def test_report_job(spark, frame, tmp_path):
    accounts, plans, periods = report_inputs(frame)
    tables = {"accounts": accounts, "subscriptions": plans, "accounts_subscription": periods}
    out = str(tmp_path)
    assert report.run_report(spark, FrameSource(tables), out, "2024-03-05")
    files = list((tmp_path / "reporte_cuentas_enterprise_20240305.csv").glob("part-*"))
    assert files
    assert files[0].read_text().splitlines()[0].startswith("account_id,account_name,")
    none = tables | {"accounts_subscription": periods.limit(0)}
    assert not report.run_report(spark, FrameSource(none), out, "2024-03-06")
    free = tables | {"accounts_subscription": periods.filter("subscription_id = 1")}
    assert not report.run_report(spark, FrameSource(free), out, "2024-03-06")
    assert not (tmp_path / "reporte_cuentas_enterprise_20240306.csv").exists()


DIM = ("id_cuenta int, nombre_cuenta string, correo_electronico string, segmento_rfm_ultimo string,"
       " fecha_rfm_ultimo date, segmento_rfm_anterior string, fecha_rfm_anterior date,"
       " es_actual boolean")


def dim_rows(frame, n=8):
    return frame([(i, f"n{i}", None if i == 3 else f"e{i}", None if i == 2 else "Campeones",
                   "2024-01-01", fixed.NO_SEGMENT, "1900-01-01", i != 4) for i in range(n)], DIM)


def test_crm(frame):
    dim = dim_rows(frame)
    assert rows(activation.crm_candidates(dim), "id_cuenta") == [(0,), (1,), (3,), (5,), (6,), (7,)]
    assert activation.crm_candidates(dim, 0).isEmpty()
    assert activation.crm_candidates(dim, 2).count() == 2
    companies = frame([(1, "c1"), (1, "c9"), (5, "c5"), (4, "c4")], "id_cuenta int, company_id string")
    matched = activation.crm_match(activation.crm_candidates(dim), companies)
    assert matched.count() == 6
    payloads = {r["company_id"]: json.loads(r["payload"])
                for r in activation.crm_payload(matched).collect()}
    assert payloads == {c: {"properties": {"segmento_rfm": "Campeones"}} for c in ("c1", "c5")}
    assert tuple(activation.crm_summary(matched).first()) == (2, 4, 6, 33.3)
    assert tuple(activation.crm_summary(matched.limit(0)).first()) == (0, 0, 0, None)
    assert tuple(activation.mapping_test(dim, companies, 5).first()) == (1, 0, 1, 100.0)


def test_serving(spark, frame):
    dim = dim_rows(frame)
    ids = frame([(1,), (1,), (2,), (3,), (4,), (99,)], "id_cuenta int")
    got = rows(serving.customer_rfm(dim, ids))
    assert [r[0] for r in got] == [1, 2, 3]
    assert got[2][1] == "" and got[1][3] == ""
    assert got[0][3:] == ("Campeones", "2024-01-01", fixed.NO_SEGMENT, "1900-01-01")
    assert rows(serving.customers_not_found(dim, ids)) == [(4,), (99,)]
    assert serving.segment_catalog(spark).count() == 11


def test_scalars(spark):
    one = spark.range(1)
    assert one.select(months_before("2024-08-31", 6)).first()[0] == day("2024-02-29")
    ok = one.select(valid_at("2024-01-01", as_date("2024-01-01"), F.lit(None).cast("date")),
                    valid_at("2024-01-01", as_date("2023-01-01"), as_date("2023-12-31")),
                    is_email(F.lit("a.b+c@x-y.org")), is_email(F.lit("a@b")),
                    as_ts(as_date("2024-01-01")))
    assert tuple(ok.first()) == (True, False, True, False, ts("2024-01-01"))
