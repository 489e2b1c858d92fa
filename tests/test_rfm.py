"""Scoring of a small example worked out by hand."""

import datetime as dt
import itertools
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from abono import fixed
from abono.plans import dimensions, rfm
from abono.plans.rfm import fact_rfm, rfm_segment
from tests.conftest import day, rows, ts

D = "2022-10-01"
ACCOUNTS = [(11, "2021-01-10", 2), (12, "2021-06-01", 1), (13, "2022-01-20", 2),
            (14, "2022-08-15", 1), (15, "2020-12-05", 2)]
CONTENTS = [(11, "2022-09-21"), (11, "2022-09-01"), (12, "2022-07-03"), (14, "2022-09-30"),
            (15, "2021-05-05")]
PAYMENTS = [(111, "2022-09-15", "10.50"), (111, "2022-08-15", "10.50"), (112, "2022-09-11", "30.00"),
            (113, "2022-06-23", "5.25"), (115, "2022-03-10", "40.00"), (115, "2022-04-10", "40.00")]
FEATURES = [(11, "2022-09-05", "7.00"), (13, "2022-05-02", "100.00")]
# account: last activity, days, contents, payments, features, total, paid, features paid,
# value, scores, segment
EXPECTED = {
    11: ("2022-09-21", 10, 2, 2, 1, 5, "21.00", "7.00", "28.00", "4-5-2", "Clientes Potenciales"),
    12: ("2022-09-11", 20, 1, 1, 0, 2, "30.00", "0", "30.00", "3-2-3", "En Riesgo"),
    13: ("2022-06-23", 100, 0, 1, 1, 2, "5.25", "100.00", "105.25", "2-3-5", "En Riesgo"),
    14: ("2022-09-30", 1, 1, 0, 0, 1, "0", "0", "0", "5-1-1", "Nuevos Clientes"),
    15: ("2022-04-10", 174, 1, 2, 0, 3, "80.00", "0", "80.00", "1-4-4", "Necesitan Atención"),
}


@pytest.fixture(scope="module")
def inputs(frame):
    far = "9999-12-31"
    dim = frame([(a, a, f"Cuenta {a}", s, s, far, True) for a, s, _ in ACCOUNTS],
                "id_dim_cuenta int, id_cuenta int, nombre_cuenta string, fecha_creacion timestamp_ntz,"
                " valido_desde date, valido_hasta date, es_actual boolean")
    facts = frame([(a, p, s, far) for a, s, p in ACCOUNTS],
                  "id_dim_cuenta int, id_dim_suscripcion int, fecha_inicio date, fecha_fin date")
    plans = frame([(1, "Basica"), (2, "Premium")], "id_dim_suscripcion int, nombre_suscripcion string")
    contents = frame(CONTENTS, "id_cuenta int, fecha_creacion timestamp_ntz")
    payments = frame(PAYMENTS, "id_suscripcion_cuenta int, fecha_pago timestamp_ntz, monto decimal(10,2)")
    periods = frame([(100 + a, a) for a, _, _ in ACCOUNTS], "id_suscripcion_cuenta int, id_cuenta int")
    features = frame(FEATURES, "id_cuenta int, fecha_compra timestamp_ntz, monto_pagado decimal(10,2)")
    return dim, facts, plans, contents, payments, periods, features


def test_example(inputs):
    fact = fact_rfm(*inputs, D, window_months=None, min_tenure_months=None)
    got = {r["id_dim_cuenta"]: r for r in fact.collect()}
    assert set(got) == set(EXPECTED)
    for account, (last, days, c, p, f, n, paid, fpaid, value, scores, segment) in EXPECTED.items():
        r = got[account]
        assert tuple(r[1:10]) == (
            ts(last), days, c, p, f, n, Decimal(paid), Decimal(fpaid), Decimal(value))
        assert (r["rfm_score"], r["segmento_rfm"]) == (scores, segment)
        assert r["id_dim_fecha_rfm"] == day(D)


def test_window_and_tenure_filters(inputs):
    """In production form: account 14 is too young; what is older than the window is out."""
    got = {r["id_dim_cuenta"]: r for r in fact_rfm(*inputs, D).collect()}
    assert set(got) == {11, 12, 13, 15}
    assert (got[15]["total_contenidos_creados"], got[15]["total_pagos_realizados"]) == (0, 1)


def test_account_without_activity_and_free_plan(frame, inputs):
    dim, facts, plans, contents, payments, periods, features = inputs
    nothing = [df.limit(0) for df in (contents, payments, features)]
    fact = fact_rfm(dim, facts, plans, nothing[0], nothing[1], periods, nothing[2], D)
    r = fact.filter("id_dim_cuenta = 11").first()
    age = (day(D) - dt.date(1900, 1, 1)).days
    assert (r["ultima_actividad"], r["dias_desde_ultima_actividad"]) == (ts("1900-01-01"), age)
    assert (r["frecuencia_total"], r["valor_monetario_total"]) == (0, Decimal("0.00"))
    free = plans.withColumn("nombre_suscripcion", F.when(
        F.col("id_dim_suscripcion") == 1, fixed.FREE_PLAN).otherwise(F.col("nombre_suscripcion")))
    assert rows(rfm.rfm_universe(dim, facts, free, D)) == [(11,), (13,), (15,)]
    unknown = plans.withColumn("nombre_suscripcion", F.lit(None).cast("string"))
    assert rfm.rfm_universe(dim, facts, unknown, D).isEmpty()


def test_empty_universe_keeps_the_schema(inputs):
    dim, facts, *rest = inputs
    fact = fact_rfm(dim, facts.limit(0), *rest, D)
    assert fact.count() == 0
    assert fact.columns[-3:] == ["rfm_score", "segmento_rfm", "id_dim_fecha_rfm"]


def test_activity_later_on_the_reference_day_is_out(frame, inputs):
    dim, facts, plans, contents, payments, periods, features = inputs
    late = frame([(11, "2022-10-01 00:00:00"), (11, "2022-10-01 09:00:00"), (11, "2022-04-01"),
                  (11, "2022-03-31 23:59:59")], "id_cuenta int, fecha_creacion timestamp_ntz")
    got = rfm.account_activity(late, payments, periods, features, D).filter("id_cuenta = 11").first()
    assert got["contents_n"] == 2


def test_day_modes(frame):
    base = frame([(1, "2022-09-29 18:00:00")], "id_cuenta int, last timestamp_ntz")
    days = lambda mode: rfm.rfm_recency(base, D, mode).first()["dias_desde_ultima_actividad"]
    assert (days("calendar"), days("elapsed")) == (2, 1)


def test_segments_of_all_125_score_triples(spark):
    """Triples per segment, counted by hand: two recent and three lapsed recency scores
    times the pairs of the other two that no earlier rule takes."""
    triples = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "recency_score int, frequency_score int, monetary_score int")
    got = df.select("*", rfm.rfm_score_text().alias("t"), rfm_segment().alias("s")).collect()
    assert Counter(r["s"] for r in got) == {
        "Campeones": 2 * 4, "Clientes Leales": 2 * 5, "Clientes de Alto Valor": 2 * 4,
        "Clientes Potenciales": 2 * 5, "Nuevos Clientes": 3, "Necesitan Atención": 3 * 4,
        "En Riesgo": 3 * 12, "Clientes Dormidos": 2 * 3, "Clientes Regulares": 7 + 4 + 9 + 2 * 6}
    by = {r["t"]: r["s"] for r in got}
    assert (by["4-2-4"], by["5-2-2"], by["2-2-1"]) == (
        "Clientes de Alto Valor", "Clientes Potenciales", "Clientes Dormidos")
    nulls = spark.createDataFrame([(5, None, 5)], df.schema).select(rfm_segment()).first()[0]
    assert nulls == "Clientes Regulares"


def test_dim_cuentas_last_and_previous_segment(frame):
    base = frame([("a", 1), ("b", 2), ("c", 3)], "id_dim_cuenta string, id_cuenta int")
    fact = frame([("a", "X", "2023-01-01"), ("a", "Y", "2023-07-01"), ("a", "Z", "2024-01-01"),
                  ("b", "Q", "2024-01-01")],
                 "id_dim_cuenta string, segmento_rfm string, id_dim_fecha_rfm date")
    never, none = day("1900-01-01"), fixed.NO_SEGMENT
    assert rows(dimensions.dim_cuentas(base, fact)) == [
        ("a", 1, "Z", day("2024-01-01"), "Y", day("2023-07-01")),
        ("b", 2, "Q", day("2024-01-01"), none, never),
        ("c", 3, none, never, none, never)]


def test_segments_kept_up_by_date_are_those_of_all_scores(frame):
    ddl = "id_dim_cuenta string, segmento_rfm string, id_dim_fecha_rfm date"
    runs = [("2024-02-01", {"a": "S1", "b": "S2"}), ("2024-04-01", {"a": "S3", "c": None}),
            ("2024-03-01", {"a": "S4", "b": "S5", "c": "S6"}), ("2024-01-01", {"a": "S7", "b": "S8"}),
            ("2024-04-01", {"a": "S9"})]
    every, kept = {}, dimensions.newest_segments(frame([], ddl))
    for date, found in runs:
        every |= {(k, date): v for k, v in found.items()}
        new = frame([(k, v, date) for k, v in found.items()], ddl)
        merged = dimensions.merged_segments(kept, new)
        assert merged.columns == kept.columns
        kept = frame([tuple(r) for r in kept.join(new, "id_dim_cuenta", "left_anti").unionByName(merged).collect()],
                     "id_dim_cuenta string, s1 string, f1 date, s2 string, f2 date")
        want = dimensions.newest_segments(frame([(k, v, d) for (k, d), v in every.items()], ddl))
        assert rows(kept) == rows(want)
