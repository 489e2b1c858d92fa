import pytest
from pyspark.sql import functions as F

from abono import cli, fixed
from abono.operators import checks
from abono.plans import dimensions, jobs, quality
from abono.schemas import RAW_SCHEMAS
from abono.sinks import versions
from abono.sources.tables import FrameSource
from tests.conftest import day, rows

DAY1, DAY2 = "2023-12-30", "2024-01-02"


def source(frame, day_two=False):
    stamp = "2024-01-01 10:00:00" if day_two else "2023-02-01"
    accounts = [(1, "Uno" if not day_two else "Uno SA", "a@b.co", "2023-01-01", stamp),
                (2, "Dos", "c@d.co", "2023-01-01", "2023-01-01")]
    contents = [(1, 1, "t", "d", "quiz", "2023-11-01", "2023-11-01")]
    if day_two:
        contents += [(1, 1, "t2", "d", "quiz", "2023-11-01", "2024-01-01"),
                     (2, 2, "n", "d", "quiz", "2023-12-01", "2024-01-01")]
        contents = contents[1:]
    data = {
        "accounts": accounts,
        "subscriptions": [(1, "Gratuita", 5, "2022-01-01", "2022-01-01"),
                          (2, "Premium", 50, "2022-01-01", "2022-01-01")],
        "accounts_subscription": [(1, 1, 2, "2023-02-01", None), (2, 2, 1, "2023-01-05", "2023-06-01"),
                                  (3, 2, 2, "2023-06-01", None)],
        "contents": contents,
        "content_attributes": [(1, 1, "Categoría", "X", None, None, "2023-11-01", "2023-11-01")],
        "premium_features": [(1, "F", "d", "9.99", "2022-01-01", "2022-01-01")],
        "subscription_payments": [(1, 1, "2023-12-01", "59.99", "x", "Mensual"),
                                  (2, 3, "2023-11-01", "59.99", "x", "Mensual")],
        "account_premium_features": [(1, 1, 1, "2023-12-05", "9.99")],
    }
    return FrameSource({n: frame(r, RAW_SCHEMAS[n]) for n, r in data.items()})


def test_two_days(spark, frame, tmp_path, monkeypatch):
    lake = jobs.Lake(str(tmp_path), "dev")
    jobs.run_full(spark, jobs.JobConfig(source(frame), lake), "2024-01-01", DAY1)
    read = lambda layer, name: lake.read(spark, layer, name)
    fact = read("analytics", "fact_rfm")
    assert rows(fact, "total_pagos_realizados", "total_features_compradas") == [(1, 0), (1, 1)]
    # dim_cuentas was built before the scores existed.
    assert rows(read("analytics", "dim_cuentas"), "segmento_rfm_ultimo") == [
        (fixed.NO_SEGMENT,)] * 2

    cfg = jobs.JobConfig(source(frame, day_two=True), lake)
    jobs.run_daily(spark, cfg, "2024-01-02", DAY2)
    assert rows(read("raw", "contents"), "content_id", "title") == [(1, "t2"), (2, "n")]
    assert rows(read("staging", "stg_contents"), "id_contenido", "titulo", "categoria") == [
        (1, "t2", "X"), (2, "n", None)]
    snapshot = read("snapshots", "accounts_snapshot")
    assert rows(snapshot, "id_cuenta", "nombre_cuenta") == [(1, "Uno"), (1, "Uno SA"), (2, "Dos")]
    dim = read("analytics", "dim_cuentas").filter("id_cuenta = 1")
    assert rows(dim, "nombre_cuenta", "valido_desde", "valido_hasta", "es_actual") == [
        ("Uno", day("2023-01-01"), day("2023-12-31"), False),
        ("Uno SA", day("2024-01-01"), day("9999-12-31"), True)]
    assert fixed.NO_SEGMENT not in {r[0] for r in rows(
        dim.filter("not es_actual"), "segmento_rfm_ultimo")}

    # Scoring the same date again is an upsert.
    again = jobs.run_rfm(spark, cfg, "2024-01-01")
    assert again.count() == 3  # the earlier score of account 1's first version stays

    # The stored segments follow each date, and a date that they missed is made up for.
    def segments():
        return rows(lake.read(spark, "analytics", jobs.SEGMENTS))
    assert segments() == rows(dimensions.newest_segments(read("analytics", "fact_rfm")))
    jobs.run_rfm(spark, cfg, "2024-01-02")
    assert segments() == rows(dimensions.newest_segments(read("analytics", "fact_rfm")))
    missed = read("analytics", "fact_rfm").filter("id_dim_fecha_rfm = '2024-01-02'").withColumn(
        "id_dim_fecha_rfm", F.lit("2024-01-03").cast("date"))
    versions.write_fact_rfm(missed, lake.path("analytics", "fact_rfm"))
    jobs.refresh_dim_cuentas(spark, cfg)
    assert day("2024-01-03") in {r[0] for r in rows(read("analytics", "dim_cuentas"), "fecha_rfm_ultimo")}
    jobs.run_rfm(spark, cfg, "2024-01-01")
    assert segments() == rows(dimensions.newest_segments(read("analytics", "fact_rfm")))
    checked = jobs.run_validation(spark, cfg, "2024-01-02")
    assert checked.filter("status = 'ERROR'").isEmpty()
    # the same results whether tables are counted by their loads or read; loads count them all
    read_again = quality.run_checks(spark, cfg.source, jobs.LayerSource(lake, "raw"), "2024-01-02", cfg.tables, cfg.keys)
    assert rows(checked) == rows(read_again)
    with monkeypatch.context() as patch:
        patch.setattr(checks, "check_loaded", None)
        known = [n for n in fixed.RAW_TABLES if "updated_at" in read("raw", n).columns]
        observed = quality.run_checks(spark, cfg.source, jobs.RawSource(cfg), "2024-01-02", known, cfg.keys)
    names = checked.filter(F.col("table_name").isin(known))
    assert known and rows(observed) == rows(names)


def test_stops_at_failing_checks(spark, frame, tmp_path):
    good = source(frame)
    bad = frame([(1, 1, 2, "2023-02-01", None), (1, 77, 2, "2023-02-01", None)],
                RAW_SCHEMAS["accounts_subscription"])
    cfg = jobs.JobConfig(FrameSource(good.frames | {"accounts_subscription": bad}),
                         jobs.Lake(str(tmp_path), "dev"))
    with pytest.raises(jobs.ChecksFailed) as failed:
        jobs.run_daily(spark, cfg, "2024-01-01", DAY1)
    assert failed.value.step == "source checks"
    assert {(r.check_name, r.column_name) for r in failed.value.rows} == {
        ("unique", "account_subscription_id"), ("relationships", "account_id"),
        ("relationships", "account_subscription_id")}
    assert cfg.lake.maybe(spark, "staging", "stg_accounts") is None


def test_command_line(spark, frame, tmp_path, capsys):
    raw, lake = tmp_path / "raw", tmp_path / "lake"
    for name, df in source(frame).frames.items():
        df.write.parquet(str(raw / name))
    base = ["--source", str(raw), "--lake", str(lake), "--env", "dev"]
    cli.main(["load", *base, "--tables", "accounts", "contents", "--full-refresh", "--validate"])
    assert "row_count" in capsys.readouterr().out
    assert jobs.Lake(str(lake), "dev").maybe(spark, "raw", "subscriptions") is None
    everything = cli.config(cli.parser().parse_args(["load", *base, "--full-refresh"]))
    assert set(everything.full_refresh) == set(fixed.RAW_TABLES)
    cli.main(["report", *base, "--as-of", "2024-01-01"])
    assert "nothing to report" in capsys.readouterr().out
