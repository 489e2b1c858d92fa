import pytest
from pyspark.sql import functions as F

from abono.operators.history import (
    Slices, asof_dim, dim_at, last_version_per_day, new_versions, overlapping_versions,
    scd2_dimension, snapshot_merge, versions_from_history)
from tests.conftest import day, rows, ts

SOURCE = "k int, name string, at timestamp_ntz"


def short(df):
    return rows(df, "k", "name", "dbt_valid_from", "dbt_valid_to")


def test_snapshot_cases(frame):
    first = new_versions(frame([(1, "a", "2024-01-01"), (2, "b", "2024-01-01"),
                                (3, "c", "2024-01-01")], SOURCE), "k", "at")
    second = frame([(1, "a2", "2024-01-05"), (2, "b", "2024-01-01"), (4, "d", "2024-01-06")], SOURCE)
    merged = snapshot_merge(first, second, "k", "at", "2024-01-10")
    assert short(merged) == [
        (1, "a", ts("2024-01-01"), ts("2024-01-05")),
        (1, "a2", ts("2024-01-05"), None),
        (2, "b", ts("2024-01-01"), None),
        (3, "c", ts("2024-01-01"), ts("2024-01-10")),
        (4, "d", ts("2024-01-06"), None)]
    # Running again over the same source changes nothing.
    assert rows(snapshot_merge(merged, second, "k", "at", "2024-01-11")) == rows(merged)
    # A key that comes back opens a version; the closed ones stay.
    third = second.unionByName(frame([(3, "c3", "2024-01-12")], SOURCE))
    back = snapshot_merge(merged, third, "k", "at", "2024-01-13")
    assert [r for r in short(back) if r[0] == 3] == [
        (3, "c", ts("2024-01-01"), ts("2024-01-10")), (3, "c3", ts("2024-01-12"), None)]


def test_snapshot_without_hard_deletes(frame):
    first = new_versions(frame([(1, "a", "2024-01-01")], SOURCE), "k", "at")
    kept = snapshot_merge(first, frame([], SOURCE), "k", "at", "2024-01-10", hard_deletes=False)
    assert short(kept) == [(1, "a", ts("2024-01-01"), None)]


def test_snapshot_older_source_row_is_ignored(frame):
    first = new_versions(frame([(1, "a", "2024-01-05")], SOURCE), "k", "at")
    merged = snapshot_merge(first, frame([(1, "old", "2024-01-01")], SOURCE), "k", "at", "2024-01-10")
    assert short(merged) == [(1, "a", ts("2024-01-05"), None)]


def test_first_snapshot_and_empty_source(frame):
    empty = frame([], SOURCE)
    assert rows(snapshot_merge(None, empty, "k", "at", "2024-01-01")) == []
    assert snapshot_merge(None, empty, "k", "at", "2024-01-01").columns == [
        "k", "name", "at", "dbt_scd_id", "dbt_valid_from", "dbt_valid_to"]


def test_repeated_merges_equal_the_bulk_form(frame):
    log = [(1, "a", "2024-01-01 08:00:00"), (2, "x", "2024-01-01 09:00:00"),
           (1, "b", "2024-01-02 08:00:00"), (1, "c", "2024-01-03 08:00:00"),
           (2, "y", "2024-01-03 09:00:00")]
    snap = None
    for until in ("2024-01-01 23:00:00", "2024-01-02 23:00:00", "2024-01-03 23:00:00"):
        state = {}
        for k, name, at in log:
            if at <= until:
                state[k] = (k, name, at)
        snap = snapshot_merge(snap, frame(list(state.values()), SOURCE), "k", "at", until)
    bulk = versions_from_history(frame(log, SOURCE), "k", "at", "name")
    assert short(snap) == short(bulk)
    assert rows(snap, "dbt_scd_id") == rows(bulk, "dbt_scd_id")


def test_history_keeps_the_last_of_simultaneous_changes(frame):
    log = frame([(1, "a", "2024-01-01"), (1, "b", "2024-01-01"), (1, "c", "2024-01-02"),
                 (1, "z", None)], SOURCE)
    assert short(versions_from_history(log, "k", "at", "name")) == [
        (1, "b", ts("2024-01-01"), ts("2024-01-02")), (1, "c", ts("2024-01-02"), None)]


VERSIONS = ("k int, name string, created timestamp_ntz, dbt_scd_id string,"
            " dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")


@pytest.fixture
def versions(frame):
    return frame([
        (1, "a", "2023-12-01", "s1", "2024-01-01 08:00:00", "2024-01-01 18:00:00"),
        (1, "b", "2023-12-01", "s2", "2024-01-01 18:00:00", "2024-01-05 10:00:00"),
        (1, "c", "2023-12-01", "s3", "2024-01-05 10:00:00", None),
        (2, "x", "2024-02-01", "s4", "2024-02-01 00:00:00", "2024-02-01 12:00:00"),
    ], VERSIONS)


def test_dimension(versions):
    dim = scd2_dimension(versions, "k", "sk", created="created")
    assert rows(dim, "sk", "valido_desde", "valido_hasta", "es_actual") == [
        ("s2", day("2023-12-01"), day("2024-01-04"), False),
        ("s3", day("2024-01-05"), day("9999-12-31"), True),
        ("s4", day("2024-02-01"), day("2024-01-31"), False)]  # gone the day it came
    assert rows(dim_at(dim, "2024-02-01"), "sk") == [("s3",)]
    assert rows(last_version_per_day(versions, "k"), "dbt_scd_id") == [("s2",), ("s3",), ("s4",)]


def test_type1_columns_show_the_latest_value(versions):
    dim = scd2_dimension(versions, "k", "sk", created="created", type1_cols=["name"])
    assert rows(dim, "sk", "name") == [("s2", "c"), ("s3", "c"), ("s4", "x")]


DIM = "sk string, k int, valido_desde date, valido_hasta date"


def test_asof_gaps_overlaps_and_fan_out(frame):
    fact = frame([(1, "2024-01-03"), (1, "2024-01-20"), (2, "2024-01-03"), (None, "2024-01-03")],
                 "k int, d date")
    dim = frame([("a", 1, "2024-01-01", "2024-01-10"), ("b", 1, "2024-01-03", "2024-01-12")], DIM)
    assert rows(asof_dim(fact, dim, "k", "d", "sk")) == [
        (1, day("2024-01-03"), "a"), (1, day("2024-01-03"), "b"), (1, day("2024-01-20"), None),
        (2, day("2024-01-03"), None), (None, day("2024-01-03"), None)]
    assert rows(overlapping_versions(dim, "k"), "sk") == [("a",)]
    with pytest.raises(ValueError):
        asof_dim(fact, dim, "k", "d", "sk", on_overlap="error")
    clean = dim.filter(F.col("sk") == "a")
    assert asof_dim(fact, clean, "k", "d", "sk", on_overlap="error").count() == 4


@pytest.mark.parametrize("dated", [True, False])
def test_asof_on_few_keys_fills_all_tasks(spark, frame, dated):
    """Five plans, one of which most facts have, half of them without a previous one, and maybe all
    on one day; neither adaptive execution nor a broadcast helps."""
    dim = frame([(k, f"{k}-{n}", f"20{n:02d}-01-01", f"20{n:02d}-12-31" if n < 23 else "9999-12-31")
                 for k in range(5) for n in range(15, 24)],
                "plan int, sk string, valido_desde date, valido_hasta date")
    n = F.col("id")
    day = F.date_add(F.lit("2014-06-01").cast("date"), (n * 7 % 3650).cast("int") if dated else F.lit(2000))
    fact = spark.range(8000).select(
        n, F.when(n % 2 == 0, None).when(n % 20 == 1, (n % 5).cast("int")).otherwise(F.lit(2)).alias("plan"),
        F.when(n % 500 != 0, day).alias("d"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(before, ("false", "-1", "16")):
            spark.conf.set(k, v)
        plain = asof_dim(fact, dim, "plan", "d", "sk")
        sliced = asof_dim(fact, dim, "plan", "d", "sk", slices=Slices(shares=16))
        assert "BroadcastHashJoin" not in sliced._jdf.queryExecution().executedPlan().toString()
        largest = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert largest(plain) > 3500 and largest(sliced) < (900 if dated else 2000)
        assert rows(sliced) == rows(plain) and sliced.filter("sk IS NOT NULL").count() > 3000
        none = asof_dim(fact.filter("d IS NULL"), dim, "plan", "d", "sk", slices=Slices())
        assert none.filter("sk IS NULL").count() == 16
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
