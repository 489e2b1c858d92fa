import random

from abono.operators.history import asof_dim, versions_from_history
from abono.operators.skew import HotLimits, hot_keys, with_neighbours
from abono.plans.lifecycle import lifecycle_periods
from tests.conftest import rows

PLAIN = HotLimits(1 << 62)
WANT = dict(lag={"p": "v", "po": "o"}, lead={"n": "v"}, first={"f": "v", "fo": "o"})


def skewed(spark, n=2000, seed=5):
    """Half of the rows on key 1, a tenth on the null key, null and tied order values."""
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = None if rnd.random() < .1 else 1 if rnd.random() < .5 else rnd.randint(2, 30)
        data.append((key, None if rnd.random() < .1 else rnd.randint(0, 50), i,
                     None if rnd.random() < .2 else i))
    return spark.createDataFrame(data, "k int, o int, id int, v int")


def test_sliced_windows_equal_plain_ones(spark):
    df = skewed(spark)
    plain = with_neighbours(df, "k", ["o", "id"], **WANT, limits=PLAIN)
    for limits in (HotLimits(300), HotLimits(40), HotLimits(3)):
        assert not hot_keys(df, "k", limits).isEmpty()
        sliced = with_neighbours(df, "k", ["o", "id"], **WANT, limits=limits)
        assert sliced.columns == plain.columns
        assert rows(sliced) == rows(plain)


def test_one_order_value_for_all_rows_still_splits(spark):
    df = spark.range(500).selectExpr("1 as k", "7 as o", "id", "id as v")
    sliced = with_neighbours(df, "k", ["o", "id"], lag={"p": "v"}, limits=HotLimits(50))
    assert rows(sliced, "v", "p")[:3] == [(0, None), (1, 0), (10, 9)]
    assert rows(sliced) == rows(with_neighbours(df, "k", ["o", "id"], lag={"p": "v"}, limits=PLAIN))


def test_no_hot_key_means_the_plain_plan(spark):
    df = skewed(spark, 300)
    out = with_neighbours(df, "k", ["o", "id"], lag={"p": "v"}, limits=HotLimits(10_000))
    assert "_slice" not in out._jdf.queryExecution().toString()


def test_every_key_may_be_hot(spark):
    df = spark.range(12_000).selectExpr("id % 1100 as k", "id as o", "id", "id as v")
    assert hot_keys(df, "k", HotLimits(5)).count() == 1100
    assert rows(with_neighbours(df, "k", ["o", "id"], lag={"p": "v"}, limits=HotLimits(5))) == rows(
        with_neighbours(df, "k", ["o", "id"], lag={"p": "v"}, limits=PLAIN))


def test_hot_account_lifecycle_and_hot_change_log(spark):
    periods = spark.range(600).selectExpr(
        "id as id_suscripcion_cuenta", "if(id % 3 = 0, 1, id % 50) as id_cuenta",
        "cast(id % 5 as int) as id_suscripcion",
        "date_add(date'2020-01-01', cast(id * 13 % 400 as int)) as fecha_inicio",
        "if(id % 2 = 0, date'2023-01-01', null) as fecha_fin")
    small = HotLimits(20)
    assert rows(lifecycle_periods(periods, "2024-01-01", small)) == rows(
        lifecycle_periods(periods, "2024-01-01", PLAIN))
    log = spark.range(600).selectExpr(
        "if(id % 3 = 0, 1, id % 50) as k", "id as t",
        "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id % 97 as int)) as at")
    assert rows(versions_from_history(log, "k", "at", "t", small)) == rows(
        versions_from_history(log, "k", "at", "t", PLAIN))


def test_asof_join_splits_a_hot_key(spark, tmp_path):
    """Adaptive execution cuts the hot key's partition up on the fact side."""
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in tight}
    try:
        for k, v in tight.items():
            spark.conf.set(k, v)
        fact = spark.range(0, 30000, 1, 8).selectExpr(
            "if(id % 3 = 0, 1, id) as k", "date'2024-01-05' as d", "uuid() as filler")
        dim = spark.range(0, 30000, 1, 8).selectExpr(
            "id as k", "cast(id as string) as sk", "date'2024-01-01' as valido_desde",
            "date'9999-12-31' as valido_hasta")
        out = asof_dim(fact, dim, "k", "d", "sk")
        out.write.parquet(str(tmp_path / "out"))
        assert spark.read.parquet(str(tmp_path / "out")).filter("sk is null").isEmpty()
        assert out.count() == 30000
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
