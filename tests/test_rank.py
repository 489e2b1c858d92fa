import random
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from abono.operators import rank
from abono.operators.rank import exact_ntile, newest_per_key, top_n_per_key
from abono.operators.shared import materialize
from tests.conftest import rows

SCORES = {"a_score": ("a", "desc"), "b_score": ("b", "asc")}


def with_ntile(df, scores, k):
    """The built-in function, as a yardstick."""
    def order(metric, way):
        return F.col(metric).desc_nulls_last() if way == "desc" else F.col(metric).asc_nulls_last()
    return df.select("*", *[
        F.ntile(k).over(Window.orderBy(order(m, way), F.col("id").asc())).cast("bigint").alias(out)
        for out, (m, way) in scores.items()])


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 12, 1000])
def test_distributed_ntile_equals_builtin(spark, n):
    rnd = random.Random(n)
    data = [(i, rnd.choice([None, 1, 2, 3, 3, 3]), Decimal(rnd.randint(0, 20)) / 4)
            for i in range(n)]
    df = materialize(spark.createDataFrame(data, "id bigint, a int, b decimal(10,2)"), "t")
    builtin = with_ntile(df, SCORES, 5)
    spread = exact_ntile(df, "id", SCORES, materialized=True)
    assert rows(builtin) == rows(spread)
    for score in SCORES:
        sizes = [r["count"] for r in spread.groupBy(score).count().orderBy(score).collect()]
        assert sorted(sizes, reverse=True) == sizes and (not sizes or sizes[0] - sizes[-1] <= 1)


def test_distributed_ntile_all_rows_tied_and_text_key(spark):
    df = spark.range(103).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(0).alias("a"))
    one = with_ntile(df, {"s": ("a", "asc")}, 4)
    two = exact_ntile(df, "id", {"s": ("a", "asc")}, k=4)
    assert rows(one) == rows(two)


def test_distributed_ntile_doubles(spark):
    df = spark.range(57).select("id", (F.col("id") * 7 % 11 / 3.0).alias("a"))
    spec = {"s": ("a", "desc")}
    assert rows(with_ntile(df, spec, 5)) == rows(exact_ntile(df, "id", spec))


def test_ntile_refuses_text_metrics(spark):
    df = spark.createDataFrame([(1, "x")], "id bigint, a string")
    with pytest.raises(TypeError):
        exact_ntile(df, "id", {"s": ("a", "asc")})


def test_top_n_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    top = top_n_per_key(df, "k", [F.col("v").desc()], n=2, rank="puesto")
    assert rows(top, "k", "v", "puesto") == [
        (0, 96, 2), (0, 99, 1), (1, 94, 2), (1, 97, 1), (2, 95, 2), (2, 98, 1)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    partial, shuffle = plan.index("row_number(), 2, Partial"), plan.index("Exchange hash")
    assert partial > shuffle  # deeper in the tree: runs first


def test_newest_per_key_null_cursor_last(spark):
    df = spark.createDataFrame([(1, None, 9), (1, 5, 1), (2, None, 3)], "k int, c int, t int")
    assert rows(newest_per_key(df, "k", "c", ["t"])) == [(1, 5, 1), (2, None, 3)]


@pytest.mark.parametrize("key_type", ["bigint", "string"])
def test_tiles_of_a_value_that_most_rows_have(spark, key_type):
    """Rounds of counting, down to a few rows per task, against the built-in window."""
    value = F.when(F.col("id") % 10 == 0, F.col("id") % 97).when(F.col("id") % 41 == 0, None).otherwise(F.lit(50))
    df = spark.range(5000).select(F.col("id").cast(key_type).alias("k"), value.alias("m"), (-value * 2).cast("decimal(10,1)").alias("o"))
    calls = []
    narrowed = rank._narrowed
    rank._narrowed = lambda *a: calls.append(1) or narrowed(*a)
    try:
        got = rank.exact_ntile(df, "k", {"up": ("m", "asc"), "down": ("o", "desc")}, k=7, sorted_rows=20)
    finally:
        rank._narrowed = narrowed
    assert len(calls) > 1
    want = df.select("k", "m", "o", F.ntile(7).over(Window.orderBy(F.col("m").asc_nulls_last(), "k")).cast("bigint").alias("up"),
                     F.ntile(7).over(Window.orderBy(F.col("o").desc_nulls_last(), "k")).cast("bigint").alias("down"))
    assert rows(got) == rows(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Exchange" not in plan
