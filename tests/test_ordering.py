import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodgeworks.operators.ordering import grouped_quantiles, number_rows, running_totals
from lodgeworks.operators.quantiles import exact_quantiles, iqr_outliers

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("shape", ["spread", "heavy_value", "two_values", "constant", "few"])
def test_quantiles_equal_numpy(spark, shape):
    rng = np.random.default_rng(7)
    n = 20_000
    values = {
        "spread": rng.normal(size=n) * 1e6,
        # A third of all rows share one value, which several quantiles fall on.
        "heavy_value": np.where(rng.random(n) < 1 / 3, 5.0, rng.exponential(10, n)),
        "two_values": np.where(np.arange(n) % 2 == 0, 0.0, 1.0),
        "constant": np.full(n, 3.0),
        "few": np.array([1.0, 2.0, 3.0, 2.0]),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double").repartition(8)
    for found in (exact_quantiles(df, ["x"], PROBS, buckets=50), exact_quantiles(df, ["x"], PROBS)):
        for p in PROBS:
            assert found["x"][p] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_quantiles_of_nothing_and_of_integers(spark):
    df = spark.createDataFrame([(None, i) for i in range(11)], "x double, i long")
    assert exact_quantiles(df, ["x", "i"], [0.5]) == {"x": {0.5: None}, "i": {0.5: 5.0}}


def test_outliers_are_strictly_outside(spark):
    # Quartiles 2 and 4, fences -1 and 7: 7 is no outlier, 7.1 is.
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 7.0)], "x double")
    assert iqr_outliers(df, ["x"]).first().n_outliers == 0
    wider = df.unionByName(spark.createDataFrame([(100.0,)], "x double"))
    assert iqr_outliers(wider, ["x"]).first().n_outliers == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 30)), min_size=1, max_size=80),
       st.integers(2, 12))
def test_running_totals(spark, rows, buckets):
    df = spark.createDataFrame(rows, "g string, v long").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = running_totals(df, ["v"], ["n"], ["g"], buckets, totals=True).collect()
    for r in got:
        assert r.n_upto == sum(1 for g, v in rows if g == r.g and v <= r.v)
        assert r.n_total == sum(1 for g, v in rows if g == r.g)


def test_one_group_over_many_buckets(spark):
    df = spark.range(5_000).select(F.lit("g").alias("g"), F.col("id").alias("v"), F.lit(1).alias("n"))
    out = running_totals(df, ["v"], ["n"], ["g"], buckets=200, totals=True)
    assert out.filter("n_upto != v + 1 OR n_total != 5000").isEmpty()


def test_numbers_are_contiguous(spark):
    df = spark.range(1_000).select((F.col("id") * 7919 % 1_000).alias("k"), F.lit("x").alias("pad"))
    out = number_rows(df, ["k"], "n", start=1, buckets=100)
    assert out.count() == 1_000 and out.filter("n != k + 1").isEmpty()
    tied = number_rows(spark.range(50).select((F.col("id") % 3).alias("k")), ["k"], "n", buckets=10)
    assert sorted(r.n for r in tied.collect()) == list(range(50))


def test_grouped_quantiles_with_a_heavy_group(spark):
    rng = np.random.default_rng(1)
    rows = [("big" if i % 3 else f"g{i % 40}", float(round(rng.normal(), 2))) for i in range(3_000)]
    got = grouped_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", [0.25, 0.5], buckets=20)
    for r in got.collect():
        mine = [v for g, v in rows if g == r.g]
        assert r.n == len(mine)
        assert r.q0 == pytest.approx(np.quantile(mine, 0.25)) and r.q1 == pytest.approx(np.median(mine))
