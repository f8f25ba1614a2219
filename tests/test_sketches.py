"""Sketches against exact ranks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeworks.operators import drift, sketches


def numbers(spark, n=60_000, shift=0.0):
    return spark.range(n).select(
        (F.pow(F.col("id") * 7919 % n / n, F.lit(2.0)) * 1000 + shift).alias("skewed"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") % 100).cast("double").alias("hot"),
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id")).cast("double").alias("gaps"), (F.col("id") % 4).cast("int").alias("part"))


COLUMNS = ["skewed", "hot", "gaps"]
PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def within(df, found, slack=0.0):
    """Every answer's rank is within the bound of what was asked for."""
    for r in found.collect():
        values = np.sort([x[0] for x in df.select(r["name"]).dropna().collect()])
        assert r["n"] == len(values)
        for i, p in enumerate(PROBS):
            low, high = np.searchsorted(values, r[f"q{i}"], "left") / len(values), np.searchsorted(values, r[f"q{i}"], "right") / len(values)
            assert low - r["error"] - slack <= p <= high + r["error"] + slack


def test_quantiles_are_within_the_bound(spark):
    df = numbers(spark)
    found = sketches.sketched_quantiles(sketches.sketch(df, COLUMNS), PROBS)
    assert found.count() == 3
    within(df, found)
    assert sketches.rank_error(800) < sketches.rank_error(400) < 0.01


def test_merged_parts_answer_like_the_whole(spark):
    df = numbers(spark)
    parts = sketches.sketch(df, COLUMNS, by=["part"])
    assert parts.count() == 12
    for order in (parts, parts.orderBy(F.desc("part")), parts.repartition(5)):
        within(df, sketches.sketched_quantiles(sketches.merge(order), PROBS))
    some = sketches.sketched_quantiles(sketches.merge(parts.filter("part < 2")), PROBS)
    within(df.filter("part < 2"), some)


def test_drift_is_within_its_error(spark):
    a = numbers(spark)
    for shift in (0.0, 15.0, 400.0):
        b = numbers(spark, 40_000, shift)
        exact = {r.feature: r for r in drift.feature_drift(a, b, COLUMNS).collect()}
        found = {r.feature: r for r in sketches.sketched_drift(sketches.sketch(a, COLUMNS), sketches.sketch(b, COLUMNS)).collect()}
        assert set(found) == set(COLUMNS)
        for c in COLUMNS:
            assert abs(found[c].d - exact[c].d) <= found[c].error and (found[c].n_ref, found[c].n_cur) == (exact[c].n_ref, exact[c].n_cur)


def test_empty_sides(spark):
    a = numbers(spark, 100)
    empty = a.select(F.lit(None).cast("double").alias("skewed"), "hot")
    assert [r["name"] for r in sketches.sketch(empty, ["skewed", "hot"]).collect()] == ["hot"]
    one = sketches.sketched_drift(sketches.sketch(a, ["skewed", "hot"]), sketches.sketch(empty, ["skewed", "hot"]))
    rows = {r.feature: r for r in one.collect()}
    assert rows["skewed"].d is None and rows["skewed"].n_cur == 0 and rows["hot"].p_value == pytest.approx(1.0)
    assert sketches.sketch(a.limit(0), COLUMNS).collect() == []


def test_a_stream_folds_one_batch_at_a_time(spark, tmp_path):
    df = numbers(spark, 9_000)
    source = f"{tmp_path}/in"
    for p in range(3):
        df.filter(f"part = {p}").drop("part").coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    sketches.sketch_stream(stream, COLUMNS, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").select("batch").distinct().count() == 3
    within(df.filter("part < 3"), sketches.sketched_quantiles(sketches.streamed_sketches(spark, f"{tmp_path}/out"), PROBS))
    assert sum(r.n for r in sketches.streamed_sketches(spark, f"{tmp_path}/out", 1, 1).collect() if r["name"] == "hot") in (2250,)
