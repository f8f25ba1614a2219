import itertools
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lodgeworks.operators import drift, metrics, profile
from lodgeworks.plans.monitor import monitor


def _frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


def _distance(a, b):
    grid = np.unique(np.concatenate([a, b]))
    share = lambda s: np.searchsorted(np.sort(s), grid, side="right") / len(s)
    return float(np.abs(share(a) - share(b)).max())


@pytest.mark.parametrize("buckets", [1, 2, 50])
def test_statistic_equals_brute_force(spark, buckets):
    rng = np.random.default_rng(3)
    # A third of the reference is one value.
    a = np.where(rng.random(900) < 1 / 3, 0.5, rng.normal(size=900).round(2))
    b = rng.normal(0.2, 1, 700).round(2)
    row = drift.feature_drift(_frame(spark, a), _frame(spark, b), buckets=buckets).first()
    assert (row.n_ref, row.n_cur) == (900, 700)
    assert row.d == pytest.approx(_distance(a, b), abs=1e-12)
    back = drift.feature_drift(_frame(spark, b), _frame(spark, a), buckets=buckets).first()
    assert back.d == pytest.approx(row.d, abs=1e-12) and back.p_value == pytest.approx(row.p_value)


def test_equal_and_disjoint_samples(spark):
    same = drift.feature_drift(_frame(spark, range(100)), _frame(spark, range(100))).first()
    assert same.d == 0 and same.p_value == 1.0
    apart = drift.feature_drift(_frame(spark, range(100)), _frame(spark, range(500, 600))).first()
    assert apart.d == 1.0 and apart.p_value < 1e-12
    assert drift.data_drift(_frame(spark, range(100)), _frame(spark, range(100))).first().score == 0.0


def test_no_common_column_counts_as_drift(spark):
    assert drift.data_drift(_frame(spark, [1]), _frame(spark, [1]).withColumnRenamed("x", "y")).first().score == 1.0


def test_nulls_nan_and_column_choice(spark):
    a = spark.createDataFrame([(1.0, 1), (None, 2), (float("nan"), 3)], "x double, n long").withColumn("s", F.lit("t"))
    b = spark.createDataFrame([(1.0, 1)], "x double, n long")
    rows = {r.feature: r for r in drift.feature_drift(a, b).collect()}
    assert set(rows) == {"x", "n"} and rows["x"].n_ref == 1 and rows["n"].n_ref == 3
    assert [r.feature for r in drift.feature_drift(a, b, ["n", "absent"]).collect()] == ["n"]


def test_tail_against_the_plain_series_for_large_samples(spark):
    df = spark.createDataFrame([(0.002, 10**7, 10**7)], "d double, n long, m long")
    p = df.select(drift.kolmogorov_tail(F.col("d"), F.col("n"), F.col("m"))).first()[0]
    x = 0.002 * math.sqrt(10**7 / 2)
    plain = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 50))
    assert p == pytest.approx(plain, rel=2e-2)


def _predictions(spark):
    rows = [(1.0, 1.0, 5.0), (0.0, 1.0, 6.0), (0.0, 0.0, 7.0), (2.0, 0.0, 8.0)]
    return spark.createDataFrame(rows, "label double, prediction double, x double")


def test_class_report(spark):
    report = {r["class"]: r for r in metrics.class_report(_predictions(spark)).collect()}
    assert (report["1.0"].precision, report["1.0"].recall, report["1.0"].support) == (0.5, 1.0, 1)
    assert (report["0.0"].precision, report["0.0"].recall, report["0.0"].f1) == (0.5, 0.5, 0.5)
    # Never predicted: 0/0 counts as 0.
    assert (report["2.0"].precision, report["2.0"].recall, report["2.0"].f1) == (0.0, 0.0, 0.0)
    assert report["accuracy"].precision == 0.5
    assert report["macro avg"].recall == pytest.approx(0.5)
    assert report["weighted avg"].recall == report["accuracy"].recall
    scores = metrics.weighted_scores(_predictions(spark)).first()
    assert scores.accuracy == scores.recall == 0.5


def test_model_drift(spark):
    a = spark.createDataFrame([(1.0,), (0.0,)], "prediction double")
    b = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (0.0,)], "prediction double")
    assert drift.model_drift(a, b).first().score == pytest.approx(0.25)


def test_monitor_logs_one_schema_and_decides(spark, tmp_path):
    df = _predictions(spark)
    for _ in range(2):
        decision = monitor(df, df, "2024-02-01 00:00:00", str(tmp_path / "log")).first()
    assert decision.drift_score == 0.0 and decision.accuracy == 0.5 and decision.retrain is True
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 6 and log.schema.simpleString() == (
        "struct<ts:timestamp_ntz,type:string,score:double,threshold:double,details:map<string,string>>")
    good = df.withColumn("prediction", F.col("label"))
    assert monitor(good, good, "2024-02-01 00:00:00").first().retrain is False


def test_latency_histogram(spark):
    df = spark.createDataFrame([(0.004,), (0.005,), (0.3,), (99.0,)], "duration double")
    rows = {r.le: r for r in metrics.latency_histogram(df).collect()}
    assert rows["0.005"].n == 2 and rows["0.5"].n == 3 and rows["10.0"].n == 3 and rows["+Inf"].n == 4
    assert rows["+Inf"].total_seconds == pytest.approx(99.309)


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 4, 10)] + [(None,)], "x double")
    rows = {r.bin: r for r in profile.histogram(df, "x", 5).collect()}
    assert {b: r.n for b, r in rows.items()} == {0: 2, 1: 2, 2: 1, 4: 1}
    assert sum(r.density for r in rows.values()) * 2 == pytest.approx(1.0)
    constant = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert [r.n for r in profile.histogram(constant, "x", 4).collect()] == [4]
    assert profile.histogram(df.limit(0), "x").count() == 0


def test_density_integrates_to_one(spark):
    df = spark.range(2_000).select(F.randn(1).alias("x"))
    curve = sorted((r.x, r.density) for r in profile.density_curve(df, "x", points=200).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
    assert area == pytest.approx(1.0, abs=0.02)


def test_large_samples_are_complete(spark):
    df = spark.range(20_000)
    sample = profile.sample_rows(df, 2_000)
    assert sample.count() == 2_000 and sample.distinct().count() == 2_000


def test_principal_components(spark):
    df = spark.range(500).select(
        (F.randn(1) * 10).alias("wide"), F.randn(2).alias("narrow"), (F.randn(3) * 0.1 + 50).alias("offset"))
    model = profile.fit_pca(df, ["wide", "narrow", "offset"], 2)
    top = profile.leading_features(profile.pca_loadings(spark, model, ["wide", "narrow", "offset"]))
    assert [(r.component, r.feature) for r in top.collect()] == [("PC1", "wide"), ("PC2", "narrow")]
    means = model.transform(df).select(*[F.avg(vector_to_array("pca")[i]) for i in range(2)]).first()
    assert list(means) == pytest.approx([0.0, 0.0], abs=1e-9)  # centred before the projection
    assert profile.select_unique(df, ["wide", "narrow", "wide"]).columns == ["wide", "narrow"]


def test_an_empty_side_is_missing_data_and_not_drift(spark):
    df = spark.createDataFrame([(1.0, 2, 1.0, 1.0), (2.0, 3, 1.0, 1.0)], "x double, n long, prediction double, label double")
    hollow = df.withColumn("n", F.lit(None).cast("long"))
    rows = {r.feature: r for r in drift.feature_drift(df, hollow, ["x", "n"]).collect()}
    assert rows["n"].p_value is None and rows["n"].n_cur == 0 and rows["x"].p_value == 1.0
    assert drift.feature_drift(hollow, hollow, ["n"]).first().d is None
    for current in (hollow, df.limit(0)):
        logged = drift.monitor_rows(df, current, "2024-02-01 00:00:00", columns=["x", "n"], details={"run": "7"})
        by_kind = {r.type: r for r in logged.collect()}
        assert by_kind["data_drift"].score is None and by_kind["data_drift"].details["reason"]
        assert by_kind["data_drift"].details["run"] == "7" and by_kind["data_drift"].details["method"] == "ks_2samp"
        assert drift.retrain_decision(logged).first().retrain is False


def _p_values(spark, cases):
    """``exact_tail`` for (distance as a whole number of 1 / (n m), n, m)."""
    df = spark.createDataFrame([(k, h / (n * m), n, m) for k, (h, n, m) in enumerate(cases)], "k int, d double, n long, m long")
    rows = df.select("k", drift.exact_tail(F.col("d"), F.col("n"), F.col("m")).alias("p")).orderBy("k").collect()
    return [r.p for r in rows]


def test_exact_p_value_equals_enumeration(spark):
    """All orders of up to eight and eight values, counted one by one."""
    cases, want = [], []
    for n, m in ((1, 1), (2, 3), (5, 5), (8, 3), (7, 8), (8, 8)):
        reached = []
        for chosen in itertools.combinations(range(n + m), n):
            i = j = most = 0
            for at in range(n + m):
                i, j = (i + 1, j) if at in chosen else (i, j + 1)
                most = max(most, abs(i * m - j * n))
            reached.append(most)
        for h in sorted(set(reached)):
            cases.append((h, n, m))
            want.append(sum(r >= h for r in reached) / len(reached))
    assert _p_values(spark, cases) == pytest.approx(want, abs=1e-9)


def test_exact_p_value_equals_counted_paths(spark):
    """Whole numbers of lattice paths, row by row."""
    cases = [(100, 30, 20), (24_000, 200, 300), (60_000, 1_000, 1_000), (30_000, 999, 700), (1, 40, 60), (400, 20, 20)]
    want = []
    for h, n, m in cases:
        row = [1 if j * n < h else 0 for j in range(m + 1)]
        for j in range(1, m + 1):
            row[j] = row[j] if row[j - 1] else 0
        for i in range(1, n + 1):
            row[0] = row[0] if i * m < h else 0
            for j in range(1, m + 1):
                row[j] = row[j] + row[j - 1] if abs(i * m - j * n) < h else 0
        want.append(1 - Fraction(row[m], math.comb(n + m, n)))
    assert _p_values(spark, cases) == pytest.approx([float(w) for w in want], abs=1e-9)


def test_small_samples_are_exact_and_large_ones_are_not(spark, monkeypatch):
    a = spark.createDataFrame([(float(v),) for v in range(20)], "x double")
    b = spark.createDataFrame([(float(v) + 6.5,) for v in range(20)], "x double")
    exact = drift.feature_drift(a, b).first()
    assert exact.d == pytest.approx(7 / 20) and exact.p_value == pytest.approx(_p_values(spark, [(140, 20, 20)])[0], abs=1e-12)
    monkeypatch.setattr(drift, "EXACT_ROWS", 10)
    series = drift.feature_drift(a, b).first()
    assert series.p_value != exact.p_value and abs(series.p_value - exact.p_value) < 0.05
