"""The aggregates behind distribution and count plots, samples and principal components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeworks.functions.columns import present
from lodgeworks.operators.ordering import quantiles_of, ranked_values
from lodgeworks.operators.quantiles import exact_quantiles
from lodgeworks.session import staged


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value combination, nulls left out (a plot has no bar for them)."""
    return df.dropna("any", subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins ``(bin, low, high, n, density)``; the last bin includes the maximum."""
    span = df.agg(F.min(present(df, column)), F.max(present(df, column)), F.count(present(df, column))).first()
    low, high, total = span[0], span[1], span[2]
    schema = "bin int, low double, high double, n long, density double"
    if not total:
        return df.sparkSession.createDataFrame([], schema)
    low, high = float(low), float(high)
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    index = F.least(F.floor((present(df, column) - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.filter(present(df, column).isNotNull()).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        "n",
        (F.col("n") / (total * width)).alias("density"),
    )


def density_curve(df: DataFrame, column: str, bins: int = 200, points: int = 50) -> DataFrame:
    """``(x, density)`` of a Gaussian kernel over the binned data (Scott's bandwidth).

    The rows are only read for the bins; the curve is ``points`` x ``bins`` arithmetic in one row
    of arrays.
    """
    binned = histogram(df, column, bins)
    stats = df.agg(
        F.count(present(df, column)).alias("n"), F.stddev_samp(present(df, column)).alias("sd")
    ).first()
    total, sd = stats["n"], stats["sd"]
    if not total or not sd:
        return df.sparkSession.createDataFrame([], "x double, density double")
    h = sd * total ** (-0.2)
    row = binned.agg(
        F.collect_list(F.struct(((F.col("low") + F.col("high")) / 2).alias("c"), "n")).alias("bins"),
        F.min("low").alias("lo"), F.max("high").alias("hi"),
    )
    xs = F.transform(
        F.sequence(F.lit(0), F.lit(points - 1)),
        lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * i / (points - 1),
    )
    norm = total * h * (2 * 3.141592653589793) ** 0.5
    return row.select("bins", F.explode(xs).alias("x")).select(
        "x",
        F.aggregate(
            "bins", F.lit(0.0),
            lambda acc, b: acc + b["n"] * F.exp(-0.5 * F.pow((F.col("x") - b["c"]) / h, 2)),
        ).__truediv__(norm).alias("density"),
    )


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per number column: quartiles, whisker ends (last values within 1.5 IQR) and fliers."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    rows, aggs = [], []
    for i, (c, q) in enumerate(quartiles.items()):
        if q[0.5] is None:
            continue
        q1, q3 = q[0.25], q[0.75]
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        col = present(df, c).cast("double")
        inside = col.between(low, high)
        aggs += [
            F.min(F.when(inside, col)).alias(f"lo{i}"),
            F.max(F.when(inside, col)).alias(f"hi{i}"),
            F.count_if(~inside).alias(f"f{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(c).alias("column"), F.lit(q1).alias("q1"), F.lit(q[0.5]).alias("median"),
                F.lit(q3).alias("q3"), F.col(f"lo{i}").alias("whisker_low"),
                F.col(f"hi{i}").alias("whisker_high"), F.col(f"f{i}").alias("n_fliers"),
            )
        )
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "column string, q1 double, median double, q3 double, whisker_low double, "
                "whisker_high double, n_fliers long")
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def box_stats_by(df: DataFrame, group: str, value: str = "lead_time") -> DataFrame:
    """Box statistics of ``value`` per category, exact, for any number of categories."""
    ranked = ranked_values(df, [group], value)
    # Both sides are files, so adaptive execution broadcasts the quartiles or splits a large category.
    quartiles = staged(quantiles_of(ranked, [group], [0.25, 0.5, 0.75]).select(
        F.col(group).alias("_g"), F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"),
    ), "quartiles")
    iqr = F.col("q3") - F.col("q1")
    v = F.col("_v")
    inside = v.between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr)
    return (
        ranked.join(quartiles, F.col(group).eqNullSafe(F.col("_g")))
        .groupBy(group, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("n_fliers"),
        )
    )


def sample_rows(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by chance, by one way for every ``n``.

    A chance number per row is thinned to little more than ``n`` rows by the row count, whose bound
    leaves fewer than ``n`` with a probability below one in a million; the smallest numbers stay.
    """
    total = df.count()
    share = min(1.0, (n + 5 * (n + 1) ** 0.5 + 10) / max(total, 1))
    return df.withColumn("_r", F.rand(seed)).filter(F.col("_r") < share).orderBy("_r").limit(n).drop("_r")


def head(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first ``n`` rows in key order (a table has no order of its own)."""
    return df.orderBy(*keys).limit(n)


def select_unique(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns, each once."""
    return df.select(*dict.fromkeys(names))


def fit_pca(df: DataFrame, columns: Sequence[str], components: int = 4) -> PipelineModel:
    """Centre, then project on the principal components; output column ``pca``."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(columns), outputCol="_raw", handleInvalid="error"),
            StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False),
            PCA(k=components, inputCol="_centred", outputCol="pca"),
        ]
    ).fit(df)


def pca_loadings(spark, model: PipelineModel, columns: Sequence[str]) -> DataFrame:
    """``(component, feature, loading)`` rows; the matrix is columns x components, never data."""
    matrix = model.stages[-1].pc.toArray()
    rows = [
        (f"PC{j + 1}", name, float(matrix[i][j]))
        for i, name in enumerate(columns)
        for j in range(matrix.shape[1])
    ]
    return spark.createDataFrame(rows, "component string, feature string, loading double")


def leading_features(loadings: DataFrame) -> DataFrame:
    """The feature with the largest absolute loading per component, in component-name order."""
    return (
        loadings.groupBy("component")
        .agg(F.max_by("feature", F.abs("loading")).alias("feature"))
        .orderBy("component")
    )
