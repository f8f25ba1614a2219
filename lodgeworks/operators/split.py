"""Key-based splits and scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lehmer generator modulus and multiplier, so that any engine can repeat the split.
MODULUS, MULTIPLIER = 2_147_483_647, 48_271
TRAIN_VALID_TEST = (("train", 700), ("valid", 210), ("test", 90))
TRAIN_TEST = (("train", 800), ("test", 200))


def key_hash(key: str | Column, seed: int = 42, size: int = 1_000) -> Column:
    """A number below ``size`` that depends on the key only, not on partitions or order."""
    col = F.col(key) if isinstance(key, str) else key
    first = (F.pmod(col, F.lit(MODULUS)) * MULTIPLIER + seed) % MODULUS
    return (first * MULTIPLIER % MODULUS) % size


def add_split(
    df: DataFrame, key: str, parts: Sequence[tuple[str, int]] = TRAIN_VALID_TEST, seed: int = 42
) -> DataFrame:
    """Add ``split``; the part sizes are in thousandths and must add up to 1000."""
    if sum(size for _, size in parts) != 1_000:
        raise ValueError("part sizes must add up to 1000")
    h, upto, chain = key_hash(key, seed), 0, None
    for name, size in parts[:-1]:
        upto += size
        chain = F.when(h < upto, name) if chain is None else chain.when(h < upto, name)
    return df.withColumn("split", chain.otherwise(parts[-1][0]) if chain is not None else F.lit(parts[0][0]))


def add_fold(df: DataFrame, key: str, folds: int, seed: int = 42) -> DataFrame:
    return df.withColumn("fold", key_hash(key, seed + 1, folds).cast("int"))


@dataclass(frozen=True)
class Scaler:
    """Means and population deviations; a constant column is only centred."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    suffix: str = "_scaled"

    @property
    def outputs(self) -> list[str]:
        return [c + self.suffix for c in self.columns]

    def scale(self, df: DataFrame) -> DataFrame:
        """The columns themselves scaled."""
        return df.withColumns(
            {c: (F.col(c) - m) / d for c, m, d in zip(self.columns, self.means, self.deviations)}
        )

    def stages(self) -> list:
        """The same as model stages, so that a saved model scales its own input."""
        parts = ", ".join(
            f"(CAST(`{c}` AS DOUBLE) - {m!r}D) / {d!r}D AS `{o}`"
            for c, m, d, o in zip(self.columns, self.means, self.deviations, self.outputs)
        )
        return [
            SQLTransformer(statement=f"SELECT *, {parts} FROM __THIS__"),
            VectorAssembler(inputCols=self.outputs, outputCol="features", handleInvalid="error"),
        ]


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """One aggregate over the training rows."""
    row = train.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    if row["m0"] is None:
        raise ValueError("cannot fit a scaler on an empty frame")
    n = range(len(columns))
    return Scaler(
        tuple(columns),
        tuple(float(row[f"m{i}"]) for i in n),
        tuple(float(row[f"s{i}"] or 1.0) for i in n),
    )
