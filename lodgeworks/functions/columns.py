"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORICAL_META = {"categorical": True}


def is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def missing(df: DataFrame, name: str) -> Column:
    """True where the value is absent: null, or NaN in a floating column."""
    col = F.col(f"`{name}`")
    return (col.isNull() | F.isnan(col)) if is_float(df.schema[name].dataType) else col.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null."""
    col = F.col(f"`{name}`")
    return F.nanvl(col, F.lit(None).cast(df.schema[name].dataType)) if is_float(
        df.schema[name].dataType
    ) else col


def string_columns(df: DataFrame) -> list[str]:
    """Columns that hold text."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def number_columns(df: DataFrame) -> list[str]:
    """64-bit integer and double columns."""
    return [f.name for f in df.schema if isinstance(f.dataType, (T.LongType, T.DoubleType))]


def is_categorical(df: DataFrame, name: str) -> bool:
    return bool(df.schema[name].metadata.get("categorical"))


def require_columns(df: DataFrame, names: Sequence[str], error: type[Exception] = ValueError) -> None:
    absent = absent_columns(df, names)
    if absent:
        raise error(f"missing columns: {absent}")


def absent_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n not in have]


def long_form(df: DataFrame, names: Sequence[str], as_type: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column): ``keep`` columns, ``name``, ``value``; absent values left out."""
    cells = [
        F.struct(F.lit(n).alias("name"), present(df, n).cast(as_type).alias("value")) for n in names
    ]
    return (
        df.select(*keep, F.explode(F.array(*cells)).alias("_cell"))
        .select(*keep, "_cell.name", "_cell.value")
        .filter(F.col("value").isNotNull())
    )
